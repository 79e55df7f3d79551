"""Plain SQL answers to the named queries, for a second engine to check them with.

Doubles are rounded through decimals: the engines round ties in binary differently.
"""

from __future__ import annotations

from flowengine.plans import catalogue as c
from flowengine.schema import FLOW_SCHEMA

FLOWS = """
flows AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         '192.168.' || (user_id // 250) || '.' || (user_id % 250) AS src_ip,
         '10.0.0.' || (event_id % 4) AS dst_ip,
         CAST(1024 + event_id % 60000 AS INTEGER) AS src_port,
         CAST(CASE k WHEN 33 THEN 3306 WHEN 43 THEN 443 ELSE k END AS INTEGER) AS dst_port,
         CASE WHEN event_id % 10 < 7 THEN 'TCP' WHEN event_id % 10 < 9 THEN 'UDP' ELSE 'ICMP' END
           AS protocol,
         CAST(1 + event_id % 50 AS INTEGER) AS packet_count,
         CAST(round(value * 100) AS BIGINT) AS byte_count,
         value / 100 AS duration,
         CASE WHEN event_type IN ('error', 'purchase') THEN 'SYN'
              WHEN event_type = 'signup' THEN 'PSH' ELSE 'ACK' END AS flag,
         CASE WHEN event_type = 'error' THEN 'DDoS_FLOOD'
              WHEN event_type = 'purchase' THEN 'PORT_SCAN'
              WHEN event_type = 'signup' THEN 'BRUTE_FORCE'
              WHEN k < 10 THEN 'BOTNET' ELSE 'BENIGN' END AS label,
         epoch_us(ts) // 1000000 AS s,
         event_id AS i
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

RECORD = (
    '"timestamp", src_ip, dst_ip, src_port, dst_port, protocol, packet_count, byte_count, '
    "duration, flag, label"
)

_W, _S, _D = c.SLIDING["size"], c.SLIDING["slide"], c.FLOOD["size"]

WINDOWS = f"""
flood_windows AS (
  SELECT s - s % {_D} + {_D} AS window_end, src_ip, count(*) AS request_count,
         CAST(sum(byte_count) AS BIGINT) AS byte_total
  FROM flows GROUP BY ALL
),
sliding_windows AS (
  SELECT s - s % {_S} - g * {_S} + {_W} AS window_end, src_ip, count(*) AS request_count,
         count(DISTINCT dst_port) AS distinct_ports,
         count(*) FILTER (dst_port IN (21, 22, 3306)) AS auth_attempts
  FROM flows, generate_series(0, {_W // _S - 1}) AS t(g) GROUP BY ALL
)"""

FORMAT_END = "strftime(make_timestamp({}), '%Y-%m-%dT%H:%M:%S')"


def _rule(source, tag, kind, metric, threshold, window, severity, before, after):
    return f"""
  SELECT 'ALT-{tag}-' || window_end || '-' || replace(src_ip, '.', '_') AS alert_id,
         {FORMAT_END.format('window_end * 1000000')} AS "timestamp", src_ip,
         '{kind}' AS attack_type, {metric} AS metric_count,
         CAST({threshold} AS INTEGER) AS threshold, '{window}' AS window_type,
         '{severity}' AS severity, '{before}' || {metric} || '{after}' AS details
  FROM {source} WHERE {metric} >= {threshold}"""


_FLOOD = _rule(
    "flood_windows", "DDoS", "DDoS_FLOOD", "request_count", c.FLOOD["threshold"],
    f"TUMBLING_{_D}S", "HIGH", "Volumetric flood: ", f" requests in {_D}s tumbling window.",
)
_SCAN = _rule(
    "sliding_windows", "SCAN", "PORT_SCAN", "distinct_ports", c.SCAN_THRESHOLD,
    f"SLIDING_{_W}S", "MEDIUM", "Stealth Port Scan: ",
    f" distinct ports probed in {_W}s sliding window.",
)
_AUTH = _rule(
    "sliding_windows", "AUTH", "BRUTE_FORCE", "auth_attempts", c.AUTH_THRESHOLD,
    f"SLIDING_{_W}S", "HIGH", "Brute Force attack: ",
    f" auth attempts against administrative services in {_W}s.",
)
ALERTS = f"alerts AS ({_FLOOD} UNION ALL {_SCAN} UNION ALL {_AUTH})"
RECENT = 'recent AS (SELECT * FROM alerts ORDER BY "timestamp" DESC, alert_id LIMIT ' + str(c.RETAINED) + ')'

EVALUATION = f"""
attacks AS (
  SELECT min(i) AS attack_no, label AS type, src_ip AS ip, min(i) AS start_idx,
         max(i) - min(i) + 1 AS duration
  FROM flows WHERE label IN ('DDoS_FLOOD', 'PORT_SCAN', 'BRUTE_FORCE')
  GROUP BY label, src_ip, substr("timestamp", 1, 10)
),
tumbling AS (
  SELECT * FROM (
    SELECT i - i % {c.BUCKET['size']} + {c.BUCKET['size']} - 1 AS idx, src_ip AS ip,
           count(*) AS events
    FROM flows GROUP BY ALL)
  WHERE events >= {c.BUCKET['min_events']} AND idx <= (SELECT max(i) FROM flows)
),
sliding AS (
  SELECT idx, ip, events, ports FROM (
    SELECT i - i % {c.BUFFER['slide']} + g * {c.BUFFER['slide']} + {c.BUFFER['slide']} - 1 AS idx,
           src_ip AS ip, count(*) AS events, count(DISTINCT dst_port) AS ports
    FROM flows, generate_series(0, {c.BUFFER['size'] // c.BUFFER['slide'] - 1}) AS t(g)
    GROUP BY ALL)
  WHERE (ports >= {c.BUFFER['min_ports']} OR events >= {c.BUFFER['min_events']})
    AND idx <= (SELECT max(i) FROM flows)
)"""


def _quality(source: str, design: str, no_alert_latency: float) -> str:
    return f"""
  SELECT *, matched_alerts / alerts AS precision FROM (SELECT '{design}' AS design,
         (SELECT count(*) FROM {source}) AS alerts,
         (SELECT count(*) FROM {source} x
          WHERE EXISTS (SELECT 1 FROM attacks t WHERE t.ip = x.ip AND t.start_idx <= x.idx))
           AS matched_alerts,
         coalesce((SELECT avg(x.idx - t.start_idx) / 10.0 FROM {source} x
                   JOIN attacks t ON t.ip = x.ip AND t.start_idx <= x.idx), {no_alert_latency})
           AS mean_latency_s,
         (SELECT avg(first_idx - start_idx) / 10.0 FROM first_{source}) AS mean_first_alert_s,
         (SELECT count(*) FROM attacks) AS attacks,
         (SELECT count(first_idx) FROM first_{source}) AS detected_attacks,
         (SELECT count(first_idx) / count(*) FROM first_{source}) AS recall)"""


def _first(source: str) -> str:
    return f"""first_{source} AS (
  SELECT t.attack_no, t.type, t.ip, t.start_idx, min(x.idx) AS first_idx
  FROM attacks t LEFT JOIN {source} x ON x.ip = t.ip AND t.start_idx <= x.idx
  GROUP BY ALL)"""


def _flows(select: str) -> str:
    return f"WITH {FLOWS} {select}"


def _windows(select: str) -> str:
    return f"WITH {FLOWS}, {WINDOWS} {select}"


def _alerts(select: str) -> str:
    return f"WITH {FLOWS}, {WINDOWS}, {ALERTS}, {RECENT} {select}"


def _evaluation(select: str) -> str:
    return f"WITH {FLOWS}, {EVALUATION}, {_first('tumbling')}, {_first('sliding')} {select}"


def _borders(size: int) -> str:
    return (
        f"{FORMAT_END.format(f'(window_end - {size}) * 1000000')} AS window_start, "
        f"{FORMAT_END.format('window_end * 1000000')} AS window_end"
    )


def oracle_sql() -> dict[str, str]:
    packets = _flows(
        "SELECT src_ip, CAST(sum(packet_count) AS BIGINT) AS total_packets FROM flows GROUP BY src_ip"
    )
    sliding = _windows(
        f"SELECT {_borders(_W)}, src_ip, request_count, distinct_ports, auth_attempts "
        "FROM sliding_windows"
    )
    kpis = _alerts(
        """SELECT count(*) AS total_alerts,
                  count(*) FILTER (attack_type = 'DDoS_FLOOD') AS ddos_floods,
                  count(*) FILTER (attack_type = 'PORT_SCAN') AS port_scans,
                  count(*) FILTER (attack_type = 'BRUTE_FORCE') AS brute_force FROM alerts"""
    )
    readable = FLOWS.removesuffix("\n)").removesuffix(")") + (
        " WHERE event_id % 7 <> 5)\n)"
    )
    return {
        "protocol_count": _flows(
            'SELECT upper(trim(protocol)) AS protocol, count(*) AS "count" FROM flows GROUP BY 1'
        ),
        "source_ip_count": _flows('SELECT src_ip, count(*) AS "count" FROM flows GROUP BY 1'),
        "attack_distribution": _flows(
            'SELECT upper(trim(label)) AS label, count(*) AS "count" FROM flows GROUP BY 1'
        ),
        "top_talkers": _flows(
            """SELECT src_ip, count(*) AS total_connections,
                      CAST(sum(packet_count) AS BIGINT) AS total_packets,
                      CAST(round(CAST(sum(byte_count) / 1048576.0 AS DECIMAL(38, 9)), 2) AS DOUBLE)
                        AS total_mbytes
               FROM flows GROUP BY src_ip ORDER BY total_connections DESC, src_ip LIMIT 10"""
        ),
        "protocol_share": _flows(
            """SELECT protocol, count(*) AS event_count,
                      CAST(round(CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DECIMAL(38, 9)), 2)
                           AS DOUBLE) AS percentage_share
               FROM flows GROUP BY protocol"""
        ),
        "event_breakdown": _flows(
            """SELECT label AS event_category, count(*) AS total_occurrences,
                      CAST(round(CAST(avg(duration) AS DECIMAL(38, 9)), 3) AS DOUBLE) AS avg_duration_sec,
                      CAST(round(CAST(avg(byte_count) AS DECIMAL(38, 9)), 2) AS DOUBLE)
                        AS avg_bytes_per_flow
               FROM flows GROUP BY label"""
        ),
        "hourly_attack_trend": _flows(
            """SELECT substr("timestamp", 1, 13) AS time_hour, label, count(*) AS occurrences
               FROM flows WHERE label <> 'BENIGN' GROUP BY 1, 2"""
        ),
        "targeted_services": _flows(
            """SELECT dst_ip, dst_port, count(*) AS attack_probe_count FROM flows
               WHERE label IN ('DDoS_FLOOD', 'PORT_SCAN', 'BRUTE_FORCE') GROUP BY 1, 2
               ORDER BY attack_probe_count DESC, dst_ip, dst_port LIMIT 10"""
        ),
        "packets_by_source": packets,
        "packets_by_source_csv": packets,
        "packets_by_source_orc": packets,
        "packets_by_source_parquet": packets,
        "suspicious_ssh": _flows(
            f"SELECT {RECORD} FROM flows WHERE dst_port = 22 AND packet_count > 25"
        ),
        "flow_kpis": _flows(
            """SELECT count(*) AS flow_records, count(DISTINCT protocol) AS total_protocols,
                      count(DISTINCT dst_ip) AS monitored_servers,
                      CAST(round(CAST(100.0 * count(*) FILTER (label IS DISTINCT FROM 'BENIGN')
                           / count(*) AS DECIMAL(38, 9)), 1) AS DOUBLE) AS attack_share_pct
               FROM flows"""
        ),
        "protocol_counts": _flows('SELECT protocol, count(*) AS "count" FROM flows GROUP BY 1'),
        "label_counts": _flows('SELECT label, count(*) AS "count" FROM flows GROUP BY 1'),
        "top_sources_display": _flows(
            """SELECT src_ip AS "Source IP", count(*) AS "Events" FROM flows GROUP BY 1
               ORDER BY "Events" DESC, "Source IP" LIMIT 10"""
        ),
        "targeted_ports": _flows(
            """SELECT dst_port, count(*) AS "count" FROM flows WHERE label <> 'BENIGN' GROUP BY 1
               ORDER BY "count" DESC, dst_port LIMIT 8"""
        ),
        "csv_round_trip": _flows(f"SELECT {RECORD} FROM flows"),
        "counts_tsv": _flows('SELECT src_ip, count(*) AS "count" FROM flows GROUP BY 1'),
        "append_events": _flows(
            """SELECT label, 2 * count(*) AS "rows", count(flag) AS flags,
                      count(duration) AS durations, CAST(2 * sum(byte_count) AS BIGINT) AS bytes
               FROM flows GROUP BY label"""
        ),
        "append_alerts": _alerts(
            """SELECT alert_id, "timestamp", src_ip, CAST(NULL AS VARCHAR) AS dst_ip, attack_type,
                      metric_count, threshold, CAST(NULL AS VARCHAR) AS window_type, severity,
                      CAST(NULL AS VARCHAR) AS details, CAST(NULL AS VARCHAR) AS status,
                      CAST(NULL AS VARCHAR) AS mitigation_action,
                      CAST(NULL AS VARCHAR) AS resolved_at,
                      CAST(NULL AS VARCHAR) AS resolution_notes,
                      CAST(NULL AS INTEGER) AS retry_count FROM alerts"""
        ),
        "register_tables": _flows(
            """SELECT t AS "tableName", protocol, count(*) AS flows,
                      CAST(sum(byte_count) AS BIGINT) AS bytes
               FROM flows, (VALUES ('flows_csv'), ('flows_orc'), ('flows_parquet')) AS v(t)
               GROUP BY t, protocol"""
        ),
        "describe_tables": " UNION ALL ".join(
            f"SELECT 'flows_{fmt}' AS \"table\", '{field.name}' AS col_name, "
            f"'{field.dataType.simpleString()}' AS data_type"
            for fmt in ("csv", "orc", "parquet") for field in FLOW_SCHEMA.fields
        ),
        "sample_head": _flows(f'SELECT {RECORD} FROM flows ORDER BY "timestamp", i LIMIT 5000'),
        "short_rows": _flows(
            """SELECT CASE i % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE label END AS label,
                      count(*) AS "rows", CAST(sum(packet_count) AS BIGINT) AS packets
               FROM flows GROUP BY 1"""
        ),
        "rejected_flows": _flows(
            """SELECT count(*) AS flows, CAST(0 AS BIGINT) AS without_timestamp,
                      count(*) FILTER (i % 7 = 5) AS unreadable_timestamp FROM flows"""
        ),
        "timestamp_forms": f"WITH {readable}, {WINDOWS} {_FLOOD}",
        "layout_report": _flows(
            f"""SELECT shard, "rows",
                       CAST(round(CAST("rows" * 100.0 / sum("rows") OVER () AS DECIMAL(38, 9)), 2)
                            AS DOUBLE) AS share_pct,
                       CAST(round(CAST(max("rows") OVER () * {c.SHARDS}
                            / CAST(sum("rows") OVER () AS DOUBLE) AS DECIMAL(38, 9)), 3)
                            AS DOUBLE) AS skew
                FROM (SELECT CAST(CAST('0x' || substr(md5(src_ip), 1, 8) AS BIGINT) % {c.SHARDS}
                                  AS INTEGER) AS shard, count(*) AS "rows"
                      FROM flows GROUP BY 1)"""
        ),
        "hashed_layout": _flows(
            'SELECT src_ip, count(*) AS "rows", CAST(1 AS BIGINT) AS shards FROM flows GROUP BY 1'
        ),
        "ranged_layout": _flows(
            """SELECT substr("timestamp", 1, 10) AS day, count(*) AS "rows",
                      CAST(sum(byte_count) AS BIGINT) AS bytes FROM flows
               WHERE substr("timestamp", 1, 10) BETWEEN '2024-01-05' AND '2024-01-14' GROUP BY 1"""
        ),
        "bucketed_layout": _flows(
            """SELECT src_ip, CAST(sum(packet_count) AS BIGINT) AS total_packets,
                      count(*) FILTER (dst_port = 22) AS logins FROM flows GROUP BY 1"""
        ),
        "stream_drops": _flows(
            """SELECT count(*) AS lines, count(*) FILTER (i % 7 = 0) AS malformed,
                      count(*) FILTER (i % 7 = 2) AS without_timestamp,
                      count(*) FILTER (i % 7 = 1) AS unreadable_timestamp FROM flows"""
        ),
        "time_layout_report": _flows(
            """SELECT shard, "rows",
                      CAST(round(CAST("rows" * 100.0 / sum("rows") OVER () AS DECIMAL(38, 9)), 2)
                           AS DOUBLE) AS share_pct,
                      CAST(round(CAST(max("rows") OVER () * count(*) OVER ()
                           / CAST(sum("rows") OVER () AS DOUBLE) AS DECIMAL(38, 9)), 3)
                           AS DOUBLE) AS skew
               FROM (SELECT substr("timestamp", 1, 10) AS shard, count(*) AS "rows"
                     FROM flows GROUP BY 1)"""
        ),
        "flood_alerts": _windows(_FLOOD),
        "flood_bytes": _windows(
            f"SELECT {_borders(_D)}, src_ip, request_count, byte_total FROM flood_windows"
        ),
        "port_scan_alerts": _windows(_SCAN),
        "port_scan_panes": sliding,
        "port_scan_by_row": sliding,
        "brute_force_alerts": _windows(_AUTH),
        "sliding_alerts": _windows(f"{_SCAN} UNION ALL {_AUTH}"),
        "all_alerts": _alerts("SELECT * FROM alerts"),
        "high_severity_alerts": _alerts("SELECT * FROM alerts WHERE severity = 'HIGH'"),
        "alerts_by_type": _alerts(
            """SELECT attack_type, count(*) AS total_alerts, avg(metric_count) AS avg_metric_count,
                      max(metric_count) AS max_metric_count FROM alerts GROUP BY attack_type"""
        ),
        "top_attackers": _alerts(
            """SELECT src_ip, count(*) AS alert_count,
                      string_agg(DISTINCT attack_type, ',' ORDER BY attack_type) AS attack_types
               FROM alerts GROUP BY src_ip ORDER BY alert_count DESC, src_ip LIMIT 5"""
        ),
        "alert_statistics": _alerts(
            """SELECT 'total' AS dimension, NULL AS value, count(*) AS "count" FROM alerts
               UNION ALL SELECT 'attack_type', attack_type, count(*) FROM alerts GROUP BY attack_type
               UNION ALL SELECT 'src_ip', src_ip, count(*) FROM alerts GROUP BY src_ip"""
        ),
        "alert_type_series": _alerts(
            """SELECT attack_type AS "Attack Type", count(*) AS "Alert Count"
               FROM alerts GROUP BY attack_type"""
        ),
        "alert_kpis": kpis,
        "stream_kpis": kpis,
        "clear_alerts": _alerts('SELECT count(*) AS before, CAST(0 AS BIGINT) AS "after" FROM alerts'),
        "recent_alerts": _alerts('SELECT * FROM alerts ORDER BY "timestamp" DESC, alert_id LIMIT 50'),
        "alert_display": _alerts(
            """SELECT "timestamp" AS "Time", src_ip AS "Attacker IP", attack_type AS "Attack Type",
                      metric_count AS "Metric", window_type AS "Window",
                      CASE WHEN severity = 'HIGH' THEN 'HIGH' ELSE 'MEDIUM' END AS "Severity",
                      coalesce(details, 'Anomaly identified') AS "Details"
               FROM alerts ORDER BY "timestamp" DESC, alert_id LIMIT 15"""
        ),
        "retain_latest": _alerts("SELECT * FROM recent"),
        "update_alert": _alerts(
            f""", newest AS (SELECT alert_id AS id FROM recent
                            ORDER BY "timestamp" DESC, alert_id LIMIT 1)
               SELECT alert_id, src_ip, metric_count,
                      CASE WHEN alert_id = id THEN 'RESOLVED' END AS status,
                      CASE WHEN alert_id = id THEN '2024-02-01T00:00:00' END AS resolved_at,
                      CASE WHEN alert_id = id THEN '{c.RESOLUTION['resolution_notes']}' END AS resolution_notes,
                      CAST(CASE WHEN alert_id = id THEN 1 END AS INTEGER) AS retry_count
               FROM alerts, newest"""
        ),
        "update_alerts": _alerts(
            f"""SELECT alert_id, src_ip, metric_count,
                      CASE WHEN severity = 'HIGH' THEN '{c.RESOLUTION['status']}' END AS status,
                      CASE WHEN severity = 'HIGH' THEN '{c.RESOLUTION['resolved_at']}' END AS resolved_at,
                      CASE WHEN severity = 'HIGH' THEN '{c.RESOLUTION['resolution_notes']}' END
                        AS resolution_notes,
                      CAST(CASE WHEN severity = 'HIGH' THEN 1 END AS INTEGER) AS retry_count
               FROM alerts"""
        ),
        "versioned_store": _alerts(
            f""", floods AS (SELECT * FROM alerts WHERE attack_type = 'DDoS_FLOOD'),
               others AS (SELECT * FROM alerts WHERE attack_type <> 'PORT_SCAN'),
               newest AS (SELECT * FROM others ORDER BY "timestamp" DESC, alert_id LIMIT {c.RETAINED}),
               every AS (
                 SELECT 1 AS version, metric_count, false AS done FROM floods UNION ALL
                 SELECT 2, metric_count, false FROM alerts UNION ALL
                 SELECT 3, metric_count, severity = 'HIGH' FROM alerts UNION ALL
                 SELECT 4, metric_count, severity = 'HIGH' FROM others UNION ALL
                 SELECT 5, metric_count, severity = 'HIGH' FROM newest)
               SELECT v AS version, count(metric_count) AS alerts,
                      count(*) FILTER (done) AS resolved,
                      CAST(coalesce(sum(metric_count), 0) AS BIGINT) AS events
               FROM range(1, 7) AS t(v) LEFT JOIN every ON version = v GROUP BY v"""
        ),
        "purge_label": _flows(f"SELECT {RECORD} FROM flows WHERE label IS DISTINCT FROM 'BOTNET'"),
        "purge_count": _flows("SELECT count(*) AS deleted FROM flows WHERE label = 'BOTNET'"),
        "label_events": _evaluation(
            """, owned AS (
                 SELECT f.i, min(t.attack_no) AS attack_no FROM flows f
                 JOIN attacks t ON t.start_idx <= f.i AND f.i < t.start_idx + t.duration GROUP BY f.i)
               SELECT f.i, f.src_ip AS ip, f.dst_port AS port, o.attack_no, t.type AS attack_type,
                      o.attack_no IS NOT NULL AS is_anomaly
               FROM flows f LEFT JOIN owned o ON o.i = f.i
               LEFT JOIN attacks t ON t.attack_no = o.attack_no"""
        ),
        "count_windows_tumbling": _evaluation("SELECT * FROM tumbling"),
        "count_windows_sliding": _evaluation("SELECT * FROM sliding"),
        "match_alerts": _evaluation(
            """SELECT x.ip, x.idx, CAST(1 AS BIGINT) AS alerts, count(t.start_idx) AS attacks,
                      CAST(coalesce(sum(x.idx - t.start_idx), 0) AS BIGINT) AS latency_sum
               FROM sliding x LEFT JOIN attacks t ON t.ip = x.ip AND t.start_idx <= x.idx
               GROUP BY x.ip, x.idx"""
        ),
        "attack_detection": _evaluation(
            """SELECT attack_no, type, ip, first_idx IS NOT NULL AS detected,
                      (first_idx - start_idx) / 10.0 AS first_alert_s FROM first_sliding"""
        ),
        "compare_windows": _evaluation(
            f"{_quality('tumbling', 'TUMBLING', 10.0)} UNION ALL {_quality('sliding', 'SLIDING', 5.0)}"
        ),
        "stream_flood_alerts": _windows(_FLOOD),
        "stream_sliding_alerts": _windows(f"{_SCAN} UNION ALL {_AUTH}"),
    }
