"""Every operator as a named query `(spark, sf_dir) -> DataFrame` over whole tables.

The driver's events lie minutes apart, so windows are days long here; all sizes and
thresholds are ordinary parameters of the operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowengine.functions.scalars import iso_text
from flowengine.operators import alerts as A
from flowengine.operators import counts, detect, evaluate, layout, maintain, traffic, windows
from flowengine.plans import adapter
from flowengine.schema import ALERT_SCHEMA, FLOW_SCHEMA, TIMESTAMP_FORMAT
from flowengine.session import work_path
from flowengine.sinks import catalog, files, versions
from flowengine.sources import flows as source
from flowengine.sources.alerts import read_alerts, read_recent_alerts
from flowengine.streaming import detection as streaming
from flowengine.streaming.detection import LATENESS

Query = Callable[[SparkSession, str], DataFrame]

DAY = 86_400
FLOOD = {"size": DAY, "threshold": 7}
SLIDING = {"size": 3 * DAY, "slide": DAY // 2}
SCAN_THRESHOLD, AUTH_THRESHOLD = 12, 2
BUCKET = {"size": 1000, "min_events": 5}
BUFFER = {"size": 1500, "slide": 250, "min_ports": 6, "min_events": 7}
SHARDS = 8
RETAINED = 100
RESOLUTION = {
    "status": "RESOLVED",
    "resolved_at": "2024-02-01T00:00:00",
    "resolution_notes": "source blocked at the edge",
}


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of all three rules: the flagship query."""
    return detect.all_alerts(
        adapter.flows(spark, sf_dir),
        flood_size=FLOOD["size"],
        flood_threshold=FLOOD["threshold"],
        **SLIDING,
        scan_threshold=SCAN_THRESHOLD,
        auth_threshold=AUTH_THRESHOLD,
    )


def _on_lines(operator) -> Query:
    return lambda spark, sf: operator(adapter.lines(spark, sf))


def _on_flows(operator, **options) -> Query:
    return lambda spark, sf: operator(adapter.flows(spark, sf), **options)


def _on_records(operator, **options) -> Query:
    return lambda spark, sf: operator(adapter.records(spark, sf), **options)


def _on_alerts(operator, **options) -> Query:
    return lambda spark, sf: operator(alerts(spark, sf), **options)


def _text_instants(frame: DataFrame) -> DataFrame:
    """Window borders as text, which compares the same in any engine."""
    return frame.withColumns({c: iso_text(F.col(c)) for c in ("window_start", "window_end")})


def _packets_from(fmt: str) -> Query:
    """E9 on a copy of the table in another format."""

    def query(spark, sf):
        path = work_path(spark, f"flows-{fmt}")
        files.convert_flows(adapter.records(spark, sf), path, fmt)
        copy = (
            source.read_flows_csv(spark, path)
            if fmt == "csv"
            else source.read_flows_columnar(spark, path, fmt)
        )
        return traffic.packets_by_source(copy)

    return query


def _csv_round_trip(spark, sf):
    path = work_path(spark, "flows-csv")
    files.convert_flows(adapter.records(spark, sf), path, "csv")
    return source.read_flows_csv(spark, path)


def _counts_tsv(spark, sf):
    """B3, read back."""
    path = work_path(spark, "counts")
    files.write_counts_tsv(counts.source_ip_count(adapter.lines(spark, sf)), path)
    return spark.read.schema("src_ip string, count bigint").option("sep", "\t").csv(path)


def _append_events(spark, sf):
    """Whole flows, then the same events as documents without duration and flag."""
    path = work_path(spark, "documents")
    flows = adapter.records(spark, sf)
    files.append_rows(flows, path, FLOW_SCHEMA)
    files.append_rows(flows.drop("duration", "flag"), path, FLOW_SCHEMA)
    return (
        spark.read.schema(FLOW_SCHEMA)
        .parquet(path)
        .groupBy("label")
        .agg(
            F.count("*").alias("rows"),
            F.count("flag").alias("flags"),
            F.count("duration").alias("durations"),
            F.sum("byte_count").alias("bytes"),
        )
    )


def _append_alerts(spark, sf):
    """Alert documents, some of their fields absent."""
    path = work_path(spark, "alerts")
    documents = alerts(spark, sf).drop("details", "window_type")
    files.append_rows(maintain.with_alert_defaults(documents), path, ALERT_SCHEMA)
    return spark.read.schema(ALERT_SCHEMA).parquet(path)


def _register_tables(spark, sf):
    """The flows as text, ORC and Parquet tables under SQL, and the same question to each."""
    tables = {}
    for fmt in ("csv", "orc", "parquet"):
        path = work_path(spark, f"flows-table-{fmt}")
        files.convert_flows(adapter.records(spark, sf), path, fmt)
        tables[f"flows_{fmt}"] = (fmt, path)
    database = f"flow_analytics_{uuid.uuid4().hex}"  # runs at the same time do not meet
    listed = catalog.register_tables(spark, database, tables)
    answers = " UNION ALL ".join(
        f"SELECT '{name}' AS tableName, protocol, count(*) AS flows, sum(byte_count) AS bytes "
        f"FROM {database}.{name} GROUP BY protocol"
        for name in tables
    )
    return spark.sql(answers).join(listed.select("tableName"), "tableName")


def _describe_tables(spark, sf):
    """The columns that SQL sees of each registered table."""
    database = f"flow_analytics_{uuid.uuid4().hex}"
    tables = {}
    for fmt in ("csv", "orc", "parquet"):
        path = work_path(spark, f"flows-table-{fmt}")
        files.convert_flows(adapter.records(spark, sf), path, fmt)
        tables[f"flows_{fmt}"] = (fmt, path)
    catalog.register_tables(spark, database, tables)
    described = [
        catalog.describe_table(spark, f"{database}.{name}").limit(len(FLOW_SCHEMA))
        .select(F.lit(name).alias("table"), "col_name", "data_type")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, described)


def _short_rows(spark, sf):
    """A1: lines whose last field is absent, and lines where it is empty."""
    path = work_path(spark, "short-lines")
    last = F.when(F.col("i") % 7 == 0, "").when(F.col("i") % 7 == 1, ",").otherwise(
        F.concat(F.lit(","), F.col("label"))
    )
    others = [F.col(f.name).cast("string") for f in FLOW_SCHEMA.fields[:-1]]
    adapter.flows(spark, sf).select(
        F.concat(F.concat_ws(",", *others), last).alias("value")
    ).write.text(path)
    return source.read_flows_csv(spark, path).groupBy("label").agg(
        F.count("*").alias("rows"), F.sum("packet_count").alias("packets")
    )


def _in_many_forms(spark, sf):
    """The flows with timestamps in all readable forms, and one in seven in an unreadable one."""
    text, turn = F.col("timestamp"), F.col("i") % 7
    form = (
        F.when(turn == 1, F.concat(text, F.lit("Z")))
        .when(turn == 2, F.concat(text, F.lit(".000Z")))
        .when(turn == 3, F.concat(text, F.lit(".250")))
        .when(turn == 4, F.concat(F.date_format(
            F.to_timestamp(text, TIMESTAMP_FORMAT) + F.expr("INTERVAL 2 HOURS"),
            TIMESTAMP_FORMAT), F.lit("+02:00")))
        .when(turn == 5, F.translate(text, "-T", "/ "))
        .otherwise(text)
    )
    rows = adapter.flows(spark, sf).drop("event_ts")
    return source.with_event_time(rows.withColumn("timestamp", form))


def _clear_alerts(spark, sf):
    """How many alerts a store holds before and after it is emptied."""
    path = work_path(spark, "alerts")
    files.append_rows(alerts(spark, sf), path, ALERT_SCHEMA)
    before = A.alert_kpis(read_alerts(spark, path)).first().total_alerts
    files.clear_alerts(spark, path)
    after = A.alert_kpis(read_alerts(spark, path))
    return after.select(F.lit(before).alias("before"), F.col("total_alerts").alias("after"))


def _first_rows(spark, sf):
    rows = source.sample_head(adapter.flows(spark, sf), order=("timestamp", "i"))
    return rows.select(*[f.name for f in FLOW_SCHEMA.fields])


def _stream_kpis(spark, sf):
    """Headline counts of a live alert folder, brought up to date as alerts arrive."""
    stored, live, kpis, checkpoint = (
        work_path(spark, name) for name in ("alerts", "live-alerts", "kpis", "kpis-checkpoint")
    )
    files.append_rows(alerts(spark, sf), stored, ALERT_SCHEMA)
    found = read_alerts(spark, stored)
    flood = F.col("attack_type") == detect.FLOOD.attack_type
    for arriving in (found.filter(flood), found.filter(~flood)):
        files.append_rows(arriving, live, ALERT_SCHEMA)
        streaming.refresh_kpis(spark, [live], kpis, checkpoint).awaitTermination()
    return streaming.read_kpis(spark, kpis)


def _stream_drops(spark, sf):
    """A4/C20: what a stream counts of lines that it drops or cannot place."""
    path, out = work_path(spark, "spoilt-lines"), work_path(spark, "drops-checkpoint")
    rows, turn = adapter.flows(spark, sf), F.col("i") % 7
    names = [f.name for f in FLOW_SCHEMA.fields]
    spoilt = rows.withColumn(
        "timestamp", F.when(turn == 1, "yesterday").when(turn != 2, F.col("timestamp"))
    )
    line = F.when(turn == 0, F.concat(F.lit("no object: "), "src_ip")).otherwise(
        F.to_json(F.struct(*names))
    )
    spoilt.select(line.alias("value")).write.text(path)
    flows = streaming.watermarked(source.stream_flows(spark, path, observe=True), LATENESS)
    query = (
        detect.flood_alerts(flows, **FLOOD).writeStream.format("noop")
        .option("checkpointLocation", out).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    log = streaming.DropLog()
    for progress in query.recentProgress:
        log.record(progress)
    return log.batches(spark).agg(
        *[F.sum(c).alias(c) for c in ("lines", "malformed", "without_timestamp", "unreadable_timestamp")]
    )


def _versioned_store(spark, sf):
    """B5 to B9 on one store, each as a version: alerts arrive twice, high ones are resolved, scans
    are purged, the newest are retained, and the store is cleared."""
    path, stored = work_path(spark, "alert-store"), work_path(spark, "alerts")
    files.append_rows(alerts(spark, sf), stored, ALERT_SCHEMA)
    found = read_alerts(spark, stored)
    flood = F.col("attack_type") == detect.FLOOD.attack_type
    for arriving in (found.filter(flood), found.filter(~flood)):
        versions.append(spark, path, arriving)

    def change(operation):
        versions.change(spark, path, ALERT_SCHEMA, operation)

    change(lambda rows: maintain.update_alerts(
        rows, _resolutions(rows), tuple(RESOLUTION), {"retry_count": "retries"}
    ))
    change(lambda rows: maintain.purge(rows, "attack_type", detect.PORT_SCAN.attack_type))
    change(lambda rows: maintain.retain_latest(rows, RETAINED))
    change(lambda rows: rows.filter(F.lit(False)))
    every = [
        versions.read(spark, path, ALERT_SCHEMA, n).agg(
            F.lit(n).cast("bigint").alias("version"), F.count("*").alias("alerts"),
            F.count_if(F.col("status") == "RESOLVED").alias("resolved"),
            F.coalesce(F.sum("metric_count"), F.lit(0)).alias("events"),
        )
        for n in versions.versions(spark, path)
    ]
    return reduce(DataFrame.unionByName, every)


def _resolutions(stored):
    """Updates that resolve every high alert, and one of an alert that does not exist."""
    high = stored.filter(F.col("severity") == "HIGH").select("alert_id")
    absent = high.limit(1).select(F.lit("ALT-NONE").alias("alert_id"))
    values = {c: F.lit(v) for c, v in RESOLUTION.items()}
    return high.union(absent).withColumns(values | {"retries": F.lit(1)})


def _update_alerts(spark, sf):
    """B7 in bulk: all high alerts resolved at once."""
    path = work_path(spark, "alerts")
    files.append_rows(alerts(spark, sf), path, ALERT_SCHEMA)
    stored = read_alerts(spark, path)
    changed = maintain.update_alerts(
        stored, _resolutions(stored), tuple(RESOLUTION), {"retry_count": "retries"}
    )
    return changed.select(
        "alert_id", "src_ip", "metric_count", "status", "resolved_at", "resolution_notes", "retry_count"
    )


def _bucketed_layout(spark, sf):
    """Packets and flows of each source from a bucketed table, and its share of the flows to
    the same port group, by a join of the table's groups without a shuffle."""
    table = f"flows_bucketed_{uuid.uuid4().hex}"
    files.write_bucketed(adapter.records(spark, sf), table, work_path(spark, "bucketed"), SHARDS)
    rows = spark.table(table)
    attempts = rows.filter(F.col("dst_port") == 22).groupBy("src_ip").agg(
        F.count("*").alias("logins")
    )
    return traffic.packets_by_source(rows).join(attempts, "src_ip", "left").select(
        "src_ip", "total_packets", F.coalesce("logins", F.lit(0)).alias("logins")
    )


def _hashed_layout(spark, sf):
    """What each source reads back from its own shard folder."""
    path = work_path(spark, "hashed")
    files.write_hashed(adapter.records(spark, sf), path, SHARDS)
    return (
        spark.read.parquet(path)
        .groupBy("src_ip")
        .agg(F.count("*").alias("rows"), F.count_distinct("shard").alias("shards"))
    )


def _ranged_layout(spark, sf):
    """Ten days out of the day folders."""
    path = work_path(spark, "ranged")
    files.write_ranged(adapter.records(spark, sf), path)
    return (
        spark.read.parquet(path)
        .filter(F.col("day").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-14").cast("date")))
        .groupBy(F.col("day").cast("string").alias("day"))
        .agg(F.count("*").alias("rows"), F.sum("byte_count").alias("bytes"))
    )


def _update_alert(spark, sf):
    """B7 on the newest stored alert, whichever it is at this scale."""
    path = work_path(spark, "alerts")
    files.append_rows(alerts(spark, sf), path, ALERT_SCHEMA)
    stored = read_alerts(spark, path)
    newest = read_recent_alerts(stored, 1).select("alert_id").scalar()
    return maintain.update_alert(stored, newest, RESOLUTION, {"retry_count": 1}).select(
        "alert_id", "src_ip", "metric_count", "status", "resolved_at", "resolution_notes", "retry_count"
    )


def _footprint(spark, sf):
    """What the flows take up as text, ORC and Parquet."""
    paths = {}
    for fmt in ("csv", "orc", "parquet"):
        paths[fmt] = work_path(spark, f"footprint-{fmt}")
        files.convert_flows(adapter.records(spark, sf), paths[fmt], fmt)
    return layout.storage_footprint(spark, paths)


def _hash_report(spark, sf):
    return layout.layout_report(adapter.flows(spark, sf), layout.shard_of("src_ip", SHARDS), SHARDS)


def _time_report(spark, sf):
    return layout.layout_report(adapter.flows(spark, sf), F.substring("timestamp", 1, 10))


def _evaluated(operator) -> Query:
    return lambda spark, sf: operator(adapter.numbered_events(spark, sf), adapter.attacks(spark, sf))


def _tumbling(events):
    return evaluate.tumbling_count_alerts(events, **BUCKET)


def _sliding(events):
    return evaluate.sliding_count_alerts(events, **BUFFER)


def _streamed(rule, name: str, **options) -> Query:
    """The table as JSON lines, through a stream and into alert files."""

    def query(spark, sf):
        lines = work_path(spark, f"{name}-lines")
        records = adapter.records(spark, sf)
        content = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
        last = streaming.closing_line(adapter.flows(spark, sf), SLIDING["size"] + DAY)
        content.union(last).write.text(lines)
        flows = streaming.watermarked(source.stream_flows(spark, lines), LATENESS)
        found = streaming.drain(spark, rule(flows, **options), name)
        return found.select(
            "alert_id", "timestamp", "src_ip", "attack_type", "metric_count", "threshold",
            "window_type", "severity", "details",
        )

    return query


_SLIDING_BOTH = {**SLIDING, "scan_threshold": SCAN_THRESHOLD, "auth_threshold": AUTH_THRESHOLD}
_STREAMED_FLOODS = _streamed(detect.flood_alerts, "floods", **FLOOD)
_STREAMED_SLIDING = _streamed(detect.sliding_alerts, "sliding", **_SLIDING_BOTH)


def queries() -> dict[str, Query]:
    return {
        # positional counts on raw lines
        "protocol_count": _on_lines(counts.protocol_count),
        "source_ip_count": _on_lines(counts.source_ip_count),
        "attack_distribution": _on_lines(counts.attack_distribution),
        # batch questions
        "top_talkers": _on_records(traffic.top_talkers),
        "protocol_share": _on_records(traffic.protocol_share),
        "event_breakdown": _on_records(traffic.event_breakdown),
        "hourly_attack_trend": _on_records(traffic.hourly_attack_trend),
        "targeted_services": _on_records(traffic.targeted_services),
        "packets_by_source": _on_records(traffic.packets_by_source),
        "suspicious_ssh": _on_records(traffic.suspicious_ssh, min_packets=25),
        "flow_kpis": _on_records(traffic.flow_kpis),
        "protocol_counts": _on_records(traffic.protocol_counts),
        "label_counts": _on_records(traffic.label_counts),
        "top_sources_display": _on_records(traffic.top_sources_display),
        "targeted_ports": _on_records(traffic.targeted_ports),
        "sample_head": _first_rows,
        "short_rows": _short_rows,
        "rejected_flows": lambda spark, sf: source.rejected_flows(_in_many_forms(spark, sf)),
        "timestamp_forms": lambda spark, sf: detect.flood_alerts(_in_many_forms(spark, sf), **FLOOD),
        # formats, sinks and layout
        "packets_by_source_csv": _packets_from("csv"),
        "packets_by_source_orc": _packets_from("orc"),
        "packets_by_source_parquet": _packets_from("parquet"),
        "csv_round_trip": _csv_round_trip,
        "counts_tsv": _counts_tsv,
        "append_events": _append_events,
        "append_alerts": _append_alerts,
        "register_tables": _register_tables,
        "describe_tables": _describe_tables,
        "hashed_layout": _hashed_layout,
        "ranged_layout": _ranged_layout,
        "bucketed_layout": _bucketed_layout,
        "layout_report": _hash_report,
        "time_layout_report": _time_report,
        "storage_footprint": _footprint,
        # detection
        "flood_alerts": _on_flows(detect.flood_alerts, **FLOOD),
        "flood_bytes": lambda spark, sf: _text_instants(
            windows.flood_windows(adapter.flows(spark, sf), FLOOD["size"])
        ),
        "port_scan_alerts": _on_flows(detect.port_scan_alerts, **SLIDING, threshold=SCAN_THRESHOLD),
        "port_scan_panes": lambda spark, sf: _text_instants(
            windows.sliding_windows(adapter.flows(spark, sf), **SLIDING)
        ),
        "port_scan_by_row": lambda spark, sf: _text_instants(
            windows.sliding_windows_by_row(adapter.flows(spark, sf), **SLIDING)
        ),
        "brute_force_alerts": _on_flows(detect.brute_force_alerts, **SLIDING, threshold=AUTH_THRESHOLD),
        "sliding_alerts": _on_flows(detect.sliding_alerts, **_SLIDING_BOTH),
        "all_alerts": alerts,
        # alert questions and maintenance
        "high_severity_alerts": _on_alerts(A.high_severity_alerts),
        "alerts_by_type": _on_alerts(A.alerts_by_type),
        "top_attackers": lambda spark, sf: A.top_attackers(alerts(spark, sf)).withColumn(
            "attack_types", F.array_join("attack_types", ",")
        ),
        "alert_statistics": _on_alerts(A.alert_statistics),
        "alert_type_series": _on_alerts(A.alert_type_series),
        "alert_kpis": _on_alerts(A.alert_kpis),
        "recent_alerts": _on_alerts(read_recent_alerts),
        "alert_display": _on_alerts(A.alert_display),
        "retain_latest": _on_alerts(maintain.retain_latest, n=RETAINED),
        "clear_alerts": _clear_alerts,
        "update_alert": _update_alert,
        "update_alerts": _update_alerts,
        "versioned_store": _versioned_store,
        "purge_label": _on_records(maintain.purge, column="label", value="BOTNET"),
        "purge_count": _on_records(maintain.purge_count, column="label", value="BOTNET"),
        # evaluation of window designs
        "label_events": _evaluated(evaluate.label_events),
        "count_windows_tumbling": lambda spark, sf: _tumbling(adapter.numbered_events(spark, sf)),
        "count_windows_sliding": lambda spark, sf: _sliding(adapter.numbered_events(spark, sf)),
        "match_alerts": _evaluated(lambda e, a: evaluate.match_alerts(_sliding(e), a)),
        "attack_detection": _evaluated(lambda e, a: evaluate.attack_detection(_sliding(e), a)),
        "compare_windows": _evaluated(
            lambda e, a: evaluate.compare_designs(
                evaluate.count_alerts(e, *BUCKET.values(), **BUFFER), a
            )
        ),
        # the same rules on streams
        "stream_flood_alerts": _STREAMED_FLOODS,
        "stream_sliding_alerts": _STREAMED_SLIDING,
        "stream_kpis": _stream_kpis,
        "stream_drops": _stream_drops,
    }
