"""The rules on streams: the same alerts as in batch, once, across restarts."""

import json
import random
from datetime import datetime, timedelta

import pytest

from flowengine.operators import alerts as A
from flowengine.operators import detect
from flowengine.sources import flows as source
from flowengine.streaming import detection as streaming

ORIGIN = datetime(2024, 1, 1)


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps(
            {
                "timestamp": (ORIGIN + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%S"),
                "src_ip": ip, "dst_port": port, "byte_count": 100,
            }
        )
        for s, ip, port in rows
    ]
    (folder / name).write_text("\n".join(["not json", "", *lines]) + "\n")


def traffic(start, stop, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["a", "b", None]
    return [
        (s, rng.choice(sources), rng.choice([21, 22, 3306, *range(100, 130)]))
        for s in range(start, stop)
        for _ in range(8)
    ]


def closed(alerts, newest, lateness=10):
    """Alerts of windows the watermark has passed."""
    limit = (ORIGIN + timedelta(seconds=newest - lateness)).strftime("%Y-%m-%dT%H:%M:%S")
    return sorted(r.alert_id + str(r.metric_count) for r in alerts.collect() if r.timestamp <= limit)


def ids(alerts):
    return sorted(r.alert_id + str(r.metric_count) for r in alerts.collect())


RULES = {
    "floods": (detect.flood_alerts, {"threshold": 25}),
    "sliding": (detect.sliding_alerts, {"scan_threshold": 20, "auth_threshold": 5}),
    "scans": (detect.port_scan_alerts, {"threshold": 20}),
    "logins": (detect.brute_force_alerts, {"threshold": 5}),
}


@pytest.mark.parametrize("name", RULES)
def test_stream_equals_batch_across_a_restart(spark, tmp_path, name):
    rule, options = RULES[name]
    lines, store, checkpoint = tmp_path / "lines", str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        flows = streaming.watermarked(source.stream_flows(spark, str(lines)))
        streaming.write_alerts(rule(flows, **options), store, checkpoint, availableNow=True).awaitTermination()
        return streaming.read_alert_folders(spark, store)

    first, second = traffic(0, 60, 1), traffic(60, 120, 2)
    write(lines, "1.json", first)
    assert ids(run()) == closed(rule(source.parse_flow_json(spark.read.text(str(lines))), **options), 59)

    write(lines, "2.json", second)
    batch = rule(source.parse_flow_json(spark.read.text(str(lines))), **options)
    stored = ids(run())
    assert stored == closed(batch, 119) and len(stored) > 0

    # rows older than the watermark change nothing
    write(lines, "3.json", [(s, "late", p) for s in range(0, 30) for p in range(100, 130)])
    assert ids(run()) == stored


def test_kpis_over_both_folders(spark, tmp_path):
    lines = tmp_path / "lines"
    write(lines, "1.json", traffic(0, 90, 3))
    for name in ("floods", "sliding"):
        rule, options = RULES[name]
        flows = streaming.watermarked(source.stream_flows(spark, str(lines)))
        streaming.write_alerts(
            rule(flows, **options), str(tmp_path / name), str(tmp_path / f"{name}-c"), availableNow=True
        ).awaitTermination()
    stored = streaming.read_alert_folders(spark, str(tmp_path / "floods"), str(tmp_path / "sliding"))
    kpis = A.alert_kpis(stored).first()
    assert kpis.total_alerts == kpis.ddos_floods + kpis.port_scans + kpis.brute_force == stored.count()
    assert min(kpis.ddos_floods, kpis.port_scans, kpis.brute_force) > 0


def test_a_stream_needs_two_queries(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    with pytest.raises(ValueError, match="two streaming queries"):
        detect.all_alerts(source.stream_flows(spark, str(tmp_path / "lines")))


def test_statistics_from_a_drained_stream(spark, tmp_path):
    lines = tmp_path / "lines"
    write(lines, "1.json", traffic(0, 60, 4))
    flows = streaming.watermarked(source.stream_flows(spark, str(lines)))
    found = streaming.drain(spark, detect.flood_alerts(flows, threshold=25), "drained")
    total = {r.dimension: r["count"] for r in A.alert_statistics(found).collect() if r.value is None}
    assert total == {"total": found.count()} and found.count() > 0


def keep(spark, tmp_path, rows, name):
    """Store alerts in the live folder."""
    from flowengine.schema import ALERT_SCHEMA
    from flowengine.sinks import files

    frame = spark.createDataFrame(
        [(f"{name}{k}", kind) for k, kind in enumerate(rows)], "alert_id string, attack_type string"
    )
    files.append_rows(frame, str(tmp_path / "live"), ALERT_SCHEMA)


def test_kpis_grow_with_the_alerts_across_restarts(spark, tmp_path):
    """Each alert file is read once; a batch that is repeated counts once."""
    live, store, checkpoint = (str(tmp_path / n) for n in ("live", "kpis", "checkpoint"))

    def refresh():
        query = streaming.refresh_kpis(spark, [live], store, checkpoint)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    assert tuple(streaming.read_kpis(spark, store).first()) == (0, 0, 0, 0)
    keep(spark, tmp_path, ["DDoS_FLOOD", "PORT_SCAN", "PORT_SCAN", None], "a")
    assert refresh() == 4
    keep(spark, tmp_path, ["BRUTE_FORCE", "DDoS_FLOOD"], "b")
    assert refresh() == 2 and refresh() == 0
    want = A.alert_kpis(streaming.read_alert_folders(spark, live)).first()
    assert tuple(streaming.read_kpis(spark, store).first()) == tuple(want) == (6, 2, 2, 1)

    # the last batch did not get to its commit, so it is run again
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    refresh()
    assert tuple(streaming.read_kpis(spark, store).first()) == (6, 2, 2, 1)


def test_dropped_rows_are_counted_batch_by_batch(spark, tmp_path):
    lines = tmp_path / "lines"
    checkpoint = str(tmp_path / "checkpoint")
    log = streaming.DropLog()

    def run():
        flows = streaming.watermarked(source.stream_flows(spark, str(lines), observe=True))
        found = detect.flood_alerts(flows, threshold=3)
        query = streaming.write_alerts(found, str(tmp_path / "store"), checkpoint, availableNow=True)
        query.awaitTermination()
        for progress in query.recentProgress:
            log.record(progress)

    write(lines, "1.json", [(s, "a", 1) for s in range(100)])
    text = (lines / "1.json").read_text()
    (lines / "1.json").write_text(
        text + '{"src_ip": "b"}\n{"timestamp": "yesterday"}\n{"timestamp": 5}\n[1]\n{"a"\n'
    )
    run()
    # "not json", the empty line, the list and the broken object; 5 is no time either
    assert log.totals == {
        "lines": 107, "malformed": 4, "without_timestamp": 1, "unreadable_timestamp": 2, "late": 0,
    }
    write(lines, "2.json", [(s, "a", 1) for s in range(0, 20)] + [(150, "a", 1)])
    run()
    assert log.totals["late"] > 0 and log.totals["lines"] == 107 + 23
    counts = log.batches(spark)
    assert counts.selectExpr("sum(lines)", "sum(malformed)").first() == (130, 6)


def test_a_port_is_one_row_of_state_for_each_pane(spark, tmp_path):
    """The first aggregation of the sliding rules holds panes, not the windows over them."""
    lines = tmp_path / "lines"
    write(lines, "1.json", [(s, "a", p) for s in range(20, 28) for p in (22, 80) for _ in range(5)])
    flows = streaming.watermarked(source.stream_flows(spark, str(lines)))
    query = streaming.write_alerts(
        detect.sliding_alerts(flows), str(tmp_path / "s"), str(tmp_path / "c"), availableNow=True
    )
    query.awaitTermination()
    first = [p for p in query.recentProgress if p.numInputRows][0]
    # two panes of five seconds, two ports; later operators only get what is closed
    assert sorted(s.numRowsTotal for s in first.stateOperators) == [0, 0, 4]


def test_a_scan_of_neighbouring_ports_is_few_rows_of_state(spark, tmp_path):
    """Blocks of 64 ports share a row of a pane, and four blocks one of a window."""
    lines = tmp_path / "lines"
    write(lines, "1.json", [(s, "a", p) for s in (20, 26) for p in range(1024, 1024 + 256)])
    flows = streaming.watermarked(source.stream_flows(spark, str(lines)))
    checkpoint, store = str(tmp_path / "c"), str(tmp_path / "s")

    def run():
        query = streaming.write_alerts(
            detect.sliding_alerts(flows), store, checkpoint, availableNow=True
        )
        query.awaitTermination()
        return [sorted(s.numRowsUpdated for s in p.stateOperators) for p in query.recentProgress]

    assert max(max(rows) for rows in run()) == 8
    # the panes close, and are copied into seven windows
    write(lines, "2.json", [(200, "b", None)])
    assert max(max(rows) for rows in run()) == 7
    alerts = streaming.read_alert_folders(spark, store).collect()
    assert {(a.attack_type, a.metric_count) for a in alerts} == {("PORT_SCAN", 256)}
    assert len(alerts) == 7
