"""Rules at, below and across their borders, and the two sliding formulations."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowengine.operators import detect, windows

ORIGIN = datetime(2024, 1, 1)
SCHEMA = "event_ts timestamp, src_ip string, dst_port int, byte_count bigint"


def flows(spark, rows):
    """rows of (second, source, port)"""
    data = [(ORIGIN + timedelta(seconds=s), ip, port, 100) for s, ip, port in rows]
    return spark.createDataFrame(data, SCHEMA)


def ends(alerts):
    origin = ORIGIN
    return sorted(
        int((datetime.fromisoformat(r.timestamp) - origin).total_seconds()) for r in alerts.collect()
    )


def test_flood_at_threshold(spark):
    frame = flows(spark, [(i % 10, "1.2.3.4", 80) for i in range(60)])
    (alert,) = detect.flood_alerts(frame).collect()
    assert alert.asDict() == {
        "alert_id": f"ALT-DDoS-{1704067200 + 10}-1_2_3_4",
        "timestamp": "2024-01-01T00:00:10",
        "src_ip": "1.2.3.4",
        "attack_type": "DDoS_FLOOD",
        "metric_count": 60,
        "threshold": 60,
        "window_type": "TUMBLING_10S",
        "severity": "HIGH",
        "details": "Volumetric flood: 60 requests in 10s tumbling window.",
    }


def test_flood_below_threshold(spark):
    assert detect.flood_alerts(flows(spark, [(i % 10, "a", 80) for i in range(59)])).count() == 0


def test_flood_across_a_border(spark):
    frame = flows(spark, [(9, "a", 80)] * 30 + [(10, "a", 80)] * 30)
    assert detect.flood_alerts(frame).count() == 0


def test_row_at_the_end_belongs_to_the_next_window(spark):
    frame = flows(spark, [(10, "a", 80)] * 60)
    assert ends(detect.flood_alerts(frame)) == [20]


def test_flood_bytes(spark):
    frame = flows(spark, [(1, "a", 80), (2, "a", 80), (3, "b", 80)]).withColumn(
        "byte_count", F.when(F.col("src_ip") == "b", F.col("byte_count"))
    )
    got = {r.src_ip: (r.request_count, r.byte_total) for r in windows.flood_windows(frame).collect()}
    assert got == {"a": (2, 0), "b": (1, 100)}


def test_missing_source_is_unknown(spark):
    frame = flows(spark, [(1, None, p) for p in range(60)])
    assert [r.src_ip for r in detect.flood_alerts(frame).collect()] == ["UNKNOWN"]
    assert {r.src_ip for r in detect.port_scan_alerts(frame).collect()} == {"UNKNOWN"}


def test_scan_in_every_window_holding_all_ports(spark):
    frame = flows(spark, [(p, "a", p) for p in range(12)])
    alerts = detect.port_scan_alerts(frame)
    # windows [-15, 15), [-10, 20), [-5, 25), [0, 30)
    assert ends(alerts) == [15, 20, 25, 30]
    first = alerts.first()
    assert (first.metric_count, first.severity, first.window_type) == (12, "MEDIUM", "SLIDING_30S")
    assert first.details == "Stealth Port Scan: 12 distinct ports probed in 30s sliding window."


def test_repeats_are_not_distinct_ports(spark):
    assert detect.port_scan_alerts(flows(spark, [(i, "a", i % 11) for i in range(40)])).count() == 0


def test_missing_port_is_no_port(spark):
    rows = [(1, "a", p) for p in range(11)] + [(1, "a", None)]
    assert detect.port_scan_alerts(flows(spark, rows)).count() == 0


def test_scan_straddling_a_tumbling_border(spark):
    rows = [(5 + p, "a", p) for p in range(5)] + [(11 + p, "a", 5 + p) for p in range(5)]
    frame = flows(spark, rows)
    assert detect.port_scan_alerts(frame, size=10, slide=10, threshold=8).count() == 0
    assert detect.port_scan_alerts(frame, threshold=8).count() == 5


def test_brute_force(spark):
    frame = flows(spark, [(i, "a", (21, 22, 3306)[i % 3]) for i in range(25)])
    alerts = detect.brute_force_alerts(frame).collect()
    assert {(a.metric_count, a.attack_type, a.severity) for a in alerts} == {(25, "BRUTE_FORCE", "HIGH")}
    assert alerts[0].details == "Brute Force attack: 25 auth attempts against administrative services in 30s."
    assert detect.brute_force_alerts(flows(spark, [(i, "a", 8080) for i in range(25)])).count() == 0


def scattered(n=3000, seed=7):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["a", "b", "c", None]
    return [
        (rng.randrange(-100, 400), rng.choice(sources), rng.choice([None, 21, 22, 3306, *range(40)]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("size,slide", [(30, 5), (30, 30), (10, 5), (60, 10)])
def test_panes_equal_window(spark, size, slide):
    frame = flows(spark, scattered())
    by_pane = windows.sliding_windows(frame, size, slide)
    by_row = windows.sliding_windows_by_row(frame, size, slide)
    assert by_pane.count() == by_row.count() > 0
    assert by_pane.exceptAll(by_row).count() == 0


def test_any_port_counts_once(spark):
    """Ports at the borders of blocks, beyond 16 bits, negative and missing ones."""
    ports = [-2**31, -65, -64, -1, 0, 63, 64, 127, 128, 255, 256, 3306, 65535, 65536, 2**31 - 1, None]
    rows = [(s, "a", p) for s in (0, 1, 7) for p in ports] + [(3, None, None), (4, None, 5)]
    got = {
        (r.window_end - ORIGIN).total_seconds(): (r.request_count, r.distinct_ports, r.auth_attempts)
        for r in windows.sliding_windows_by_row(flows(spark, rows), 10, 5).filter("src_ip = 'a'").collect()
    }
    assert got == {5: (32, 15, 2), 10: (48, 15, 3), 15: (16, 15, 1)}
    unknown = windows.sliding_windows_by_row(flows(spark, rows), 10, 5).filter("src_ip <> 'a'")
    assert {tuple(r)[3:] for r in unknown.collect()} == {(2, 1, 0)}


def test_copies_of_panes_are_summed_where_they_are_made(spark):
    """Panes are dealt by source and ports before they are copied into windows."""
    frame = flows(spark, [(s, f"s{k}", 80) for s in range(0, 600, 5) for k in range(20)])
    every = windows.sliding_windows_by_row(frame, 30, 5)
    assert every.count() == 20 * 125
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "Exchange hashpartitioning(src_ip" in plan


@pytest.mark.parametrize("stretch", [1, 3, 8])
def test_short_stretches_give_the_same_windows(spark, monkeypatch, stretch):
    monkeypatch.setattr(windows, "STRETCH_PANES", stretch)
    frame = flows(spark, scattered(1000))
    for size, slide in ((30, 5), (10, 10), (60, 10)):
        by_row = windows.sliding_windows_by_row(frame, size, slide)
        by_pane = windows.sliding_windows(frame, size, slide)
        assert by_pane.exceptAll(by_row).count() == by_row.exceptAll(by_pane).count() == 0


@pytest.mark.parametrize(
    "size,slide", [(30, 5), (30, 30), (10, 5), (80, 5), (85, 5), (160, 5), (165, 5), (200, 2)]
)
def test_threshold_windows_equal_window(spark, size, slide):
    """Windows shorter than a stretch, as long as one, and longer than several."""
    frame = flows(spark, scattered())
    every = windows.sliding_windows_by_row(frame, size, slide)
    borders = ("window_start", "window_end", "src_ip")
    for threshold in (1, 5, 30):
        for metric, got in (
            ("distinct_ports", windows.port_windows(frame, size, slide, threshold)),
            ("auth_attempts", windows.auth_windows(frame, size, slide, threshold)),
        ):
            want = every.filter(F.col(metric) >= threshold).select(*borders, metric)
            assert sorted(got.select(*borders, metric).collect()) == sorted(want.collect())


def test_slide_not_dividing_the_size(spark):
    frame = flows(spark, scattered(500))
    assert windows.sliding_windows(frame, 30, 7).exceptAll(
        windows.sliding_windows_by_row(frame, 30, 7)
    ).count() == 0
    got = detect.all_alerts(frame, slide=7, size=30, flood_threshold=5, scan_threshold=5, auth_threshold=2)
    want = detect.flood_alerts(frame, threshold=5).unionByName(
        detect.sliding_alerts(frame, 30, 7, 5, 2)
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_all_alerts_is_the_union_of_the_rules(spark):
    frame = flows(spark, scattered())
    got = detect.all_alerts(frame, flood_threshold=20, scan_threshold=20, auth_threshold=5)
    want = (
        detect.flood_alerts(frame, threshold=20)
        .unionByName(detect.port_scan_alerts(frame, threshold=20))
        .unionByName(detect.brute_force_alerts(frame, threshold=5))
    )
    assert sorted(got.collect()) == sorted(want.collect())
    assert {r.attack_type for r in want.collect()} == {"DDoS_FLOOD", "PORT_SCAN", "BRUTE_FORCE"}


def brute(rows, size, slide):
    """Windows by definition, one by one."""
    out = {}
    for s, ip, port in rows:
        start = s - s % slide
        while start > s - size:
            ports, auth, n = out.get((start + size, ip or "UNKNOWN"), (frozenset(), 0, 0))
            out[(start + size, ip or "UNKNOWN")] = (
                ports | ({port} if port is not None else set()),
                auth + (port in (21, 22, 3306)),
                n + 1,
            )
            start -= slide
    return {k: (n, len(p), a) for k, (p, a, n) in out.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(-50, 100), st.sampled_from(["a", "b", None]), st.sampled_from([None, 21, 22, 80])
        ),
        min_size=1,
        max_size=40,
    )
)
def test_panes_by_definition(spark, rows):
    got = {
        (int((r.window_end - ORIGIN).total_seconds()), r.src_ip): (
            r.request_count, r.distinct_ports, r.auth_attempts
        )
        for r in windows.sliding_windows(flows(spark, rows), 20, 5).collect()
    }
    assert got == brute(rows, 20, 5)
