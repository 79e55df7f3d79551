"""The window designs against two known attacks, whose figures can be worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from flowengine.operators import evaluate
from flowengine.schema import ATTACK_SCHEMA

ATTACKS = [(1, "BURST_FLOOD", "198.51.100.42", 300, 40), (2, "STEALTH_SCAN", "203.0.113.88", 800, 150)]


@pytest.fixture
def attacks(spark):
    return spark.createDataFrame(ATTACKS, ATTACK_SCHEMA)


@pytest.fixture
def events(spark):
    i = F.col("id")
    flood, scan = i.between(300, 339), i.between(800, 949)
    ports = F.array(F.lit(80), F.lit(443), F.lit(22))
    return spark.range(2000).select(
        i.alias("i"),
        F.when(flood, "198.51.100.42")
        .when(scan, "203.0.113.88")
        .otherwise(F.concat(F.lit("192.168.1."), (i % 21 + 10).cast("string")))
        .alias("ip"),
        F.when(flood, 80).when(scan, i - 799).otherwise(F.get(ports, i % 3)).cast("int").alias("port"),
    )


def latencies(alerts, ip, start):
    return sorted(r.idx - start for r in alerts.collect() if r.ip == ip)


def test_tumbling(events, attacks):
    alerts = evaluate.tumbling_count_alerts(events)
    assert latencies(alerts, "198.51.100.42", 300) == [99]
    assert latencies(alerts, "203.0.113.88", 800) == [99, 199]
    assert alerts.count() == 3


def test_sliding(events, attacks):
    alerts = evaluate.sliding_count_alerts(events)
    assert latencies(alerts, "198.51.100.42", 300) == list(range(49, 300, 50))
    assert latencies(alerts, "203.0.113.88", 800) == list(range(49, 400, 50))
    assert alerts.count() == 14


def test_comparison(events, attacks):
    table = evaluate.compare_windows(
        evaluate.tumbling_count_alerts(events), evaluate.sliding_count_alerts(events), attacks
    )
    tumbling, sliding = table.orderBy(F.desc("design")).collect()
    assert round(tumbling.mean_latency_s, 2) == 13.23
    assert round(sliding.mean_latency_s, 2) == 20.26
    assert (tumbling.mean_first_alert_s, sliding.mean_first_alert_s) == (9.9, 4.9)
    for row in (tumbling, sliding):
        assert (row.recall, row.precision, row.attacks, row.detected_attacks) == (1.0, 1.0, 2, 2)
    assert (tumbling.alerts, sliding.alerts) == (3, 14)


def test_no_alerts_at_all(spark, attacks):
    none = spark.createDataFrame([], "idx bigint, ip string")
    row = evaluate.detection_quality(none, attacks, "TUMBLING", 10.0).first()
    assert (row.mean_latency_s, row.recall, row.precision, row.alerts) == (10.0, 0.0, None, 0)
    assert row.mean_first_alert_s is None


def test_false_and_early_alerts(spark, attacks):
    alerts = spark.createDataFrame(
        [(299, "198.51.100.42"), (310, "198.51.100.42"), (310, "192.168.1.1")], "idx bigint, ip string"
    )
    row = evaluate.detection_quality(alerts, attacks, "SLIDING", 5.0).first()
    assert (row.mean_latency_s, row.recall, row.matched_alerts) == (1.0, 0.5, 1)
    assert row.precision == pytest.approx(1 / 3)
    got = {r.type: (r.detected, r.first_alert_s) for r in evaluate.attack_detection(alerts, attacks).collect()}
    assert got == {"BURST_FLOOD": (True, 1.0), "STEALTH_SCAN": (False, None)}


def test_alerts_without_an_address_are_still_alerts(spark, attacks):
    alerts = spark.createDataFrame([(310, None), (310, "198.51.100.42")], "idx bigint, ip string")
    row = evaluate.detection_quality(alerts, attacks, "SLIDING", 5.0).first()
    assert (row.alerts, row.matched_alerts, row.detected_attacks) == (2, 1, 1)


def test_last_partial_bucket_is_not_evaluated(spark):
    events = spark.range(199).select(F.col("id").alias("i"), F.lit("a").alias("ip"), F.lit(80).alias("port"))
    assert [r.idx for r in evaluate.tumbling_count_alerts(events).collect()] == [99]
    assert sorted(r.idx for r in evaluate.sliding_count_alerts(events).collect()) == [49, 99, 149]
    assert [r.idx for r in evaluate.tumbling_count_alerts(events, n_events=200).collect()] and (
        evaluate.tumbling_count_alerts(events, n_events=200).count() == 2
    )


def test_labels(events, attacks):
    labelled = evaluate.label_events(events, attacks)
    got = {r.attack_type: r["count"] for r in labelled.groupBy("attack_type").count().collect()}
    assert got == {"BURST_FLOOD": 40, "STEALTH_SCAN": 150, None: 1810}
    assert labelled.filter("is_anomaly").count() == 190


@pytest.mark.parametrize("block", [0, 3, 8])
def test_overlapping_attacks_by_definition(spark, block):
    rng = random.Random(block)
    intervals = [(n, f"T{n}", "x", rng.randrange(0, 500), rng.choice([0, 1, 5, 60, 300])) for n in range(60)]
    rng.shuffle(intervals)
    events = spark.range(600).select(F.col("id").alias("i"), F.lit("x").alias("ip"), F.lit(1).alias("port"))
    labelled = evaluate.label_events(events, spark.createDataFrame(intervals, ATTACK_SCHEMA), block)
    got = {r.i: r.attack_no for r in labelled.collect()}
    want = {
        i: min((n for n, _, _, s, d in intervals if s <= i < s + d), default=None) for i in range(600)
    }
    assert got == want


def test_intervals_are_cut_into_few_aligned_pieces(spark):
    rng = random.Random(5)
    intervals = [(n, "T", "x", rng.randrange(0, 10_000), rng.choice([0, 1, 2, 7, 64, 999, 5000])) for n in range(80)]
    pieces = evaluate._aligned_pieces(spark.createDataFrame(intervals, ATTACK_SCHEMA)).collect()
    for n, _, _, start, duration in intervals:
        own = [(r.piece << r.level, (r.piece + 1) << r.level) for r in pieces if r.attack_no == n]
        assert len(own) <= 2 * max(1, duration.bit_length())
        assert sorted(i for a, b in own for i in range(a, b)) == list(range(start, start + duration))


@pytest.mark.parametrize("stretch", [1, 10, 1 << 16])
def test_matches_by_definition(spark, monkeypatch, stretch):
    monkeypatch.setattr(evaluate, "STRETCH_EVENTS", stretch)
    rng = random.Random(3)
    attacks = [(n, "T", rng.choice("ab"), rng.randrange(0, 100, 5), 5) for n in range(30)]  # some equal
    alerts = [(rng.randrange(95), rng.choice("abc")) for _ in range(60)]
    frames = (
        spark.createDataFrame(alerts, "idx bigint, ip string"), spark.createDataFrame(attacks, ATTACK_SCHEMA)
    )
    got = {
        (r.ip, r.idx): (r.alerts, r.attacks, r.latency_sum) for r in evaluate.match_alerts(*frames).collect()
    }
    want, latencies = {}, []
    for idx, ip in alerts:
        lat = [idx - s for _, _, a, s, _ in attacks if a == ip and s <= idx]
        latencies += lat
        want[ip, idx] = (alerts.count((idx, ip)), len(lat), sum(lat))
    assert got == want

    got = {r.attack_no: r.first_alert_s for r in evaluate.attack_detection(*frames, 1.0).collect()}
    first = {
        n: min((idx - s for idx, ip in alerts if ip == a and idx >= s), default=None)
        for n, _, a, s, _ in attacks
    }
    assert got == first

    row = evaluate.detection_quality(*frames, "SLIDING", 5.0, 1.0).first()
    found = [x for x in first.values() if x is not None]
    assert row.mean_latency_s == pytest.approx(sum(latencies) / len(latencies))
    assert row.mean_first_alert_s == pytest.approx(sum(found) / len(found))
    assert (row.alerts, row.attacks, row.detected_attacks) == (60, 30, len(found))
    assert row.matched_alerts == sum(n for n, k, _ in want.values() if k)
