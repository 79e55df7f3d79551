"""Bulk updates and the versioned store."""

import threading

import pytest
from pyspark.sql import functions as F

from flowengine.operators import maintain
from flowengine.schema import ALERT_SCHEMA
from flowengine.sinks import versions
from flowengine.sources.alerts import read_recent_alerts


def alerts(spark, rows):
    """Alerts of (alert_id, timestamp, status, retry_count)."""
    frame = spark.createDataFrame(
        rows, "alert_id string, timestamp string, status string, retry_count int"
    )
    return maintain.conform(frame, ALERT_SCHEMA)


def short(frame):
    rows = frame.select("alert_id", "timestamp", "status", "retry_count").collect()
    return sorted(map(tuple, rows), key=str)


UPDATE = "alert_id string, status string, retries int"


def test_many_updates_at_once(spark):
    """Of equal ids the first changes; absent and null ids change nothing; counters add up."""
    stored = alerts(spark, [
        ("a", "2024-01-02", "OPEN", None), ("a", "2024-01-01", "OPEN", 4), ("b", "2024-01-01", None, 1),
        ("c", "2024-01-01", "OPEN", None), (None, "2024-01-01", "OPEN", None), (None, None, None, None),
    ])
    updates = spark.createDataFrame([
        ("a", "DONE", 1), ("a", None, 2), ("b", None, None), ("c", "B", None), ("c", "A", 1),
        ("none", "DONE", 1), (None, "DONE", 1),
    ], UPDATE)
    changed = maintain.update_alerts(stored, updates, ["status"], {"retry_count": "retries"})
    assert changed.columns == stored.columns
    assert short(changed) == sorted([
        ("a", "2024-01-02", "OPEN", None), ("a", "2024-01-01", "DONE", 7), ("b", "2024-01-01", None, 1),
        ("c", "2024-01-01", "B", 1), (None, "2024-01-01", "OPEN", None), (None, None, None, None),
    ], key=str)


def test_one_update_in_bulk_is_the_single_update(spark):
    stored = alerts(spark, [(f"a{k % 7}", f"2024-01-{k % 5 + 1:02d}", "OPEN", k) for k in range(40)])
    single = maintain.update_alert(stored, "a3", {"status": "DONE"}, {"retry_count": 2})
    updates = spark.createDataFrame([("a3", "DONE", 2)], UPDATE)
    bulk = maintain.update_alerts(stored, updates, ["status"], {"retry_count": "retries"})
    assert short(bulk) == short(single) != short(stored)


def test_no_updates_and_no_alerts(spark):
    stored = alerts(spark, [("a", "2024-01-02", "OPEN", None)])
    none = spark.createDataFrame([], UPDATE)
    assert short(maintain.update_alerts(stored, none, ["status"])) == short(stored)
    assert maintain.update_alerts(stored.filter("false"), none, ["status"]).count() == 0


def test_large_update_tables_are_not_broadcast(spark, tmp_path):
    stored = alerts(spark, [("a", "2024-01-02", "OPEN", None)])
    stored.write.parquet(str(tmp_path / "alerts"))
    wide = spark.range(400_000).select(
        F.concat(F.lit("ALT-"), F.sha2(F.col("id").cast("string"), 256)).alias("alert_id"),
        F.lit("DONE").alias("status"),
    )
    wide.write.parquet(str(tmp_path / "updates"))
    changed = maintain.update_alerts(
        spark.read.schema(ALERT_SCHEMA).parquet(str(tmp_path / "alerts")),
        spark.read.parquet(str(tmp_path / "updates")), ["status"],
    )
    assert changed.count() == 1
    plan = changed._jdf.queryExecution().executedPlan().toString()
    # of the three joins, only sides with the lone alert may be broadcast
    for block in plan.split("BroadcastExchange")[1:]:
        assert "updates" not in block.split("FileScan")[1].split("ReadSchema")[0]


# ---- versions

def store(spark, tmp_path):
    path = str(tmp_path / "store")
    first = alerts(spark, [(f"a{k}", f"2024-01-{k:02d}", "OPEN", None) for k in range(1, 10)])
    assert versions.append(spark, path, first) == 1
    return path


def ids(spark, path, version=None):
    rows = versions.read(spark, path, ALERT_SCHEMA, version).collect()
    return sorted(r.alert_id for r in rows)


def test_store_nobody_has_written_to_is_empty(spark, tmp_path):
    path = str(tmp_path / "store")
    assert versions.versions(spark, path) == []
    assert versions.read(spark, path, ALERT_SCHEMA).count() == 0
    assert versions.change(spark, path, ALERT_SCHEMA, lambda rows: rows) == 1


def test_every_change_is_a_version_and_earlier_ones_stay(spark, tmp_path):
    path = store(spark, tmp_path)
    versions.append(spark, path, alerts(spark, [("b", "2024-02-01", "OPEN", None)]))
    versions.change(spark, path, ALERT_SCHEMA, lambda rows: read_recent_alerts(rows, 3))
    versions.change(spark, path, ALERT_SCHEMA, lambda rows: maintain.purge(rows, "alert_id", "b"))
    versions.change(spark, path, ALERT_SCHEMA, lambda rows: rows.filter("false"))
    assert versions.versions(spark, path) == [1, 2, 3, 4, 5]
    assert [len(ids(spark, path, n)) for n in range(1, 6)] == [9, 10, 3, 2, 0]
    assert ids(spark, path, 4) == ["a8", "a9"] and ids(spark, path) == []


def test_an_append_does_not_rewrite(spark, tmp_path):
    path = store(spark, tmp_path)
    before = {p for p in (tmp_path / "store" / "data").rglob("*.parquet")}
    versions.append(spark, path, alerts(spark, [("b", "2024-02-01", "OPEN", None)]))
    assert before < {p for p in (tmp_path / "store" / "data").rglob("*.parquet")}
    assert len(versions._folders(spark, path, 2)) == 2


def test_the_second_of_two_writers_meets_a_conflict(spark, tmp_path):
    path = store(spark, tmp_path)
    seen = versions.read(spark, path, ALERT_SCHEMA, 1)
    assert versions.commit(seen.filter("alert_id = 'a1'"), path, based_on=1) == 2
    with pytest.raises(versions.Conflict):
        versions.commit(seen.filter("alert_id = 'a2'"), path, based_on=1)
    assert ids(spark, path) == ["a1"]


def test_a_change_is_repeated_on_what_was_committed_meanwhile(spark, tmp_path):
    path = store(spark, tmp_path)
    calls = []

    def slow(rows):
        calls.append(len(calls))
        if len(calls) == 1:  # another writer is faster, once
            versions.change(spark, path, ALERT_SCHEMA, lambda r: maintain.purge(r, "alert_id", "a1"))
        return maintain.purge(rows, "alert_id", "a2")

    assert versions.change(spark, path, ALERT_SCHEMA, slow) == 3 and len(calls) == 2
    assert ids(spark, path) == [f"a{k}" for k in range(3, 10)]
    with pytest.raises(versions.Conflict):
        calls.clear()
        versions.change(spark, path, ALERT_SCHEMA, slow, attempts=1)


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    path = store(spark, tmp_path)
    failed = []

    def purge(name):
        try:
            versions.change(
                spark, path, ALERT_SCHEMA, lambda r: maintain.purge(r, "alert_id", name), attempts=20
            )
        except Exception as error:  # reported below; a thread's own error would be lost
            failed.append(error)

    threads = [threading.Thread(target=purge, args=(f"a{k}",)) for k in range(1, 5)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    assert versions.versions(spark, path) == [1, 2, 3, 4, 5]
    assert ids(spark, path) == [f"a{k}" for k in range(5, 10)]


def test_what_is_written_but_not_committed_is_never_read(spark, tmp_path):
    path = store(spark, tmp_path)
    alerts(spark, [("half", None, None, None)]).write.parquet(f"{path}/data/half")
    (tmp_path / "store" / "_versions" / ".half").write_text('{"folders": ["data/half"]}')
    assert "half" not in ids(spark, path) and versions.versions(spark, path) == [1]


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    path = store(spark, tmp_path)
    for name in ("a1", "a2"):
        versions.change(
            spark, path, ALERT_SCHEMA, lambda r, n=name: maintain.purge(r, "alert_id", n)
        )
    assert versions.vacuum(spark, path, keep=2) == 1
    assert versions.versions(spark, path) == [2, 3]
    assert len(ids(spark, path, 2)) == 8 and len(ids(spark, path)) == 7
