"""Alert questions and maintenance."""

import pytest
from pyspark.sql import functions as F

from flowengine.operators import alerts as A
from flowengine.operators import maintain
from flowengine.schema import ALERT_SCHEMA
from flowengine.sinks import files
from flowengine.sources.alerts import read_alerts

SHORT = "alert_id string, timestamp string, src_ip string, attack_type string, metric_count bigint, severity string"


@pytest.fixture
def alerts(spark):
    rows = [
        ("ALT-1", "2024-01-01T00:00:01", "a", "DDoS_FLOOD", 150, "HIGH"),
        ("ALT-2", "2024-01-01T00:00:02", "a", "PORT_SCAN", 45, "MEDIUM"),
        ("ALT-3", "2024-01-01T00:00:02", "b", "BRUTE_FORCE", 35, "HIGH"),
        ("ALT-4", "2024-01-01T00:00:03", "a", "PORT_SCAN", 15, None),
        ("ALT-5", None, None, None, 1, "INFO"),
    ]
    return maintain.conform(spark.createDataFrame(rows, SHORT), ALERT_SCHEMA)


def test_by_type(alerts):
    got = [tuple(r) for r in A.alerts_by_type(alerts.filter("attack_type is not null")).collect()]
    assert got == [("PORT_SCAN", 2, 30.0, 45), ("BRUTE_FORCE", 1, 35.0, 35), ("DDoS_FLOOD", 1, 150.0, 150)]


def test_top_attackers(alerts):
    got = [tuple(r) for r in A.top_attackers(alerts, 1).collect()]
    assert got == [("a", 3, ["DDoS_FLOOD", "PORT_SCAN"])]


def test_statistics_count_missing_fields_as_unknown(alerts):
    got = {tuple(r) for r in A.alert_statistics(alerts).collect()}
    assert got == {
        ("total", None, 5),
        ("attack_type", "DDoS_FLOOD", 1), ("attack_type", "PORT_SCAN", 2),
        ("attack_type", "BRUTE_FORCE", 1), ("attack_type", "UNKNOWN", 1),
        ("src_ip", "a", 3), ("src_ip", "b", 1), ("src_ip", "UNKNOWN", 1),
    }


def test_statistics_and_kpis_see_all_alerts(spark):
    rows = [(f"ALT-{i:04}", f"2024-01-01T00:{i // 60:02}:{i % 60:02}", "a", "PORT_SCAN" if i else "OLD", 1, "HIGH")
            for i in range(501)]
    frame = spark.createDataFrame(rows, SHORT)
    assert A.alert_kpis(frame).first().asDict() == {
        "total_alerts": 501, "ddos_floods": 0, "port_scans": 500, "brute_force": 0,
    }
    assert {tuple(r) for r in A.alert_type_series(frame).collect()} == {("PORT_SCAN", 500), ("OLD", 1)}
    kept = maintain.retain_latest(frame)
    assert kept.count() == 500 and kept.filter("attack_type = 'OLD'").count() == 0


def test_kpis_of_an_empty_store(spark):
    empty = spark.createDataFrame([], ALERT_SCHEMA)
    assert set(A.alert_kpis(empty).first()) == {0}
    assert [tuple(r) for r in A.alert_statistics(empty).collect()] == [("total", None, 0)]


def test_display(alerts):
    rows = A.alert_display(alerts, 2).collect()
    assert [(r["Time"][-2:], r["Severity"], r["Details"]) for r in rows] == [
        ("03", "MEDIUM", "Anomaly identified"), ("02", "MEDIUM", "Anomaly identified")
    ]


def test_high_severity(alerts):
    assert sorted(r.alert_id for r in A.high_severity_alerts(alerts).collect()) == ["ALT-1", "ALT-3"]


def test_update_changes_one_row(alerts):
    done = {"status": "RESOLVED", "resolution_notes": "blocked"}
    once = maintain.update_alert(alerts, "ALT-2", done, {"retry_count": 1})
    twice = maintain.update_alert(once, "ALT-2", {}, {"retry_count": 1})
    changed = {r.alert_id: (r.status, r.resolution_notes, r.retry_count) for r in twice.collect()}
    assert changed.pop("ALT-2") == ("RESOLVED", "blocked", 2)
    assert set(changed.values()) == {(None, None, None)} and len(changed) == 4
    assert once.schema == alerts.schema


def test_update_of_a_repeated_id_takes_the_first(alerts):
    again = alerts.filter("alert_id = 'ALT-2'").withColumn("timestamp", F.lit("2024-01-02T00:00:00"))
    updated = maintain.update_alert(alerts.unionByName(again), "ALT-2", {"status": "RESOLVED"})
    assert [r.timestamp for r in updated.filter("status = 'RESOLVED'").collect()] == ["2024-01-01T00:00:02"]


def test_update_of_an_absent_id_changes_nothing(alerts):
    updated = maintain.update_alert(alerts, "ALT-9", {"status": "RESOLVED"})
    assert updated.exceptAll(alerts).count() == 0 and updated.count() == 5


def test_update_written_as_a_new_version(spark, alerts, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    files.append_rows(alerts, old, ALERT_SCHEMA)
    stored = read_alerts(spark, old)
    files.write_version(maintain.update_alert(stored, "ALT-1", {"status": "RESOLVED"}), new)
    assert read_alerts(spark, new).filter("status = 'RESOLVED'").count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_version(stored, new)
    files.clear_alerts(spark, new)
    assert read_alerts(spark, new).count() == 0


def test_purge(alerts):
    assert maintain.purge(alerts, "attack_type", "PORT_SCAN").count() == 3
    assert maintain.purge_count(alerts, "attack_type", "PORT_SCAN").first().deleted == 2
    assert maintain.purge_count(alerts, "attack_type", "TEMP_TEST").first().deleted == 0


def test_append_fills_defaults(spark, tmp_path):
    path = str(tmp_path / "alerts")
    now = F.lit("2024-03-01 10:11:12").cast("timestamp")
    for frame in (
        spark.createDataFrame([("ALT-1", "10.0.0.5", "OPEN")], "alert_id string, dst_ip string, status string"),
        spark.createDataFrame([("ALT-2", "2024-01-01T00:00:00")], "alert_id string, timestamp string"),
    ):
        files.append_rows(maintain.with_alert_defaults(frame, now), path, ALERT_SCHEMA)
    got = {r.alert_id: (r.timestamp, r.dst_ip, r.status) for r in read_alerts(spark, path).collect()}
    assert got == {
        "ALT-1": ("2024-03-01T10:11:12", "10.0.0.5", "OPEN"), "ALT-2": ("2024-01-01T00:00:00", None, None)
    }
