import json

import pytest

from flowengine.operators import traffic
from flowengine.schema import ALERT_SCHEMA, FLOW_SCHEMA
from flowengine.sinks import files
from flowengine.sources import alerts as alert_source
from flowengine.sources import flows as source

HEADER = ",".join(f.name for f in FLOW_SCHEMA.fields)


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    rows = [
        '2024-01-01T00:00:00,10.0.0.1,10.0.0.5,1,22,TCP,5,500,0.5,"ACK,BENIGN',
        "2024-01-01T00:00:01,10.0.0.2,10.0.0.5,1,x,TCP,7,,0.5,SYN,",
    ]
    (folder / "a.csv").write_text(HEADER + "\n" + rows[0] + "\n")
    (folder / "b.csv").write_text(HEADER + "\n" + rows[1] + "\n")
    return str(folder)


def test_csv(spark, csv_folder):
    first, second = source.read_flows_csv(spark, csv_folder).orderBy("src_ip").collect()
    assert first.flag == '"ACK'  # no quoting
    assert (first.dst_port, first.byte_count, first.label) == (22, 500, "BENIGN")
    assert (second.dst_port, second.byte_count, second.packet_count) == (None, None, 7)
    assert second.label == ""


def test_csv_empty_label_is_an_attack_group_but_not_a_dashboard_value(spark, csv_folder):
    flows = source.read_flows_csv(spark, csv_folder)
    assert [r.label for r in traffic.hourly_attack_trend(flows).collect()] == [""]
    flows = source.read_flows_csv(spark, csv_folder, empty_as_null=True)
    assert [r.label for r in traffic.label_counts(flows).collect()] == ["BENIGN"]
    assert traffic.flow_kpis(flows).first().attack_share_pct == 50.0


def test_same_answer_from_every_format(spark, csv_folder, tmp_path):
    flows = source.read_flows_csv(spark, csv_folder)
    want = sorted(traffic.packets_by_source(flows).collect())
    for fmt in ("orc", "parquet"):
        path = str(tmp_path / fmt)
        files.convert_flows(flows, path, fmt)
        copy = source.read_flows_columnar(spark, path, fmt)
        assert sorted(traffic.packets_by_source(copy).collect()) == want
        assert sorted(map(str, copy.collect())) == sorted(map(str, flows.collect()))


GOOD = {
    "timestamp": "2024-01-01T00:00:07", "src_ip": "a", "dst_ip": "b", "src_port": 1, "dst_port": 22,
    "protocol": "TCP", "packet_count": 3, "byte_count": 5_000_000_000, "duration": 0.25, "flag": "SYN",
    "label": "BENIGN",
}


def parsed(spark, *lines):
    return source.parse_flow_json(spark.createDataFrame([(x,) for x in lines], "value string")).collect()


def test_json_row(spark):
    (row,) = parsed(spark, json.dumps(GOOD))
    assert {k: row[k] for k in GOOD} == GOOD
    assert row.event_ts.isoformat() == "2024-01-01T00:00:07"


def test_json_bad_lines_are_dropped(spark):
    bad = ["nope", "", "  ", "[1]", json.dumps([GOOD]), '{"src_ip": ', None, "null", "7"]
    assert parsed(spark, *bad) == []


def test_json_lenient_fields(spark):
    rows = parsed(
        spark,
        json.dumps({**GOOD, "dst_port": "22"}),
        json.dumps({**GOOD, "dst_port": "ssh", "extra": {"deep": [1]}}),
        json.dumps({k: v for k, v in GOOD.items() if k not in ("dst_port", "src_ip")}),
        json.dumps({**GOOD, "timestamp": "yesterday"}),
    )
    assert [r.dst_port for r in rows] == [22, None, None, 22]
    assert [r.src_ip for r in rows] == ["a", "a", None, "a"]
    assert rows[3].event_ts is None


def test_absent_alert_store_is_empty(spark, tmp_path):
    alerts = alert_source.read_alerts(spark, str(tmp_path / "nothing"))
    assert alerts.schema == ALERT_SCHEMA and alerts.count() == 0


def test_recent_alerts_order(spark):
    rows = [("b", "2"), ("a", "2"), ("c", "3"), ("d", "1"), ("e", None)]
    alerts = spark.createDataFrame(rows, "alert_id string, timestamp string")
    assert [r.alert_id for r in alert_source.read_recent_alerts(alerts, 3).collect()] == ["c", "a", "b"]


def test_sample_head(spark):
    rows = spark.createDataFrame([(f"2024-01-{d:02}", d) for d in range(20, 0, -1)], "timestamp string, i int")
    assert [r.i for r in source.sample_head(rows, 7).orderBy("i").collect()] == list(range(1, 8))


def test_timestamps_in_all_forms(spark):
    forms = ["2024-01-01T00:00:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.000Z",
             "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.5", "2024/01/01 00:00", None]
    flows = source.with_event_time(spark.createDataFrame([(f,) for f in forms], "timestamp string"))
    instants = [r.event_ts and r.event_ts.isoformat() for r in flows.collect()]
    assert instants == ["2024-01-01T00:00:00"] * 4 + ["2024-01-01T00:00:00.500000", None, None]
    assert tuple(source.rejected_flows(flows).first()) == (7, 1, 1)


def test_short_line_and_empty_field(spark, tmp_path):
    full = "t,s,d,1,2,TCP,3,4,0.5,ACK"
    (tmp_path / "a.csv").write_text("\n".join([HEADER, full, full + ",", full + ",X", ""]))
    rows = source.read_flows_csv(spark, str(tmp_path / "a.csv")).collect()
    assert sorted((r.label is None, r.label or "") for r in rows) == [(False, ""), (False, "X"), (True, "")]
    assert {(r.src_port, r.duration) for r in rows} == {(1, 0.5)}
