"""What the physical plans must and must not contain."""

import pytest

from flowengine.operators import traffic
from flowengine.plans import adapter, catalogue
from flowengine.sinks import files
from flowengine.sources import flows as source

SF = "/root/testdata/sf0.001"
QUERIES = catalogue.queries()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame)


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("copies")
    for fmt in ("orc", "parquet"):
        files.convert_flows(adapter.records(spark, SF), str(root / fmt), fmt)
    return {f: source.read_flows_columnar(spark, str(root / f), f) for f in ("orc", "parquet")}


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_two_of_eleven_columns_are_read(copies, fmt):
    assert "ReadSchema: struct<src_ip:string,packet_count:int>" in plan(traffic.packets_by_source(copies[fmt]))


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_filters_reach_the_scan(copies, fmt):
    ssh = plan(traffic.suspicious_ssh(copies[fmt]))
    assert "EqualTo(dst_port,22), GreaterThan(packet_count,100)" in ssh
    assert "Not(EqualTo(label,BENIGN))" in plan(traffic.hourly_attack_trend(copies[fmt]))
    assert "In(label, [BRUTE_FORCE,DDoS_FLOOD,PORT_SCAN])" in plan(traffic.targeted_services(copies[fmt]))


@pytest.mark.parametrize("name", ["top_talkers", "targeted_services", "targeted_ports", "recent_alerts"])
def test_top_k_is_distributed(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_nested_loops_no_single_partition_windows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("Python", "NestedLoop", "CartesianProduct", "ObjectHashAggregate(keys=[]"):
        assert word not in text
    if "Window [" in text:
        # every window function is partitioned by a key
        assert "Exchange SinglePartition, ENSURE_REQUIREMENTS" not in text.split("Window [")[1].split("Exchange")[0]


@pytest.mark.parametrize("name,columns", [
    ("flood_alerts", "ts:timestamp_ntz,user_id:bigint"),
    ("port_scan_alerts", "ts:timestamp_ntz,user_id:bigint,props:string"),
])
def test_a_rule_reads_its_columns_and_aggregates_before_the_shuffle(spark, name, columns):
    text = plan(QUERIES[name](spark, SF))
    assert f"ReadSchema: struct<{columns}>" in text
    scan_side = text[text.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in scan_side and "ObjectHashAggregate" not in text


def test_windows_below_the_threshold_never_become_rows(spark):
    text = plan(QUERIES["port_scan_alerts"](spark, SF))
    assert text.count("Exchange") == 2
    assert text.index("inline(") < text.index("greatest(") < text.index("bit_or(")


def test_share_of_total_reads_the_table_once(spark):
    text = final_plan(QUERIES["protocol_share"](spark, SF))
    assert text.split("== Initial Plan")[0].count("FileScan") + text.count("ReusedExchange") >= 1
    assert "ReusedExchange" in text


def test_updating_does_not_shuffle(spark, tmp_path):
    from flowengine.operators import maintain
    from flowengine.schema import ALERT_SCHEMA
    from flowengine.sources.alerts import read_alerts

    path = str(tmp_path / "alerts")
    files.append_rows(QUERIES["all_alerts"](spark, SF), path, ALERT_SCHEMA)
    text = plan(maintain.update_alert(read_alerts(spark, path), "ALT-1", {"status": "RESOLVED"}))
    main, subquery = text.split("Subquery", 1)
    assert "Exchange" not in main
    assert "EqualTo(alert_id,ALT-1)" in subquery


@pytest.mark.parametrize("name,reads", [
    ("all_alerts", 1), ("sliding_alerts", 1), ("count_windows_sliding", 1), ("compare_windows", 2),
    ("attack_detection", 2), ("match_alerts", 2),
])
def test_how_often_the_table_is_read(spark, name, reads):
    """Scans that ran; an exchange that is used again reads nothing."""
    frame = QUERIES[name](spark, SF)
    text = final_plan(frame).split("== Initial Plan ==")[0]
    scans = frame._jdf.queryExecution().executedPlan()
    assert _scans(scans) == reads, text


def _scans(node, seen=None):
    """File scans below a plan node, each exchange once; subqueries included."""
    seen = set() if seen is None else seen
    name = node.nodeName()
    if name.startswith("ReusedExchange") or name.startswith("ReusedSubquery"):
        return 0
    if name == "AdaptiveSparkPlan":
        return _scans(node.executedPlan(), seen)
    if name.endswith("QueryStage"):
        return _scans(node.plan(), seen)
    here = 1 if name.startswith("Scan parquet") else 0
    below = node.children()
    subqueries = node.subqueries()
    return here + sum(_scans(below.apply(k), seen) for k in range(below.size())) + sum(
        _scans(subqueries.apply(k), seen) for k in range(subqueries.size())
    )
