"""Batch questions where the driver's tables have no such rows: NULLs and ties."""

import pytest

from flowengine.operators import traffic
from flowengine.schema import FLOW_SCHEMA


@pytest.fixture
def flows(spark):
    def row(src, proto, label, port=80, packets=5, dst="10.0.0.5"):
        return ("2024-01-01T05:06:07", src, dst, 1, port, proto, packets, 1048576, 0.5, "SYN", label)

    return spark.createDataFrame(
        [
            row("b", "TCP", "BENIGN"), row("a", "TCP", "PORT_SCAN", 22, 520), row("b", "UDP", None),
            row("a", None, "BOTNET"), row(None, "TCP", "PORT_SCAN", 22, 100, None),
        ],
        FLOW_SCHEMA,
    )


def test_unlabelled_flows(flows):
    assert sum(r.occurrences for r in traffic.hourly_attack_trend(flows).collect()) == 3
    assert traffic.flow_kpis(flows).first().asDict() == {
        "flow_records": 5, "total_protocols": 2, "monitored_servers": 1, "attack_share_pct": 80.0,
    }
    assert [tuple(r) for r in traffic.targeted_ports(flows).collect()] == [(22, 2), (80, 2)]


def test_counts_skip_null_and_order_ties_by_value(flows):
    assert [tuple(r) for r in traffic.label_counts(flows).collect()] == [
        ("PORT_SCAN", 2), ("BENIGN", 1), ("BOTNET", 1)
    ]
    assert [tuple(r) for r in traffic.top_sources_display(flows, 1).collect()] == [("a", 2)]


def test_botnet_is_no_probe(flows):
    got = [tuple(r) for r in traffic.targeted_services(flows).collect()]
    assert got == [(None, 22, 1), ("10.0.0.5", 22, 1)]


def test_share_and_breakdown(flows):
    assert [tuple(r) for r in traffic.protocol_share(flows).collect()] == [
        ("TCP", 3, 60.0), (None, 1, 20.0), ("UDP", 1, 20.0)
    ]
    assert tuple(traffic.event_breakdown(flows).first()) == ("PORT_SCAN", 2, 0.5, 1048576.0)
    assert [tuple(r) for r in traffic.top_talkers(flows, 2).collect()] == [("a", 2, 525, 2.0), ("b", 2, 10, 2.0)]


def test_ssh(flows):
    assert [r.packet_count for r in traffic.suspicious_ssh(flows).collect()] == [520]


def test_empty_table(spark):
    empty = spark.createDataFrame([], FLOW_SCHEMA)
    assert tuple(traffic.flow_kpis(empty).first()) == (0, 0, 0, None)
    assert traffic.protocol_share(empty).collect() == []
