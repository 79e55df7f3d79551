"""Batch questions on flow records.

Every result is one partial/final hash aggregation, so a source, port or label that
holds most of the rows reaches the shuffle as one row per task. Top-k results end in a
distributed take-ordered with the key as the last sort column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowengine import schema
from flowengine.functions.scalars import hour_bucket, is_attack, is_not_benign, megabytes


def top_talkers(flows: DataFrame, n: int = 10) -> DataFrame:
    """The sources with the most connections."""
    return (
        flows.groupBy("src_ip")
        .agg(
            F.count("*").alias("total_connections"),
            F.sum("packet_count").alias("total_packets"),
            megabytes(F.sum("byte_count")).alias("total_mbytes"),
        )
        .orderBy(F.desc("total_connections"), "src_ip")
        .limit(n)
    )


def protocol_share(flows: DataFrame) -> DataFrame:
    """Rows per protocol and their percentage of all rows.

    The total is a scalar subquery over the grouped rows: no window that would move
    them all into one partition, and the grouped shuffle is read twice, not the table.
    """
    grouped = flows.groupBy("protocol").agg(F.count("*").alias("event_count"))
    total = grouped.select(F.sum("event_count")).scalar()
    return grouped.select(
        "protocol",
        "event_count",
        F.round(F.col("event_count") * F.lit(100.0) / total, 2).alias("percentage_share"),
    ).orderBy(F.desc("event_count"), "protocol")


def event_breakdown(flows: DataFrame) -> DataFrame:
    """Occurrences, mean duration and mean size per label."""
    return (
        flows.groupBy(F.col("label").alias("event_category"))
        .agg(
            F.count("*").alias("total_occurrences"),
            F.round(F.avg("duration"), 3).alias("avg_duration_sec"),
            F.round(F.avg("byte_count"), 2).alias("avg_bytes_per_flow"),
        )
        .orderBy(F.desc("total_occurrences"), "event_category")
    )


def hourly_attack_trend(flows: DataFrame) -> DataFrame:
    """Attacks per calendar hour and label."""
    return (
        flows.filter(is_attack())
        .groupBy(hour_bucket().alias("time_hour"), "label")
        .agg(F.count("*").alias("occurrences"))
        .orderBy("time_hour", F.desc("occurrences"), "label")
    )


def targeted_services(flows: DataFrame, n: int = 10) -> DataFrame:
    """The most attacked server and port pairs."""
    return (
        flows.filter(F.col("label").isin(*schema.PROBE_LABELS))
        .groupBy("dst_ip", "dst_port")
        .agg(F.count("*").alias("attack_probe_count"))
        .orderBy(F.desc("attack_probe_count"), "dst_ip", "dst_port")
        .limit(n)
    )


def packets_by_source(flows: DataFrame) -> DataFrame:
    """Reads two of the eleven columns."""
    return flows.groupBy("src_ip").agg(F.sum("packet_count").alias("total_packets"))


def suspicious_ssh(flows: DataFrame, port: int = 22, min_packets: int = 100) -> DataFrame:
    """Flows to SSH with more than `min_packets` packets."""
    return flows.filter((F.col("dst_port") == port) & (F.col("packet_count") > min_packets))


def flow_kpis(flows: DataFrame) -> DataFrame:
    """Rows, protocols, servers and the attack share in percent.

    Two distinct counts in one aggregate would triple every input row, so the rows are
    first reduced to one per (protocol, server) and counted from there.
    """
    pairs = flows.groupBy("protocol", "dst_ip").agg(
        F.count("*").alias("rows"), F.count_if(is_not_benign()).alias("attacks")
    )
    return pairs.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("flow_records"),
        F.count_distinct("protocol").alias("total_protocols"),
        F.count_distinct("dst_ip").alias("monitored_servers"),
        F.round(F.lit(100.0) * F.sum("attacks") / F.sum("rows"), 1).alias("attack_share_pct"),
    )


def value_counts(flows: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return (
        flows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def protocol_counts(flows: DataFrame) -> DataFrame:
    """E15."""
    return value_counts(flows, "protocol")


def label_counts(flows: DataFrame) -> DataFrame:
    """E15."""
    return value_counts(flows, "label")


def top_sources_display(flows: DataFrame, n: int = 10) -> DataFrame:
    """E16."""
    return (
        value_counts(flows, "src_ip")
        .limit(n)
        .select(F.col("src_ip").alias("Source IP"), F.col("count").alias("Events"))
    )


def targeted_ports(flows: DataFrame, n: int = 8) -> DataFrame:
    """The ports hit most by flows that are not benign."""
    return value_counts(flows.filter(is_not_benign()), "dst_port").limit(n)
