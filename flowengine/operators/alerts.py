"""Questions on the alert collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowengine.functions.scalars import severity_badge
from flowengine.sources.alerts import read_recent_alerts


def high_severity_alerts(alerts: DataFrame) -> DataFrame:
    """C6."""
    return alerts.filter(F.col("severity") == "HIGH")


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    """Number, mean and maximum metric per attack type."""
    return (
        alerts.groupBy("attack_type")
        .agg(
            F.count("*").alias("total_alerts"),
            F.avg("metric_count").alias("avg_metric_count"),
            F.max("metric_count").alias("max_metric_count"),
        )
        .orderBy(F.desc("total_alerts"), "attack_type")
    )


def top_attackers(alerts: DataFrame, n: int = 5) -> DataFrame:
    """The sources with the most alerts, and their attack types.

    Counted per (source, type) first, so what is collected per source is one entry per
    distinct type, whatever number of alerts it raised.
    """
    return (
        alerts.groupBy("src_ip", "attack_type")
        .agg(F.count("*").alias("alerts"))
        .groupBy("src_ip")
        .agg(
            F.sum("alerts").alias("alert_count"),
            F.sort_array(F.collect_list("attack_type")).alias("attack_types"),
        )
        .orderBy(F.desc("alert_count"), "src_ip")
        .limit(n)
    )


def alert_statistics(alerts: DataFrame) -> DataFrame:
    """Total, per type and per source over all alerts, in one pass.

    Counted per (type, source) first, so each alert is one row of the shuffle at most.

    Rows are (dimension, value, count), with dimension total, attack_type or src_ip. The
    total is there, as 0, for an empty store too.
    """
    entries = F.array(
        F.struct(F.lit("total").alias("dimension"), F.lit(None).cast("string").alias("value")),
        *[
            F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c), F.lit("UNKNOWN")).alias("value"))
            for c in ("attack_type", "src_ip")
        ],
    )
    grouped = alerts.groupBy("attack_type", "src_ip").agg(F.count("*").alias("n"))
    counted = grouped.select(F.inline(entries), "n")
    no_alert = alerts.sparkSession.range(1).select(
        F.lit("total").alias("dimension"), F.lit(None).cast("string").alias("value"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        counted.unionByName(no_alert).groupBy("dimension", "value").agg(F.sum("n").alias("count"))
    )


def alert_type_series(alerts: DataFrame) -> DataFrame:
    """Alerts per type, for a bar chart."""
    return alerts.groupBy(
        F.coalesce(F.col("attack_type"), F.lit("UNKNOWN")).alias("Attack Type")
    ).agg(F.count("*").alias("Alert Count"))


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Headline counts over all alerts; a type without any is 0."""
    kind = F.col("attack_type")
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.count_if(kind == "DDoS_FLOOD").alias("ddos_floods"),
        F.count_if(kind == "PORT_SCAN").alias("port_scans"),
        F.count_if(kind == "BRUTE_FORCE").alias("brute_force"),
    )


def alert_display(alerts: DataFrame, n: int = 15) -> DataFrame:
    """The newest n alerts under their display names, which are fixed values."""
    return read_recent_alerts(alerts, n).select(
        F.col("timestamp").alias("Time"),
        F.col("src_ip").alias("Attacker IP"),
        F.col("attack_type").alias("Attack Type"),
        F.col("metric_count").alias("Metric"),
        F.col("window_type").alias("Window"),
        severity_badge().alias("Severity"),
        F.coalesce(F.col("details"), F.lit("Anomaly identified")).alias("Details"),
    )
