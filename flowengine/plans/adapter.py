"""The `events` table read as flow records.

Plain arithmetic on the event columns, so that SQL can state the same mapping
(`oracles.FLOWS`). Every row of the table becomes one flow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowengine.schema import FLOW_SCHEMA

_FLOW = (
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp",
    "concat('192.168.', user_id div 250, '.', user_id % 250) AS src_ip",
    "concat('10.0.0.', event_id % 4) AS dst_ip",
    "int(1024 + event_id % 60000) AS src_port",
    "CASE k WHEN 33 THEN 3306 WHEN 43 THEN 443 ELSE k END AS dst_port",
    "CASE WHEN event_id % 10 < 7 THEN 'TCP' WHEN event_id % 10 < 9 THEN 'UDP' ELSE 'ICMP' END"
    " AS protocol",
    "int(1 + event_id % 50) AS packet_count",
    "bigint(round(value * 100)) AS byte_count",
    "value / 100 AS duration",
    "CASE WHEN event_type IN ('error', 'purchase') THEN 'SYN'"
    " WHEN event_type = 'signup' THEN 'PSH' ELSE 'ACK' END AS flag",
    "CASE WHEN event_type = 'error' THEN 'DDoS_FLOOD' WHEN event_type = 'purchase' THEN 'PORT_SCAN'"
    " WHEN event_type = 'signup' THEN 'BRUTE_FORCE' WHEN k < 10 THEN 'BOTNET' ELSE 'BENIGN' END"
    " AS label",
    "timestamp(ts) AS event_ts",
    "event_id AS i",
)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow rows with `event_ts` and the event number `i`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # k in a step of its own is parsed once per row, however many columns use it
    parsed = events.withColumn("k", F.expr("int(get_json_object(props, '$.k'))"))
    return parsed.selectExpr(*_FLOW)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven flow columns alone."""
    return flows(spark, sf_dir).select(*[f.name for f in FLOW_SCHEMA.fields])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows as raw comma-separated text."""
    columns = [F.col(f.name).cast("string") for f in FLOW_SCHEMA.fields]
    return records(spark, sf_dir).select(F.concat_ws(",", *columns).alias("value"))


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(i, ip, port)` for the evaluation of window designs."""
    return flows(spark, sf_dir).select("i", F.col("src_ip").alias("ip"), F.col("dst_port").alias("port"))


def attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attack intervals: per source, label and day, from the first such flow to the last."""
    start = F.min("i")
    return (
        flows(spark, sf_dir)
        .filter(F.col("label").isin("DDoS_FLOOD", "PORT_SCAN", "BRUTE_FORCE"))
        .groupBy(
            F.col("label").alias("type"),
            F.col("src_ip").alias("ip"),
            F.substring("timestamp", 1, 10).alias("day"),
        )
        .agg(
            start.alias("attack_no"),
            start.alias("start_idx"),
            (F.max("i") - start + 1).alias("duration"),
        )
        .select("attack_no", "type", "ip", "start_idx", "duration")
    )
