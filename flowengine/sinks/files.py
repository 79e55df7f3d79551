"""Writing flows, counts and alerts.

Layout shuffles use rebalance partitioning: rows go to a partition by key, and at run
time any partition above `spark.sql.adaptive.advisoryPartitionSizeInBytes` is split by
the map outputs it came from. One source or day holding a third of all rows is therefore
written by many tasks, without salting the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowengine.operators.layout import digest_shard, shard_of
from flowengine.operators.maintain import conform
from flowengine.schema import ALERT_SCHEMA, FLOW_SCHEMA

# Ranges of time that one write is cut into; beyond, files get longer.
MOST_RANGES = 20_000

# Fixed values.
FORMAT_OPTIONS = {
    "orc": {"compression": "zlib", "orc.stripe.size": "67108864"},
    "parquet": {"compression": "zstd"},
    "csv": {"header": "true", "quote": "", "escapeQuotes": "false", "emptyValue": ""},
}


def convert_flows(flows: DataFrame, path: str, fmt: str) -> None:
    """B1/B2: rewrite flows as ORC, Parquet or CSV, without a shuffle.

    CSV has no quoting here, so a text with a comma or line break is refused with an error.
    """
    columns = [F.col(f.name) for f in FLOW_SCHEMA.fields]
    if fmt == "csv":
        columns = [_unquoted(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                   for f in FLOW_SCHEMA.fields]
    flows.select(*columns).write.mode("overwrite").options(**FORMAT_OPTIONS[fmt]).format(fmt).save(path)


def _unquoted(name: str) -> Column:
    """The text column, or an error where an unquoted line could not hold it."""
    text = F.col(name)
    message = F.concat(F.lit(f"{name} does not fit in an unquoted line: "), text)
    return F.when(text.rlike("[,\\r\\n]"), F.raise_error(message)).otherwise(text).alias(name)


def write_counts_tsv(counts: DataFrame, path: str) -> None:
    """`key<TAB>count` lines in key order over all part files; the folder must be new."""
    key, value = counts.columns
    line = F.concat_ws("\t", F.col(key), F.col(value).cast("string"))
    counts.orderBy(key).select(line.alias("value")).write.mode("errorifexists").text(path)


def append_rows(rows: DataFrame, path: str, schema) -> None:
    """Add documents; their schema may lack some of the table's fields."""
    conform(rows, schema).write.mode("append").parquet(path)


def write_version(rows: DataFrame, path: str) -> None:
    """Changed rows as a new folder; `sinks.versions` also keeps track of which is in force."""
    rows.write.mode("errorifexists").parquet(path)


def clear_alerts(spark: SparkSession, path: str) -> None:
    """Empty the store."""
    spark.createDataFrame([], ALERT_SCHEMA).write.mode("overwrite").parquet(path)


def write_hashed(rows: DataFrame, path: str, shards: int, key: str = "src_ip") -> None:
    """One folder per hash shard of the key, evenly sized files within."""
    rows = rows.withColumn("shard", shard_of(key, shards))
    rows.hint("rebalance", F.col("shard")).write.mode("errorifexists").partitionBy("shard").parquet(path)


def read_hashed(spark: SparkSession, path: str, shards: int, value: str, key: str = "src_ip") -> DataFrame:
    """The rows of one key value, from its shard's folder only."""
    # the value's shard is folded to a constant, so the other folders are not listed
    shard: Column = digest_shard(F.lit(value), shards)
    rows = spark.read.parquet(path)
    return rows.filter((F.col("shard") == shard) & (F.col(key) == value)).drop("shard")


def write_ranged(
    rows: DataFrame, path: str, timestamp: str = "timestamp", ranges: int | None = None
) -> None:
    """One folder per day, and within it files of stretches of time that do not overlap.

    Rows are dealt by ranges of the timestamp that Spark samples, so a day is spread over tasks by
    its share of the rows; only an instant with more rows than a range is in several files. A time
    range reads few folders and, by the files' own minima and maxima, few files of them. The number
    of ranges comes from the plan's estimate of the size, if it is not given.
    """
    # a stable number apart for rows of one instant
    apart = F.xxhash64(F.monotonically_increasing_id())
    (
        rows.withColumn("day", F.substring(timestamp, 1, 10)).withColumn("apart", apart)
        .repartitionByRange(ranges or _ranges(rows), timestamp, "apart")
        .sortWithinPartitions("day", timestamp)
        .drop("apart")
        .write.mode("errorifexists")
        .partitionBy("day")
        .parquet(path)
    )


def _ranges(rows: DataFrame) -> int:
    """Partitions of about the advisory size, by the plan's statistics."""
    spark = rows.sparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    each = spark._jsparkSession.sessionState().conf().getConf(
        spark._jvm.org.apache.spark.sql.internal.SQLConf.ADVISORY_PARTITION_SIZE_IN_BYTES()
    )
    return min(max(1, -(-size // each)), MOST_RANGES)


def write_bucketed(
    rows: DataFrame, table: str, path: str, buckets: int, key: str = "src_ip"
) -> None:
    """B10 as a table: rows bucketed and sorted by the key, so that grouping by it and joining
    tables of the same buckets need no shuffle, and one value's rows are in one bucket's files.

    Rows are dealt by bucket before the write, a file or a few for each; a bucket with a hot
    key's rows is larger than the others, which no placement by key can avoid.
    """
    (
        rows.repartition(buckets, key)
        .write.mode("errorifexists").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key)
        .saveAsTable(table)
    )
