"""How rows and bytes are spread over shards and files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shard_of(key: str, shards: int) -> Column:
    """The shard of a key: the first 8 hexadecimal digits of its MD5, modulo the shards. Any
    engine can compute it; rows without a key are in shard 0."""
    return digest_shard(F.col(key), shards)


def digest_shard(value: Column, shards: int) -> Column:
    digits = F.substring(F.md5(value.cast("binary")), 1, 8)
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint") % shards, F.lit(0)).cast("int")


def layout_report(rows: DataFrame, shard: Column, shards: int | None = None) -> DataFrame:
    """Rows per shard, their share of all rows, and the skew: fullest over mean.

    `shards` is their number where empty ones are to count in the mean.
    """
    per_shard = rows.groupBy(shard.alias("shard")).agg(F.count("*").alias("rows"))
    total = per_shard.select(F.sum("rows")).scalar()
    fullest = per_shard.select(F.max("rows")).scalar()
    number = F.lit(shards) if shards else per_shard.select(F.count("*")).scalar()
    return per_shard.select(
        "shard",
        "rows",
        F.round(F.col("rows") * F.lit(100.0) / total, 2).alias("share_pct"),
        F.round(fullest * number / (total * F.lit(1.0)), 3).alias("skew"),
    )


def storage_footprint(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Files and bytes per table.

    A listing of the folders; the files themselves are not opened, whatever their format.
    """
    listings = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.lit(name).alias("table"), "length")
        for name, path in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, listings)
        .groupBy("table")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
