"""Counts by one positional field of raw flow lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowengine.functions.text import field_of_lines, normalise, strip_blanks


def protocol_count(lines: DataFrame) -> DataFrame:
    """Lines per protocol, case folded; an empty protocol is a key like any other."""
    return _count(field_of_lines(lines, 5, "field"), normalise(F.col("field")), "protocol")


def source_ip_count(lines: DataFrame) -> DataFrame:
    """Lines per source address, case kept."""
    return _count(field_of_lines(lines, 1, "field"), strip_blanks(F.col("field")), "src_ip")


def attack_distribution(lines: DataFrame) -> DataFrame:
    """Lines per label, case folded."""
    return _count(field_of_lines(lines, 10, "field"), normalise(F.col("field")), "label")


def _count(fields, key, name):
    return fields.groupBy(key.alias(name)).agg(F.count("*").alias("count"))
