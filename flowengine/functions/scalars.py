"""Scalar rules on flow and alert columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from flowengine import schema


def source_or_unknown() -> Column:
    """Flows without a source are counted together."""
    return F.coalesce(F.col("src_ip"), F.lit(schema.UNKNOWN_SOURCE))


def hour_bucket() -> Column:
    """Date and hour, the first 13 characters of the timestamp text."""
    return F.substring("timestamp", 1, 13)


def megabytes(total_bytes: Column) -> Column:
    """C10."""
    return F.round(total_bytes / F.lit(1048576.0), 2)


def is_attack() -> Column:
    """C4, in SQL terms: an unlabelled flow is not an attack."""
    return F.col("label") != schema.BENIGN


def is_not_benign() -> Column:
    """C4, in dashboard terms: an unlabelled flow is not benign either."""
    return ~F.col("label").eqNullSafe(F.lit(schema.BENIGN))


def is_auth_port(ports: Iterable[int] = schema.AUTH_PORTS) -> Column:
    """C12."""
    return F.col("dst_port").isin(*ports)


def iso_text(instant: Column) -> Column:
    """C17."""
    return F.date_format(instant, schema.TIMESTAMP_FORMAT)


def event_time() -> Column:
    """The timestamp text as an instant, with or without fraction and offset; NULL where it
    does not parse (`sources.flows.rejected_flows` counts those)."""
    return F.try_to_timestamp(F.col("timestamp"), F.lit(schema.TIMESTAMP_FORMS))


def alert_id(tag: str, window_end: Column, source: Column) -> Column:
    """The same window always gets the same id, so replays repeat it."""
    return F.concat_ws(
        "-",
        F.lit("ALT"),
        F.lit(tag),
        F.unix_seconds(window_end).cast("string"),
        F.translate(source, ".", "_"),
    )


def severity_badge() -> Column:
    """C18."""
    return F.when(F.col("severity").eqNullSafe(F.lit("HIGH")), "HIGH").otherwise("MEDIUM")
