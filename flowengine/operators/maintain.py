"""Changing stored rows.

All functions return the changed rows; Spark cannot overwrite files it is reading, so
they become a new version of the store (`sinks.versions.change`).
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from flowengine import schema
from flowengine.sources.alerts import read_recent_alerts


def with_alert_defaults(alerts: DataFrame, now: Column | None = None) -> DataFrame:
    """The full alert row; a missing timestamp becomes the time of writing."""
    full = conform(alerts, schema.ALERT_SCHEMA)
    now = F.current_timestamp() if now is None else now
    return full.withColumn(
        "timestamp", F.coalesce("timestamp", F.date_format(now, schema.TIMESTAMP_FORMAT))
    )


def conform(rows: DataFrame, target) -> DataFrame:
    """Exactly the target's columns, NULL where a document has no such field."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def retain_latest(alerts: DataFrame, n: int = schema.ALERTS_KEPT) -> DataFrame:
    """The newest n alerts."""
    return read_recent_alerts(alerts, n)


def update_alert(
    alerts: DataFrame,
    alert_id: str,
    set_values: dict[str, Any],
    increment: dict[str, int] | None = None,
) -> DataFrame:
    """Set fields and add to counters of one alert; none is inserted if absent.

    A missing counter starts at 0. Should the id occur more than once, only the first
    row by timestamp changes (exact copies of it cannot be told apart and change with
    it). The first row is a scalar subquery with the id filter at the scan, so the
    table itself is neither shuffled nor joined.
    """
    increment = increment or {}
    names = [c for c in ("timestamp", *alerts.columns)]
    order = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)])
    matches = F.col("alert_id") == alert_id
    first = alerts.filter(matches).select(F.min(order)).scalar()
    chosen = matches & order.eqNullSafe(first)
    changed = {c: F.lit(v).cast(alerts.schema[c].dataType) for c, v in set_values.items()}
    changed |= {c: F.coalesce(F.col(c), F.lit(0)) + F.lit(by) for c, by in increment.items()}
    return alerts.select(
        *[
            F.when(chosen, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in alerts.columns
        ]
    )


def update_alerts(
    alerts: DataFrame,
    updates: DataFrame,
    set_columns: Iterable[str] = (),
    increments: dict[str, str] | None = None,
) -> DataFrame:
    """B7 in bulk: many updates of one alert each, as a table.

    `updates` has alert_id, in `set_columns` the alerts' new values (null leaves a field as it
    is) and, for each counter of `increments`, a column with what to add to it. As with single
    updates, none is inserted if its alert is absent, and of several alerts with one id the
    first by timestamp changes, exact copies of it included. Several updates of one id add up
    their increments; where they set a field to different values the largest stays, so that the
    result does not depend on the order of rows. A null id updates nothing.

    The updates are merged to one row for each id, which is joined to the matching alerts to
    find the first of them and then to all alerts. Alerts without an id are dealt by their
    contents, so that they do not meet in one task. Spark broadcasts the updates if their
    measured size allows it; otherwise both sides shuffle by id.
    """
    increments = increments or {}
    set_columns = list(set_columns)
    merged = updates.filter(F.col("alert_id").isNotNull()).groupBy("alert_id").agg(
        *[F.max(c).cast(alerts.schema[c].dataType).alias(f"set_{c}") for c in set_columns],
        *[F.sum(by).alias(f"add_{c}") for c, by in increments.items()],
    )
    # timestamp first, then everything else, so that the choice is repeatable
    order = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(("timestamp", *alerts.columns))])
    first = (
        alerts.join(merged.select("alert_id"), "alert_id", "left_semi")
        .groupBy("alert_id").agg(F.min(order).alias("first"))
    )
    # one row for each id, so that the table's rows are neither repeated nor lost
    patches = merged.join(first, "alert_id").withColumnRenamed("alert_id", "its_id")
    spread = F.when(F.col("alert_id").isNull(), F.xxhash64(*alerts.columns)).otherwise(0)
    joined = alerts.withColumn("spread", spread).join(
        patches.withColumn("its_spread", F.lit(0).cast("bigint")),
        (F.col("alert_id") == F.col("its_id")) & (F.col("spread") == F.col("its_spread")),
        "left",
    )
    chosen = order.eqNullSafe(F.col("first"))
    changed = {c: F.coalesce(F.col(f"set_{c}"), F.col(c)) for c in set_columns}
    changed |= {
        c: F.when(F.col(f"add_{c}").isNull(), F.col(c)).otherwise(
            (F.coalesce(F.col(c), F.lit(0)) + F.col(f"add_{c}")).cast(alerts.schema[c].dataType)
        )
        for c in increments
    }
    return joined.select(
        *[
            F.when(chosen, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in alerts.columns
        ]
    )


def purge(rows: DataFrame, column: str, value: Any) -> DataFrame:
    """All rows but those with this value; NULL is a different value."""
    return rows.filter(~F.col(column).eqNullSafe(F.lit(value)))


def purge_count(rows: DataFrame, column: str, value: Any) -> DataFrame:
    """How many rows `purge` deletes."""
    return rows.filter(F.col(column) == value).agg(F.count("*").alias("deleted"))
