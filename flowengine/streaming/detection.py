"""Detection on unbounded flows.

The rules are the batch functions; a stream only adds the watermark and the sink. Floods
and sliding rules run as two queries, each with its own state, checkpoint and folder, and
the alert collection is the union of the folders when read. A restarted query resumes
from its checkpoint, and the file sink commits each batch once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowengine.functions.scalars import iso_text
from flowengine.operators.maintain import conform
from flowengine.schema import ALERT_SCHEMA
from flowengine.session import STATE_SETTINGS, work_path
from flowengine.sources import flows as source
from flowengine.sources.alerts import read_alerts, read_or_empty

LATENESS = "10 seconds"

KPI_SCHEMA = "attack_type string, alerts bigint, batch bigint"


def watermarked(flows: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """T5: state of windows older than the newest event by `lateness` is dropped, and so
    are rows arriving later than that."""
    return flows.withWatermark("event_ts", lateness)


def write_alerts(alerts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every alert, once its window is closed, to a Parquet folder.

    `checkpoint` must be on storage all executors share, and stay with the folder. The
    session's state store settings are the engine's from here on.
    """
    for key, value in STATE_SETTINGS.items():
        alerts.sparkSession.conf.set(key, value)
    return (
        conform(alerts, ALERT_SCHEMA)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def read_alert_folders(spark: SparkSession, *paths: str) -> DataFrame:
    """The alert collection for KPIs and statistics."""
    return reduce(DataFrame.unionByName, [read_alerts(spark, path) for path in paths])


def refresh_kpis(
    spark: SparkSession, folders: Iterable[str], store: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Keep headline counts of alert folders up to date, reading each alert file once.

    The folders are a stream of alerts. Each batch is reduced to a count per attack type and
    written under its number, so that a batch repeated after a failure replaces what it wrote
    before; `read_kpis` adds the batches up. A restart goes on where `checkpoint` says. All
    folders must exist; without a trigger one run takes what is there and ends.
    """
    parts = [spark.readStream.schema(ALERT_SCHEMA).parquet(folder) for folder in folders]
    counted = reduce(DataFrame.unionByName, parts).select("attack_type")

    def fold(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy("attack_type").agg(F.count("*").alias("alerts"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return (
        counted.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_kpis(spark: SparkSession, store: str) -> DataFrame:
    """The headline counts that `refresh_kpis` has added up so far; 0 before its first
    batch. One row for each batch and attack type is read, no alert."""
    counts = read_or_empty(spark, store, KPI_SCHEMA)
    kind = F.col("attack_type")

    def total(those: Column | None = None) -> Column:
        n = F.col("alerts") if those is None else F.when(those, F.col("alerts"))
        return F.coalesce(F.sum(n), F.lit(0))

    return counts.agg(
        total().alias("total_alerts"),
        total(kind == "DDoS_FLOOD").alias("ddos_floods"),
        total(kind == "PORT_SCAN").alias("port_scans"),
        total(kind == "BRUTE_FORCE").alias("brute_force"),
    )


class DropLog(StreamingQueryListener):
    """A4/C20/T5: what each batch of the watched queries took in and dropped.

    Lines that are no JSON object and flows that no window can hold are counted where
    `source.stream_flows` is told to observe them, late rows by the state operators. The driver
    keeps the last `batches` rows and the sums of all.
    """

    COLUMNS = ("lines", "malformed", "without_timestamp", "unreadable_timestamp", "late")

    def __init__(self, batches: int = 1000):
        self.rows: deque[tuple] = deque(maxlen=batches)
        self.totals = dict.fromkeys(self.COLUMNS, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def onQueryTerminated(self, event) -> None:
        pass

    def record(self, progress) -> None:
        """Take one batch's progress into account."""
        seen = dict.fromkeys(self.COLUMNS, 0)
        for name in source.OBSERVED:
            if name in progress.observedMetrics:
                seen |= progress.observedMetrics[name].asDict()
        # the first operator drops what is late; later ones are only given what it kept
        states = progress.stateOperators
        seen["late"] = max((s.numRowsDroppedByWatermark for s in states), default=0)
        row = tuple(seen[c] or 0 for c in self.COLUMNS)
        self.rows.append((str(progress.name or ""), progress.batchId, *row))
        for column, n in zip(self.COLUMNS, row, strict=True):
            self.totals[column] += n

    def batches(self, spark: SparkSession) -> DataFrame:
        """(query, batch, lines, malformed, without_timestamp, unreadable_timestamp, late) of the
        last batches."""
        counts = ", ".join(f"{c} bigint" for c in self.COLUMNS)
        return spark.createDataFrame(list(self.rows), f"query string, batch bigint, {counts}")


def closing_line(flows: DataFrame, seconds: int) -> DataFrame:
    """One JSON line, `seconds` after the newest flow: it moves the watermark past every window
    that a flow is in, if `seconds` covers the window and the lateness. The line's own window
    stays open, so that it raises no alert, whatever the threshold, until more lines follow."""
    last = F.max("event_ts") + F.make_dt_interval(secs=F.lit(seconds))
    return flows.agg(F.to_json(F.struct(iso_text(last).alias("timestamp"))).alias("value"))


def drain(spark: SparkSession, alerts: DataFrame, name: str) -> DataFrame:
    """Run an alert stream over all input present, and read back what it wrote. The windows that
    the newest flows are in are only closed if the input ends with a `closing_line`."""
    path, checkpoint = work_path(spark, f"{name}-alerts"), work_path(spark, f"{name}-checkpoint")
    write_alerts(alerts, path, checkpoint, availableNow=True).awaitTermination()
    return read_alerts(spark, path)
