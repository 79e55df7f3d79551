"""Flow records from text, columnar files and JSON streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowengine.functions.scalars import event_time
from flowengine.functions.text import strip_blanks
from flowengine.schema import FLOW_SCHEMA

_CORRUPT = "_corrupt_record"

# Names of the metrics on lines and on flows that `parse_flow_json` has observed.
OBSERVED = ("flow_lines", "flow_times")


def with_event_time(flows: DataFrame) -> DataFrame:
    """Add `event_ts`, the instant every window operator works on."""
    return flows.withColumn("event_ts", event_time())


def rejected_flows(flows: DataFrame) -> DataFrame:
    """All flows, and those whose timestamp is missing or in no known form: no window operator
    can place them, so a monitor should watch the second number."""
    return flows.agg(F.count("*").alias("flows"), *_unplaced())


def _unplaced() -> list[Column]:
    return [
        F.count_if(F.col("timestamp").isNull()).alias("without_timestamp"),
        F.count_if(F.col("timestamp").isNotNull() & F.col("event_ts").isNull())
        .alias("unreadable_timestamp"),
    ]


def read_flows_csv(spark: SparkSession, path: str, empty_as_null: bool = False) -> DataFrame:
    """A1: comma-delimited files with a header line each, without quoting.

    A number that does not parse is NULL. An empty text field stays an empty string,
    so an unlabelled row still counts as a group of its own; `empty_as_null` reads it
    as missing, which is what the dashboard's counts skip. A field that a short line does
    not have at all is NULL; fields beyond the last column are ignored, blank lines dropped.
    """
    names = [f.name for f in FLOW_SCHEMA.fields]
    lines = spark.read.text(path)
    data = lines.filter((F.col("value") != "") & (F.col("value") != ",".join(names)))
    fields = data.select(F.split("value", ",", -1).alias("fields"))
    flows = fields.select(
        *[
            F.get("fields", F.lit(k)).try_cast(f.dataType).alias(f.name)
            for k, f in enumerate(FLOW_SCHEMA.fields)
        ]
    )
    if not empty_as_null:
        return flows
    texts = [f.name for f in FLOW_SCHEMA.fields if isinstance(f.dataType, T.StringType)]
    return flows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def read_flow_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2: raw lines in one column `value`, for the positional counts."""
    return spark.read.text(path)


def read_flows_columnar(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A3: an ORC or Parquet copy; column and row-group pruning come with it."""
    return spark.read.schema(FLOW_SCHEMA).format(fmt).load(path)


def parse_flow_json(lines: DataFrame, observe: bool = False) -> DataFrame:
    """One JSON object per line to flow rows, on batch and streaming frames.

    Anything but a well-formed object is dropped. All fields are read as text and cast
    afterwards, so a port sent as "22" is the same as 22 and a bad number is NULL
    instead of spoiling its row.

    With `observe`, what is dropped or cannot be placed is counted on the way, in the metrics
    named by `OBSERVED`: on a stream its listeners get them batch by batch.
    """
    raw = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in FLOW_SCHEMA.fields]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # one element per line, filtered before it is spread out, so that a line is decoded once
    decoded = F.filter(
        F.array(F.from_json("value", raw, options)), lambda row: row[_CORRUPT].isNull()
    )
    is_object = strip_blanks(F.col("value")).startswith("{")
    if observe:
        kept = F.when(is_object, decoded).otherwise(F.array().cast(T.ArrayType(raw)))
        objects = lines.select(kept.alias("kept")).observe(
            OBSERVED[0], F.count("*").alias("lines"),
            F.count_if(F.size("kept") == 0).alias("malformed"),
        ).select(F.inline("kept"))
    else:
        objects = lines.filter(is_object).select(F.inline(decoded))
    flows = with_event_time(
        objects.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in FLOW_SCHEMA.fields]
        )
    )
    return flows.observe(OBSERVED[1], *_unplaced()) if observe else flows


def stream_flows(
    spark: SparkSession, path: str, observe: bool = False, **options: str
) -> DataFrame:
    """A4: an unbounded folder of JSON-line files. For other transports, hand the text
    frame of any source (column `value`) to `parse_flow_json`."""
    return parse_flow_json(spark.readStream.options(**options).text(path), observe)


def sample_head(flows: DataFrame, n: int = 5000, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The first n rows in the given order, for a quick look; a top-k, not a sort of all. The
    KPIs never use it; they see every row."""
    return flows.orderBy(*order).limit(n)
