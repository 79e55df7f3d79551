"""Reading the alert collection."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from flowengine.schema import ALERT_SCHEMA


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All stored alerts; a store nobody has written to yet is empty."""
    return read_or_empty(spark, path, ALERT_SCHEMA)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet rows at a path, none if it is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_recent_alerts(alerts: DataFrame, n: int = 50) -> DataFrame:
    """A5: the newest n. Ties are broken by id, so the choice is repeatable."""
    return alerts.orderBy(F.desc("timestamp"), "alert_id").limit(n)
