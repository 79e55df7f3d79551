"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# window state lives off-heap and is checkpointed as change logs, so it may
# outgrow executor memory and a lost executor restores it from the shared folder
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SETTINGS = {
    # flow timestamps carry no zone, so windows and their text form are pinned to UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    **STATE_SETTINGS,
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the engine's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


# work folders by Spark context, for `remove_work`
_made: dict[int, list[str]] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by `spark.checkpoint.dir`.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="flowengine-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(id(spark.sparkContext), []).append(path)
    return path


def remove_work(spark: SparkSession) -> int:
    """Delete what this application has written to work folders, and return how many there were.

    Frames read from them are lost: call it when all results are stored elsewhere.
    """
    paths = _made.pop(id(spark.sparkContext), [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
