"""What the operators share: tables, materialised steps and safe cuts through texts."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowengine.session import work_path

#: Words are runs of anything but ASCII white space.
SPACE_CLASS = r"\x20\x09-\x0D"

# A blank or newline after a non-blank starts a new piece in every byte-level BPE split rule: no
# rule's match runs from a non-blank into white space, and none looks behind.
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")
_PIECES = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")

_sent: set[str] = set()

#: Bytes that a function sees at a time, if no row has more.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared work folder and read back.

    Later steps start from the files, so a lost executor costs no recomputation of what came
    before, and a step that several others read is computed once.
    """
    spark = frame.sparkSession
    path = work_path(spark, f"llm-{name}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def running(
    frame: DataFrame, order: list[Column | str], sums: dict[str, Column], name: str
) -> DataFrame:
    """The rows with `no`, their number in the order from 0, and for each of `sums` its total over
    the rows before.

    Rows are dealt by ranges of the order; what comes before a partition is summed over one row
    for each partition, the rest within it. The order has to be total for equal reruns.
    """
    dealt = materialised(
        frame.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({f"own_{k}": v for k, v in sums.items()})
        .withColumn("row", F.monotonically_increasing_id()),
        name,
    ).withColumn("part", F.shiftright("row", 33))
    before = (Window.unboundedPreceding, -1)
    by_part = Window.orderBy("part").rowsBetween(*before)
    totals = dealt.groupBy("part").agg(
        F.count("*").alias("n"), F.min("row").alias("first"),
        *[F.sum(f"own_{k}").alias(f"all_{k}") for k in sums],
    )
    earlier = totals.select(
        F.col("part").alias("its_part"),
        (F.coalesce(F.sum("n").over(by_part), F.lit(0)) - F.col("first")).alias("shift"),
        *[F.coalesce(F.sum(f"all_{k}").over(by_part), F.lit(0)).alias(f"all_{k}") for k in sums],
    )
    within = Window.partitionBy("part").orderBy("row").rowsBetween(*before)
    inside = dealt.withColumns(
        {f"in_{k}": F.coalesce(F.sum(f"own_{k}").over(within), F.lit(0)) for k in sums}
    )
    return inside.join(earlier, F.col("part") == F.col("its_part")).select(
        *frame.columns, (F.col("row") + F.col("shift")).alias("no"),
        *[(F.col(f"all_{k}") + F.col(f"in_{k}")).alias(k) for k in sums],
    )


def send_package(spark: SparkSession) -> None:
    """Have the executors import this package, which their Python may not have installed."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="flowengine-")) / "flowengine.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _sent.add(context.applicationId)


def map_batches(frame: DataFrame, run: Callable, schema: str) -> DataFrame:
    """`mapInArrow` with a function that uses this package and sees batches of bounded size.

    From here on the session hands batches of at most `BATCH_BYTES` to Python functions, if no row
    has more. A worker gives memory back when its task ends, as it may wait for long beside
    other tasks.
    """
    send_package(frame.sparkSession)
    frame.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(_cut(batches))
        finally:
            _give_back()

    return frame.mapInArrow(bounded, schema)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not on every platform
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `BATCH_BYTES`; a longer row is a slice of its own."""
    for batch in batches:
        parts = max(1, min(batch.num_rows, -(-batch.nbytes // BATCH_BYTES)))
        rows = -(-batch.num_rows // parts)
        for at in range(0, max(batch.num_rows, 1), max(rows, 1)):
            yield batch.slice(at, rows)


def windows(text: str, size: int) -> Iterator[str]:
    """The text in parts of about `size` characters, cut only before a blank or newline that
    follows a non-blank. A part without such a place stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def pieces(text: str) -> list[str]:
    """The text cut at every safe boundary; joined, the pieces are the text."""
    return _PIECES.findall(text)


class Learned(dict):
    """What is known of pieces of text, computed for many at a time.

    After `take_in` it holds all the pieces asked for. Short ones are remembered: when there are
    `bound` of them they become the older half, from which what is asked for again moves back; so
    there are at most 2 * `bound` and those of the last call.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], bound: int, longest: int):
        super().__init__()
        self.compute, self.bound, self.longest, self.older = compute, bound, longest, {}

    def take_in(self, asked: set[str]) -> None:
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        rest = asked.difference(self)
        self.update((p, self.older[p]) for p in rest if p in self.older)
        unknown = list(rest.difference(self.older))
        self.update(zip(unknown, self.compute(unknown), strict=True))

    def forget_long(self, asked: set[str]) -> None:
        for piece in [p for p in asked if len(p) > self.longest]:
            self.pop(piece, None)

    def over(
        self, texts: Iterable[tuple[int, str]], size: int
    ) -> Iterator[tuple[int, list[str]]]:
        """(number, pieces) of numbered texts, all of whose pieces are held while they are given;
        texts are taken in together until they have `size` characters."""
        chunk: list[tuple[int, list[str]]] = []
        taken = 0
        for number, text in itertools.chain(texts, [(-1, "")]):
            if number >= 0:
                chunk.append((number, pieces(text)))
                taken += len(text)
            if chunk and (taken >= size or number < 0):
                asked = set().union(*(p for _, p in chunk))
                self.take_in(asked)
                yield from chunk
                self.forget_long(asked)
                chunk, taken = [], 0
