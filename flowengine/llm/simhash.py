"""SimHash near-duplicates by a hierarchical index in Gray order."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised
from flowengine.llm.components import components

#: Seed of the shingles' 64-bit hash.
SEED = 42
#: Fingerprints in a leaf of the index, children of an upper node, fingerprints in a leaf's group.
LEAF, FAN, GROUP = 256, 16, 16
#: Shingles whose bits are counted at a time.
WINDOW_SHINGLES = 1 << 16

_SHIFTS = (1, 2, 4, 8, 16, 32)


def fingerprint(text: str | None, shingle: int) -> int:
    """The text's 64-bit SimHash as a signed number.

    A-Z are lower-cased; words are what ASCII white space separates. Each shingle of so many
    words, repeats included, is hashed; a text of fewer words is one shingle. A bit is 1 if it is
    set in over half of the hashes. Without words the fingerprint is 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        starts = [b" ".join(words)]
    else:
        starts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = (digest(s, SEED) for s in starts)
    n, ones = 0, np.zeros(64, dtype=np.int64)
    while part := list(itertools.islice(hashes, WINDOW_SHINGLES)):
        raw = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fingerprint) of every document's whole text; a null text has no words.
    `text_key` is a hash of the text, which tells rows with the same id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(marks, pa.int64())],
                ["doc_id", "text_key", "fingerprint"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    return map_batches(rows, run, "doc_id long, text_key long, fingerprint long")


def gray_rank(mark: Column) -> Column:
    """The place of a 64-bit number in the reflected Gray code, as a signed number that sorts like
    the unsigned place. Neighbours in this order differ in few bits."""
    for shift in _SHIFTS:
        mark = mark.bitwiseXOR(F.shiftrightunsigned(mark, shift))
    return mark.bitwiseXOR(F.lit(-(1 << 63)))


def _leaves(marks: DataFrame) -> DataFrame:
    """(leaf, marks, shared, pattern): distinct fingerprints in Gray order, in leaves numbered in
    that order. `shared` masks the bits that are equal in the whole leaf, `pattern` has them."""
    spark = marks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty(0, dtype=np.int64)
        part, number = np.empty(0, dtype=np.int32), 0
        for batch in batches:
            part = batch.column(1).to_numpy()
            rest = np.concatenate((rest, batch.column(0).to_numpy()))
            full = len(rest) // LEAF * LEAF
            if full:
                yield leaf_rows(rest[:full], part[0], number)
                number, rest = number + full // LEAF, rest[full:]
        if len(rest):
            yield leaf_rows(rest, part[0], number)

    def leaf_rows(values: np.ndarray, part: int, number: int) -> pa.RecordBatch:
        starts = np.arange(0, len(values), LEAF)
        both, any_ = np.bitwise_and.reduceat(values, starts), np.bitwise_or.reduceat(values, starts)
        offsets = np.append(starts, len(values)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), part, dtype=np.int32)),
                pa.array(number + np.arange(len(starts))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.array(~(both ^ any_)),
                pa.array(both),
            ],
            ["part", "number", "marks", "shared", "pattern"],
        )

    rank = gray_rank(F.col("mark"))
    ordered = (
        marks.select("mark", rank.alias("rank"))
        .repartitionByRange(parts, "rank")
        .sortWithinPartitions("rank")
        .select("mark", F.spark_partition_id().alias("part"))
    )
    schema = "part int, number long, marks array<long>, shared long, pattern long"
    leaves = materialised(map_batches(ordered, cut, schema), "simhash-leaves")
    # one row for each partition
    sizes = leaves.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = leaves.join(bases, "part")
    return numbered.select((F.col("base") + F.col("number")).alias("node"), "marks", "shared",
                           "pattern")


def _above(nodes: DataFrame) -> DataFrame:
    """The upper nodes: each masks the bits that all of its children share."""
    ones = F.bit_and(F.col("pattern").bitwiseAND(F.col("shared")))
    zeros = F.bit_and(F.bitwise_not("pattern").bitwiseAND(F.col("shared")))
    parents = nodes.groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
        ones.alias("pattern"), zeros.alias("zeros")
    )
    return parents.select(
        "node", F.col("pattern").bitwiseOR(F.col("zeros")).alias("shared"), "pattern"
    )


def _within(marks: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between fingerprints at most `distance` bits apart: for each pair of leaves
    that may hold such pairs, a spanning forest of them."""
    leaves = materialised(_leaves(marks), "simhash-index")
    levels = [leaves.select("node", "shared", "pattern")]
    size = leaves.count()
    while size > 1:
        levels.append(materialised(_above(levels[-1]), "simhash-nodes"))
        size = -(-size // FAN)
    root = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    pairs = root
    for children in reversed(levels[:-1]):
        pairs = _descended(pairs, children, distance)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [
                _forest(one.values.to_numpy(), other.values.to_numpy(), distance)
                for one, other in zip(batch.column(0), batch.column(1), strict=True)
            ]
            found = np.concatenate(edges) if edges else np.empty((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"]
            )

    content = leaves.select("node", "marks")
    held = (
        pairs.join(content.toDF("a", "one"), "a")
        .join(content.toDF("b", "other"), "b")
        .select("one", "other")
    )
    return map_batches(held, match, "a long, b long")


def _descended(pairs: DataFrame, children: DataFrame, distance: int) -> DataFrame:
    """Pairs of the children of paired nodes, without those whose shared bits already differ in
    more than `distance` places: their whole groups are pruned."""
    parent = F.floor(F.col("node") / FAN)
    left = children.select(
        parent.alias("a"), F.col("node").alias("node_a"),
        F.col("shared").alias("shared_a"), F.col("pattern").alias("pattern_a"),
    )
    right = children.select(
        parent.alias("b"), F.col("node").alias("node_b"),
        F.col("shared").alias("shared_b"), F.col("pattern").alias("pattern_b"),
    )
    differ = F.bit_count(
        F.col("pattern_a").bitwiseXOR(F.col("pattern_b"))
        .bitwiseAND(F.col("shared_a")).bitwiseAND(F.col("shared_b"))
    )
    half = pairs.join(left, "a").alias("half")
    keep = (
        (F.col("half.b") == F.col("right.b"))
        & (F.col("node_a") <= F.col("node_b"))
        & (differ <= distance)
    )
    return half.join(right.alias("right"), keep).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b")
    )


def _groups(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower nodes of a leaf: rows of fingerprints (the last one repeated to fill its row), the
    bits shared by each row, and their pattern."""
    short = -len(marks) % GROUP
    rows = np.concatenate((marks, np.repeat(marks[-1:], short))).reshape(-1, GROUP)
    both = np.bitwise_and.reduce(rows, axis=1)
    return rows, ~(both ^ np.bitwise_or.reduce(rows, axis=1)), both


def _forest(one: np.ndarray, other: np.ndarray, distance: int) -> np.ndarray:
    """Spanning forest of the links between two leaves, or within one."""
    rows, shared, pattern = _groups(one)
    rows_2, shared_2, pattern_2 = _groups(other)
    differ = (pattern[:, None] ^ pattern_2) & shared[:, None] & shared_2
    near = np.nonzero(np.bitwise_count(differ.view(np.uint64)) <= distance)
    apart = rows[near[0]][:, :, None] ^ rows_2[near[1]][:, None, :]
    pair, i, j = np.nonzero(np.bitwise_count(apart.view(np.uint64)) <= distance)
    a, b = rows[near[0][pair], i], rows_2[near[1][pair], j]
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := roots.get(x, x)) != x:
            roots[x] = roots.get(up, up)
            x = up
        return x

    edges = []
    different = a != b
    for x, y in zip(a[different].tolist(), b[different].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            roots[max(x, y)] = min(x, y)
            edges.append((x, y))
    return np.array(edges, dtype=np.int64).reshape(-1, 2)


def near_duplicates(documents: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id, group) of every document.

    Two documents link if their fingerprints differ in at most `distance` bits; a component is
    what links reach, its id is its smallest doc_id, and `group` numbers it even where ids repeat.
    Equal fingerprints are one entry of the
    index, so thousands of copies are one comparison; between different ones links are found leaf
    by leaf and only a spanning forest of each pair of leaves is kept.

    Null and empty texts, and those of white space only, have fingerprint zero and link like any
    other. Repeated rows give one row each, with the same component. A null doc_id takes part and
    gets its component, whose id is null only if it has no other document; other columns are left
    out, whatever their names. An empty table gives no rows.
    """
    marked = materialised(fingerprints(documents, shingle), "simhash-marks")
    classes = marked.groupBy(F.col("fingerprint").alias("mark")).agg(
        F.min("doc_id").alias("first_doc")
    )
    links = components(_within(classes.select("mark"), distance))
    placed = classes.join(links, classes["mark"] == links["node"], "left").select(
        "mark", "first_doc", F.coalesce("root", "mark").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_mark = placed.join(smallest, "root").select(
        "mark", "component_id", F.col("root").alias("group")
    )
    return marked.join(of_mark, marked["fingerprint"] == of_mark["mark"]).select(
        "doc_id", "text_key", "fingerprint", "component_id", "group"
    )


def keep_one(documents: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, text, lang, source, n_chars): one document of each group of near-duplicates, the
    one with the smallest id (null last; of equal ids that with the smallest hash of its text).
    Rows with equal id and text are one document; of differing lang, source or n_chars the
    smallest combination stays."""
    found = near_duplicates(documents, shingle, distance)
    identity = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_key")
    first = found.groupBy("group").agg(F.min(identity).alias("first")).select(
        F.col("first.doc_id").alias("its_id"), F.col("first.text_key").alias("its_key")
    )
    once = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
        F.struct("lang", "source", F.col("n_chars").cast("long").alias("n_chars"), "text")
        .alias("row"),
    ).groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))
    return once.join(first, same, "left_semi").select(
        "doc_id", "row.text", "row.lang", "row.source", "row.n_chars"
    )
