"""Embedding near-duplicates by spherical-cap filters from structured random product codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised
from flowengine.llm.components import components
from flowengine.llm.vectors import matrix, usable

#: Random vectors of the largest label that a filter catches on average.
CAUGHT = 64
#: Independent codes; filters that two vectors at the threshold share on average, in all of them;
#: a vector's best directions in each code that count even if they exceed the cap by too little, for
#: labels of up to `SMALL` vectors.
CODES, SHARED, LEAST = 4, 6, 3
SMALL = 100_000
#: Vectors in one side of a tile, and scores of directions that are decoded at a time.
TILE, SCORES = 1024, 1 << 21
SEED = 20_160_110


def _tail(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def cap(n: int, threshold: float) -> tuple[float, int]:
    """The cap's height in standard deviations, and the directions in each half of a code, for n
    vectors: random ones fall into a cap with probability CAUGHT / n, and there are enough caps
    that two vectors at the threshold share `SHARED` of them on average."""
    share = min(0.02, CAUGHT / max(n, 1))
    low, high = 0.0, 40.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _tail(middle) > share else (low, middle)
    z = np.linspace(low, low + 8, 2001)
    rest = math.sqrt(max(1 - threshold**2, 1e-12))
    also = np.array([1 - _tail((threshold * x - low) / rest) for x in z])
    both = np.trapezoid(np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * also, z)
    return low, max(2, math.ceil(math.sqrt(SHARED / both / CODES)))


def best(n: int) -> int:
    """The best directions in each code that count for n vectors. Caps get higher and scores of
    short vectors reach them less and less, so the number doubles with every hundredfold n."""
    return math.ceil(LEAST * max(1.0, n / SMALL) ** 0.15)


class Codes:
    """Product codes over vectors of one length: in each, a rotation is cut in two halves with
    random unit directions; a filter is one direction of either half, and its score is the sum.
    In each, `least` directions of a vector count even if they are under the height."""

    def __init__(self, width: int, height: float, directions: int, least: int):
        self.directions = directions
        self.least = least
        self.least_sum = height * math.sqrt(2 / width)
        self.halves = []
        for code in range(CODES):
            random = np.random.default_rng([SEED, width, code])
            rotation = np.linalg.qr(random.normal(size=(width, width)))[0]
            cut = (width + 1) // 2
            half = []
            for part in (rotation[:cut], rotation[cut:]):
                own = random.normal(size=(directions, len(part)))
                size = np.linalg.norm(own, axis=1, keepdims=True)
                half.append((own / np.where(size > 0, size, 1)) @ part)
            self.halves.append(half)

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter direction that a row exceeds, and of its best ones.

        Both halves' scores are sorted, so only the leading directions of either, which can still
        reach the cap together with the other's best, are combined.
        """
        rows, filters = [], []
        for code, (first, second) in enumerate(self.halves):
            one, order_1 = _descending(units @ first.T)
            two, order_2 = _descending(units @ second.T)
            width_1 = self._leading(one, two)
            width_2 = self._leading(two, one)
            step = max(1, SCORES // (width_1 * width_2))
            for at in range(0, len(units), step):
                a, b = one[at:at + step, :width_1], two[at:at + step, :width_2]
                sums = (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)
                least = min(self.least, sums.shape[1])
                floor = np.partition(sums, -least, axis=1)[:, -least]
                row, place = np.nonzero(sums >= np.minimum(floor, self.least_sum)[:, None])
                i, j = np.divmod(place, width_2)
                rows.append(row + at)
                filters.append(
                    (code * self.directions + order_1[row + at, i]) * self.directions
                    + order_2[row + at, j]
                )
        return np.concatenate(rows), np.concatenate(filters)

    def _leading(self, own: np.ndarray, other: np.ndarray) -> int:
        reach = own + other[:, :1] >= self.least_sum
        return min(self.directions, max(self.least, int(reach.sum(axis=1).max(initial=0))))


def _descending(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(scores, order, axis=1), order


def _filtered(classes: DataFrame, height: float, directions: int, least: int) -> DataFrame:
    """One row for each vector and filter: the vector with all of its filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Codes] = {}
        for batch in batches:
            widths = np.diff(batch["vector"].offsets.to_numpy())
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                if width not in codes:
                    codes[width] = Codes(int(width), height, directions, least)
                raw = _within_range(matrix(part["vector"], "f8"))
                row, caught = codes[width].decode(
                    raw / np.linalg.norm(raw, axis=1, keepdims=True)
                )
                order = np.lexsort((caught, row))
                row, caught = row[order], caught[order]
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(caught))
                every = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*every.columns, pa.array(np.full(len(row), width, np.int32)),
                     pa.array(caught), lists.take(pa.array(row))],
                    ["label", "id", "copies", "vector", "width", "filter", "filters"],
                )

    kind = dict(classes.dtypes)["vector"]
    schema = (
        f"label long, id long, copies long, vector {kind}, width int, filter long, "
        "filters array<long>"
    )
    numbered = classes.select(F.col("label_no").alias("label"), "id", "copies", "vector")
    return map_batches(numbered, run, schema)


def _linked(filtered: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): for b null, a's links that one tile counted; else an edge.

    The members of a filter meet in tiles of bounded size. A pair that shares several filters
    counts in the smallest one. Pairs stay inside their tile: it hands on a sum for each vector
    and a spanning forest.
    """
    bucket = ["label", "width", "filter"]
    sizes = filtered.groupBy(*bucket).agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    dealt = filtered.join(sizes, bucket).withColumn(
        "block", F.pmod(F.xxhash64("id", "vector"), F.col("blocks"))
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    tiled = dealt.select(
        *bucket, "id", "copies", "vector", "filters", "block", others
    ).select(
        *bucket, F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        "block", "id", "copies", "vector", "filters",
    )
    key = [*bucket, "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _groups(batches, key):
            yield _tile_links(tile, threshold)

    ordered = tiled.repartition(*key).sortWithinPartitions(*key)
    return map_batches(ordered, run, "a long, b long, n long")


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal key, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    before: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in key], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(values)], strict=True):
            now = tuple(values[start])
            if held and now != before:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            before = now
    if held:
        yield pa.concat_batches(held)


def _tile_links(tile: pa.RecordBatch, threshold: float) -> pa.RecordBatch:
    low, high = tile["low"][0].as_py(), tile["high"][0].as_py()
    block = tile["block"].to_numpy()
    rows, columns = np.flatnonzero(block == low), np.flatnonzero(block == high)
    raw = _within_range(matrix(tile["vector"], "f8"))
    size = np.linalg.norm(raw, axis=1)
    cosine = (raw[rows] @ raw[columns].T) / (size[rows][:, None] * size[columns])
    near = cosine >= threshold
    if low == high:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    i, j = rows[i], columns[j]
    if len(i):
        first_here = ~_meet_before(tile["filters"], tile["filter"][0].as_py(), i, j)
        i, j = i[first_here], j[first_here]
    ids, copies = tile["id"].to_numpy(), tile["copies"].to_numpy()
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    has = np.flatnonzero(links)
    edges = _forest(ids[i], ids[j])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((ids[has], edges[:, 0]))),
            pa.array(np.concatenate((np.zeros(len(has), np.int64), edges[:, 1])),
                     mask=np.arange(len(has) + len(edges)) < len(has)),
            pa.array(np.concatenate((links[has], np.zeros(len(edges), np.int64)))),
        ],
        ["a", "b", "n"],
    )


def _within_range(raw: np.ndarray) -> np.ndarray:
    """Rows as they are, but for those whose squares a double cannot hold."""
    largest = np.abs(raw).max(axis=1, keepdims=True)
    return np.where((largest > 1e150) | (largest < 1e-150), raw / largest, raw)


def _meet_before(lists: pa.Array, here: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair: do both rows have a filter smaller than this one?"""
    values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    rows = np.union1d(i, j)
    counts = ends[rows + 1] - ends[rows]
    owner = np.repeat(np.arange(len(rows)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    caught = values[np.repeat(ends[rows], counts) + inside]
    owner, caught = owner[caught < here], caught[caught < here]
    names, column, often = np.unique(caught, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    met = np.zeros((len(rows), len(rows)), dtype=bool)
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    starts = np.flatnonzero(np.append(True, column[1:] != column[:-1])) if len(column) else []
    for start in range(0, len(starts), TILE):
        stop = starts[start + TILE] if start + TILE < len(starts) else len(column)
        part = slice(starts[start], stop)
        has = np.zeros((len(rows), TILE), dtype=np.float32)
        has[owner[part], np.unique(column[part], return_inverse=True)[1]] = 1
        met |= has @ has.T > 0
    return met[np.searchsorted(rows, i), np.searchsorted(rows, j)]


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A spanning forest of the edges."""
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := roots.get(x, x)) != x:
            roots[x] = roots.get(up, up)
            x = up
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            roots[max(x, y)] = min(x, y)
            kept.append((x, y))
    return np.array(kept, dtype=np.int64).reshape(-1, 2)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept): near-duplicate vectors of equal label.

    `vectors` has vec_id, embedding and label. Two vectors link if their cosine, in double
    precision, is at least `threshold`; every pair that shares a filter is checked, so no link is
    false. Pairs at the threshold share a filter with a probability that a test holds to 0.98 for
    widths 24 and 64 and up to ten million vectors in the largest label. n_links is a vector's
    number of links, component_id the smallest vec_id that links reach, and kept says that this is
    its own.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing,
    nor do rows with a null label or id; only vectors of equal length link. Labels may be of any
    type that has an order, components of any number type; other than singles they are compared
    as doubles. Equal vectors of a
    label are one class with a number of copies: all of them link with each other. Every input row
    is a vector of its own and gives one row, also where ids repeat. Other columns are left out,
    whatever their names. An empty table gives no rows.
    """
    # singles stay singles, anything else is compared as doubles; labels are only ever equal or not
    kind = dict(vectors.dtypes)["embedding"]
    vector = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector")
    )
    some = F.exists("vector", lambda x: x != 0)
    fit = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
        & F.coalesce(some, F.lit(False))
    )
    able = rows.where(fit)
    distinct = materialised(
        able.groupBy("label", "vector").agg(
            F.min("vec_id").alias("first_id"), F.count("*").alias("copies")
        ).withColumn("id", F.monotonically_increasing_id()),
        "cap-classes",
    )
    labels = materialised(
        distinct.groupBy("label").agg(F.count("*").alias("vectors"))
        .withColumn("label_no", F.monotonically_increasing_id()),
        "cap-labels",
    )
    classes = distinct.join(labels.select("label", "label_no"), "label")
    # one row: the size of the largest label
    largest = labels.agg(F.max("vectors")).first()[0] or 0
    filtered = materialised(_filtered(classes, *cap(largest, threshold), best(largest)), "cap-filters")
    found = materialised(_linked(filtered, threshold), "cap-links")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    grouped = (
        classes.join(counts, classes["id"] == counts["a"], "left")
        .join(roots, classes["id"] == roots["node"], "left")
        .select(
            F.col("label").alias("its_label"), F.col("vector").alias("its_vector"), "first_id",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = grouped.join(smallest, "root")
    same = (F.col("label") == F.col("its_label")) & (F.col("vector") == F.col("its_vector"))
    alone = rows.where(~fit).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    answered = able.join(placed, same).select("vec_id", "n_links", "component_id").union(alone)
    return answered.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
