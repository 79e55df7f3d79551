"""Exact top-k search: tiled matrix products, a selection in each tile, and a tree of merges."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowengine.llm.common import materialised, send_package
from flowengine.llm.vectors import matrix, usable

#: Components of candidates and of queries in a tile.
SHARD, BLOCK = 1 << 19, 1 << 17
#: Scores that a tile computes at a time.
SCORES = 1 << 21
#: Lists that one merge takes together.
FAN = 32

_NONE = np.iinfo(np.int64).min


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors for each query, exactly.

    `vectors` has vec_id and embedding; rows for which `is_query` holds are the queries. A
    component x counts as floor(scale * x), with x as double; the score is the inner product of
    these whole numbers, at most the largest long. Ties go to the smaller vec_id.

    Candidates are dealt into shards and queries into blocks, both of bounded size; each pair of
    a shard and a block is one matrix product in one task, which keeps its best k per query. The
    lists of a query are merged a few at a time until one is left. Nothing is approximate.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows
    with a null id. Only vectors of the query's length are candidates. A query never meets its own
    id. Repeated rows are one vector; where an id has several different vectors, the best score of
    an id with an id counts. A query with fewer than k candidates gets them all. Other columns are
    left out, whatever their names. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    send_package(spark)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding",
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = materialised(
        kept.select("vec_id", "is_query", whole.alias("vector")).distinct()
        .withColumn("width", F.size("vector")),
        "topk-vectors",
    )
    # one row: what sizes the grid of tiles
    components, asked = rows.agg(
        F.sum("width"), F.sum(F.when(F.col("is_query"), F.col("width")))
    ).first()
    shards = max(1, math.ceil((components or 0) / shard))
    blocks = max(1, math.ceil((asked or 0) / block))
    dealt = F.xxhash64("vec_id", "vector")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select(
        "width", F.pmod(dealt, F.lit(shards)).cast("int").alias("shard"),
        numbers(blocks).alias("block"), "vec_id", "vector",
    )
    queries = rows.where("is_query").select(
        "width", F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
        numbers(shards).alias("shard"), F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
    )
    tile = ["width", "shard", "block"]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        return _best_of_tile(left, right, k)

    lists = queries.groupBy(*tile).cogroup(candidates.groupBy(*tile)).applyInArrow(
        best, "query_id long, vec_id long, score long, part int"
    )
    return _merged(lists, shards, k)


def _merged(lists: DataFrame, parts: int, k: int) -> DataFrame:
    """One list per query out of those of `parts` shards, a few at a time."""
    while True:
        parts = math.ceil(parts / FAN)
        together = lists.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        once = together.groupBy("query_id", "part", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
        lists = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if parts <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def _best_of_tile(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best k candidates of the right side for each query id of the left side."""
    found: list[tuple[np.ndarray, ...]] = []
    part = right["shard"][0].as_py() if len(right) else 0
    if len(left) and len(right):
        queries, vectors = matrix(left["query"], "int64"), matrix(right["vector"], "int64")
        query_ids, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        order = np.argsort(query_ids, kind="stable")
        query_ids, queries = query_ids[order], queries[order]
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        step = max(1, SCORES // len(ids))
        for at in range(0, len(query_ids), step):
            scores = _products(queries[at:at + step], vectors)
            if len(first) < len(ids):
                scores = np.maximum.reduceat(scores, first, axis=1)
            found.append(_selected(scores, query_ids[at:at + step], ids[first], k))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
    arrays = [pa.array(c, pa.int64()) for c in columns]
    return pa.table(
        [*arrays, pa.array(np.full(len(arrays[0]), part), pa.int32())],
        names=["query_id", "vec_id", "score", "part"],
    )


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers. Doubles hold them exactly where no sum reaches 2^53;
    beyond that the numbers are multiplied as Python's and held at the range of a long."""
    largest = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if largest < 2.0**53:
        return (queries.astype("f8") @ vectors.T.astype("f8")).astype("i8")
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, _NONE + 1, np.iinfo(np.int64).max).astype("i8")


def _selected(
    scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """Each row's k best, ties to the smaller id; ids are ascending and a query's own is out."""
    own = np.searchsorted(ids, query_ids)
    same = ids[np.minimum(own, len(ids) - 1)] == query_ids
    scores[np.flatnonzero(same), own[same]] = _NONE
    if k < len(ids):
        least = np.partition(scores, -k, axis=1)[:, -k]
    else:
        least = np.full(len(scores), _NONE)
    row, column = np.nonzero((scores >= least[:, None]) & (scores > _NONE))
    value = scores[row, column]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < k
    return query_ids[row[kept]], ids[column[kept]], value[kept]
