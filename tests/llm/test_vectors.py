"""Vector operators against brute force, with awkward vectors."""

import collections
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowengine.llm import cap_filters, exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score int"
NAN, INF = float("nan"), float("inf")
ODD = [
    (200, [1.0, 0.0, 0.5], 1), (200, [1.0, 0.0, 0.5], 1), (200, [0.0, 1.0, 0.5], 1),
    (300, None, 1), (301, [], 1), (302, [0.0, 0.0, 0.0], 1), (303, [NAN, 1.0, 1.0], 1),
    (304, [INF, 1.0, 1.0], 1), (305, [None, 1.0, 1.0], 1), (306, [1.0, 0.0], 1),
    (307, [1.0, 0.0, 0.5], None), (None, [1.0, 0.0, 0.5], 1), (308, [2.0, 0.0, 1.0], 1),
    (309, [1.0, 0.0, 0.5], 2), (400, [1.0, 0.01, 0.5], 1), (310, [3e38, 3e38, -3e38], 1),
    (500, [3e38, 3e38, 3e38], 1), (311, [1.0, 0.0, 0.5], 1),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)


def fits(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def brute_top(rows, k):
    whole = {
        (i, tuple(math.floor(float(np.float32(x)) * 1024) for x in v))
        for i, v, _ in rows if i is not None and fits(v)
    }
    top = 2**63 - 1
    whole = [(i, [max(-top - 1, min(top, x)) for x in v]) for i, v in whole]
    best = collections.defaultdict(dict)
    for (i, v), (j, w) in itertools.product(whole, whole):
        if i % 100 == 0 and i != j and len(v) == len(w):
            score = max(-top, min(top, sum(a * b for a, b in zip(v, w, strict=True))))
            best[i][j] = max(score, best[i].get(j, score))
    return sorted(
        (i, rank, j, score) for i, found in best.items()
        for rank, (score, j) in enumerate(
            sorted(((s, j) for j, s in found.items()), key=lambda x: (-x[0], x[1]))[:k], 1)
    )


@pytest.mark.parametrize("shard,block,k", [(exact_topk.SHARD, exact_topk.BLOCK, 10), (6, 4, 3)])
def test_top_k_of_odd_vectors(spark, shard, block, k):
    got = exact_topk.search(frame(spark, ODD), F.col("vec_id") % 100 == 0, k, shard=shard, block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(ODD, k)


def test_top_k_with_ties_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "FAN", 2)
    draw = np.random.default_rng(1)
    rows = [(i, draw.integers(0, 3, 4).astype(float).tolist(), 1) for i in range(400)]
    got = exact_topk.search(frame(spark, rows), F.col("vec_id") % 100 == 0, 7, shard=200, block=8)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 7)


def brute_links(rows, threshold=0.93):
    able = [i is not None and label is not None and fits(v) and any(v) for i, v, label in rows]
    vectors = [np.array(v, "f4").astype("f8") if ok else None for ok, (_, v, _) in zip(able, rows, strict=True)]
    near = collections.defaultdict(set)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if able[a] and able[b] and rows[a][2] == rows[b][2] and len(vectors[a]) == len(vectors[b]):
            x, y = vectors[a], vectors[b]
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                near[a].add(b)
                near[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        lowest = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, len(near[k]), lowest, i == lowest))
    return collections.Counter(out)


def test_links_of_odd_vectors(spark):
    got = cap_filters.near_duplicates(frame(spark, ODD))
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_links(ODD)
    assert cap_filters.near_duplicates(frame(spark, [])).count() == 0
    assert exact_topk.search(frame(spark, []), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("tile", [8, 1024])
def test_recall_against_brute_force(spark, monkeypatch, tile):
    """Random vectors with neighbours just above and below the threshold, and one large group."""
    monkeypatch.setattr(cap_filters, "TILE", tile)
    draw = np.random.default_rng(tile)
    rows = []
    for k in range(250):
        x = draw.normal(size=24)
        x /= np.linalg.norm(x)
        rows.append((len(rows), x.tolist(), k % 2))
        w = draw.normal(size=24)
        w -= w @ x * x
        w /= np.linalg.norm(w)
        c = draw.choice([0.90, 0.935, 0.95, 0.99])
        rows.append((len(rows), (c * x + math.sqrt(1 - c * c) * w).tolist(), k % 2))
    hub = draw.normal(size=24)
    rows += [(1000 + k, (hub + 0.01 * draw.normal(size=24)).tolist(), 0) for k in range(60)]
    got = {r.vec_id: r for r in cap_filters.near_duplicates(frame(spark, rows)).collect()}
    want = {i: (n, lowest) for i, n, lowest, _ in brute_links(rows)}
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    found, there = (sum(x) for x in zip(*((got[i].n_links, n) for i, (n, _) in want.items()), strict=True))
    assert found / there >= 0.98
    assert sum(got[i].component_id == lowest for i, (_, lowest) in want.items()) / len(want) >= 0.98


@pytest.mark.parametrize("width", [24, 64])
@pytest.mark.parametrize("n", [10**5, 10**6, 10**7])
def test_recall_at_the_threshold_for_large_labels(width, n):
    """Pairs at cosine 0.931 under the filters for n vectors; only the pairs are made."""
    draw = np.random.default_rng([width, n])
    x, w = draw.normal(size=(2, 300, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w -= (w * x).sum(axis=1, keepdims=True) * x
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    codes = cap_filters.Codes(width, *cap_filters.cap(n, 0.93), cap_filters.best(n))
    sides = []
    for units in (x, 0.931 * x + math.sqrt(1 - 0.931**2) * w):
        row, caught = codes.decode(units)
        sides.append([set(caught[row == k].tolist()) for k in range(300)])
    assert sum(bool(a & b) for a, b in zip(*sides, strict=True)) / 300 >= 0.98


def test_filters_have_no_links_twice():
    lists = [[1, 4, 9], [4, 9], [1, 9], [9]]
    import pyarrow as pa

    i, j = (np.array(x) for x in zip(*itertools.combinations(range(4), 2), strict=True))
    got = cap_filters._meet_before(pa.array(lists), 9, i, j)
    assert got.tolist() == [bool({*lists[a]} & {*lists[b]} - {9}) for a, b in zip(i, j, strict=True)]


def test_doubles_and_labels_of_any_type(spark):
    """Differences that singles cannot hold decide; labels are texts, or numbers beyond an int."""
    one, tiny = [1.0, 0.0], 1e-12
    edge = [0.93, math.sqrt(1 - 0.93**2)]
    above, below = [0.93 + tiny, edge[1]], [0.93 - tiny, edge[1]]
    for first, second in (("a", "b"), (1 << 40, (1 << 40) + 1), (0.5, 0.25)):
        rows = [
            (1, one, first), (2, above, first), (3, below, first), (4, above, second), (5, one, None),
            (6, [1e300, 0.0], first), (7, [1e-300, 0.0], second),
        ]
        kind = {str: "string", int: "long", float: "double"}[type(first)]
        vectors = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
        got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.near_duplicates(vectors).collect()}
        # 2 is linked to 1, 3, 6; 3 to 2 alone
        assert got == {
            1: (2, 1), 2: (3, 1), 3: (1, 1), 6: (2, 1), 4: (1, 4), 7: (1, 4), 5: (0, 5),
        }
