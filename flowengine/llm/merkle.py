"""Merkle manifest of a data set: trees per source under one root, proofs by butterfly exchange."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised

#: Consecutive nodes under one parent.
FANOUT = 16
#: Levels of a tree inside a block, the part of a source's leaves that one task hashes at a time.
BLOCK_LEVELS = 3
#: Fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROWS = 33  # bits of a row's place within a partition in monotonically_increasing_id
_STEPS = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf(**changed: Column) -> Column:
    """The digest of a row's `FIELDS`, with some of them replaced: SHA-256 in hexadecimal of
    length, colon and value of each field in UTF-8, or a hyphen for null."""
    values = [_field(changed.get(name, F.col(name))) for name in FIELDS]
    return F.sha2(F.concat(*values).cast("binary"), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of the decimal id, else as it is.
    A row without an id is never tampered with."""
    marked = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(marked, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def _ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with `place`, their number from 0 within their `tree`, and its `size`.

    `order` starts with the tree. Rows are dealt by ranges of the whole order, so a large tree is
    spread over many partitions; a partition's rows are then offset by those of the tree that lie
    in earlier partitions, of which there is one row for each tree and partition.
    """
    row = F.monotonically_increasing_id()
    dealt = materialised(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", row),
        f"{name}-order",
    )
    part = F.shiftright("row", _ROWS).alias("part")
    here = dealt.groupBy("tree", part).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    parts = Window.partitionBy("tree")
    earlier = parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select(
        F.col("tree").alias("its_tree"), F.col("part").alias("its_part"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("n").over(parts).alias("size"),
    )
    same = (F.col("tree") == F.col("its_tree")) & (
        F.shiftright("row", _ROWS) == F.col("its_part")
    )
    return dealt.join(offsets, same).withColumn("place", F.col("row") + F.col("offset")).drop(
        "row", "offset", "its_tree", "its_part"
    )


def _climb(nodes: list[str], fanout: int, levels: int | None) -> Iterator[list[tuple[str, str]]]:
    """(left, right) siblings of every node, level by level: `levels` times, or up to one node.
    The generator returns the topmost nodes."""
    while len(nodes) > 1 if levels is None else levels:
        beside, parents = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start:start + fanout]
            whole = "".join(run)
            width = len(whole) // len(run)
            beside += [
                (whole[:k * width], whole[(k + 1) * width:]) for k in range(len(run))
            ]
            parents.append(_digest(whole))
        yield beside
        nodes, levels = parents, None if levels is None else levels - 1
    return nodes


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], fanout: int, levels: int | None):
    """What `_climb` yields, as a list, and the topmost node."""
    steps, climbing = [], _climb(nodes, fanout, levels)
    while True:
        try:
            steps.append(next(climbing))
        except StopIteration as end:
            return steps, end.value[0]


def _blocks(ranked: DataFrame, carried: list[str], fanout: int, levels: int, name: str):
    """(tree, block, blocks, nodes): aligned runs of fanout^levels leaves, one row each. `nodes`
    holds (place, digest, *carried) in order; `blocks` is how many of them the tree has."""
    width = fanout**levels
    members = F.sort_array(F.collect_list(F.struct("place", "digest", *carried)))
    return materialised(
        ranked.groupBy("tree", F.floor(F.col("place") / width).alias("block")).agg(
            F.ceil(F.first("size") / width).alias("blocks"), members.alias("nodes")
        ),
        f"{name}-blocks",
    )


def _block_roots(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, block, blocks, root): a block that is one of several is always `levels` high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [
                _levels(nodes, fanout, levels if many > 1 else None)[1]
                for nodes, many in zip(
                    batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(roots, pa.string())],
                ["tree", "block", "blocks", "root"],
            )

    rows = blocks.select("tree", "block", "blocks", F.col("nodes.digest").alias("digests"))
    return map_batches(rows, run, "tree string, block long, blocks long, root string")


def _exchanged(roots: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, path, root): every block's siblings above it and its tree's root.

    Round by round, a block swaps its subtree's root with the blocks that differ from it in one
    digit of their number only, at most `fanout` of them, and hashes the parent itself; so all
    blocks climb to the root together and none waits for a pass downwards. The last subtree of a
    level may have too few blocks to face all others: they then stand in for the missing ones.
    """
    most = roots.agg(F.max("blocks")).first()[0] or 0
    rows, width = roots.withColumn("path", F.array().cast(_STEPS)), 1
    while width < most:
        rows, width = _round(rows, width, fanout), width * fanout
    return rows.select("tree", "block", "path", "root")


def _round(rows: DataFrame, width: int, fanout: int) -> DataFrame:
    climbs = F.col("blocks") > width
    node = F.floor(F.col("block") / width)
    low = F.col("block") % width
    there = F.least(F.lit(width), F.col("blocks") - node * width)
    facing = F.when(climbs, F.sequence(low, F.lit(width - 1).cast("long"), there)).otherwise(
        F.array(F.col("block"))
    )
    sent = rows.select(
        "*", climbs.alias("climbs"), low.alias("low"), (node % fanout).alias("digit"),
        F.when(climbs, F.floor(node / fanout)).otherwise(F.lit(-1)).alias("group"),
        F.explode(facing).alias("to"),
    )
    swapped = F.sort_array(
        F.collect_list(F.struct("digit", "root")).over(Window.partitionBy("tree", "group", "to"))
    )

    def side(those):
        kept = F.filter("swapped", lambda x: those(x["digit"]))
        return F.array_join(F.transform(kept, lambda x: x["root"]), "")

    step = F.struct(
        side(lambda digit: digit < F.col("digit")).alias("left"),
        side(lambda digit: digit > F.col("digit")).alias("right"),
    )
    whole = F.array_join(F.col("swapped.root"), "")
    met = sent.withColumn("swapped", swapped).where(~F.col("climbs") | (F.col("to") == F.col("low")))
    return met.select(
        "tree", "block", "blocks",
        F.when(F.col("climbs"), F.sha2(whole.cast("binary"), 256)).otherwise(F.col("root"))
        .alias("root"),
        F.when(F.col("climbs"), F.concat("path", F.array(step))).otherwise(F.col("path"))
        .alias("path"),
    )


def manifest(
    rows: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """The manifest, a row for each block of leaves: (source, block, blocks, nodes, path, subroot,
    root).

    `rows` has doc_id, source, digest (the leaf's) and claimed, the digest of a copy that is to be
    checked against the manifest. A source's leaves ascend by doc_id, those without one first and
    equal ids by their digests; while there are several nodes, each run of `fanout` becomes one.
    The sources' roots, in bytewise order of the source with null first, go on in the same way to
    `root`; a source with a lone leaf has that as its root. `nodes` are the block's (place, digest,
    doc_id, claimed); `path` has (left, right) siblings of each level above the block, through the
    source's root to the whole one's.

    A block has fanout^block_levels leaves, whatever the source's size. Only blocks' roots are
    exchanged between tasks, `fanout` at a time. Repeated rows are leaves of their own. No rows
    give no blocks; other columns are left out, whatever their names.
    """
    # null sorts before all sources, and every key is a text
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = materialised(
        rows.select(
            tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), "digest", "claimed"
        ),
        "merkle-leaves",
    )
    order = [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("claimed")]
    ranked = _ranked(leaves, order, "merkle")
    blocks = _blocks(ranked, ["doc_id", "claimed"], fanout, block_levels, "merkle")
    up = materialised(_exchanged(_block_roots(blocks, fanout, block_levels), fanout), "merkle-up")

    subroots = up.where("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("below"), F.col("root").alias("digest")
    )
    sources = _ranked(subroots, [F.col("tree"), F.col("below")], "merkle-sources")
    above = _blocks(sources, ["below"], fanout, block_levels, "merkle-sources")
    tops = _exchanged(_block_roots(above, fanout, block_levels), fanout).select(
        "block", F.col("path").alias("higher"), F.col("root").alias("whole")
    )
    top_paths = _inner_paths(above.join(tops, "block"), fanout, block_levels)
    upper = up.withColumnRenamed("root", "subroot").join(top_paths, "tree")
    return blocks.join(
        upper.select(
            "tree", "block", F.concat("path", "higher").alias("path"), "subroot",
            F.col("whole").alias("root"),
        ),
        ["tree", "block"],
    ).select(
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("source"),
        "block", "blocks", "nodes", "path", "subroot", "root",
    )


def _inner_paths(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, higher, whole): the steps from every source's root to the whole one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                many = levels if row["blocks"] > 1 else None
                steps, _ = _levels([n["digest"] for n in row["nodes"]], fanout, many)
                higher = [tuple(step.values()) for step in row["higher"]]
                out = []
                for k, node in enumerate(row["nodes"]):
                    path = [step[k // fanout**i] for i, step in enumerate(steps)] + higher
                    out.append({
                        "tree": node["below"], "whole": row["whole"],
                        "higher": [{"left": a, "right": b} for a, b in path],
                    })
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    schema = pa.schema([("tree", pa.string()), ("higher", pa.list_(step)), ("whole", pa.string())])
    rows = blocks.select("blocks", "nodes", "higher", "whole")
    return map_batches(rows, run, f"tree string, higher {_STEPS}, whole string")


def proofs(blocks: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(source, doc_id, leaf, path) of every leaf of a manifest: the (left, right) siblings that
    lead from it to the root, about 1 KB a level. Hashing left, the node and right, level by
    level, gives the root."""

    def rows(row, steps, upper):
        for k, node in enumerate(row["nodes"]):
            path = [step[k // fanout**i] for i, step in enumerate(steps)] + upper
            yield {
                "source": row["source"], "doc_id": node["doc_id"], "leaf": node["digest"],
                "path": [{"left": a, "right": b} for a, b in path],
            }

    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    schema = pa.schema([
        ("source", pa.string()), ("doc_id", pa.int64()), ("leaf", pa.string()),
        ("path", pa.list_(step)),
    ])
    return _each_leaf(
        blocks, rows, schema, f"source string, doc_id long, leaf string, path {_STEPS}", fanout,
        block_levels,
    )


def verified(blocks: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf of a
    manifest: the digest of its proof's siblings from left to right and level by level, the root
    that its claimed digest leads to with them, and whether that is the manifest's."""

    def rows(row, steps, upper):
        top = "".join(a + b for a, b in upper).encode()
        for k, node in enumerate(row["nodes"]):
            path = [step[k // fanout**i] for i, step in enumerate(steps)]
            proof = hashlib.sha256("".join(a + b for a, b in path).encode())
            proof.update(top)
            folded = node["claimed"]
            for left, right in path + upper:
                folded = _digest(left + folded + right)
            yield {
                "doc_id": node["doc_id"], "leaf": node["digest"], "subroot": row["subroot"],
                "root": row["root"], "proof_sha256": proof.hexdigest(), "folded_root": folded,
                "verified": folded == row["root"],
            }

    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema(
        [("doc_id", pa.int64()), *((t, pa.string()) for t in texts), ("verified", pa.bool_())]
    )
    sql = ", ".join(["doc_id long", *(f"{t} string" for t in texts), "verified boolean"])
    return _each_leaf(blocks, rows, schema, sql, fanout, block_levels)


def _each_leaf(blocks, rows, schema: pa.Schema, sql: str, fanout: int, levels: int) -> DataFrame:
    """A row for each leaf, by `rows` from a block, its inner steps and those above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                many = levels if row["blocks"] > 1 else None
                steps, _ = _levels([n["digest"] for n in row["nodes"]], fanout, many)
                upper = [(s["left"], s["right"]) for s in row["path"]]
                yield pa.RecordBatch.from_pylist(list(rows(row, steps, upper)), schema=schema)

    return map_batches(blocks, run, sql)
