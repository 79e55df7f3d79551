"""Spelling variants: edits of every word, probed in Bloom filters, confirmed by an exact join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised, send_package

#: Maximal runs of these are words.
LETTERS = r"a-zÀ-ÿ"
#: Code points and occurrences that a word has at least.
MIN_LENGTH, MIN_COUNT = 6, 5
#: How many times as often as a word its form occurs, at least.
TIMES = 5
#: Filter bits for each word, and bytes of filters that are broadcast at a time.
BITS_PER_WORD, FILTER_BYTES = 16, 64 << 20
#: Words of this many code points or more share a filter.
LONGEST = 64
#: One task builds so many blocks of a filter.
SEGMENT_BLOCKS = 1024
#: Edits that are probed together.
EDITS = 1 << 19

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# a block has eight lanes of 32 bits, and a word sets one bit in each
_LANES, _LANE_BITS, _BLOCK_BITS = 8, 32, 256
_BASE = 0x9E3779B97F4A7C15
_EDIT = "word_key long, edit_key long, at int, letter string"


def count_words(documents: DataFrame, min_length: int = MIN_LENGTH, noise: int | None = None):
    """(word, n): how often each word of at least `min_length` code points occurs in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased.
    With `noise`, an occurrence whose hash (CRC-32 of `<doc_id>:<run>`, unsigned) it divides loses
    the code point at the hash modulo its length, and its length counts after that; a null doc_id
    is the text `null` there. Null and empty texts have no words. Rows are counted as often as
    they are there; other columns are left out, whatever their names.
    """
    text = F.translate(F.col("text"), _UPPER, _LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    words = documents.select(doc_id.alias("doc_id"), F.explode(runs).alias("word"))
    if noise:
        marked = F.concat("doc_id", F.lit(":"), "word")
        words = words.withColumn("h", F.crc32(marked.cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = _without(F.col("word"), at)
        words = words.select(
            F.when(F.col("h") % noise == 0, shorter).otherwise(F.col("word")).alias("word")
        ).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _without(word: Column, at: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


# ---- hashes of words and of their edits

def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _mixed(sums: np.ndarray, length: int) -> np.ndarray:
    """Keys of words of one length, of the sums of their letters times powers."""
    keys = sums ^ np.uint64(length * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        keys ^= keys >> np.uint64(shift)
        keys *= np.uint64(factor)
    keys ^= keys >> np.uint64(33)
    return keys


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, letters): the words of each length as a matrix of code points."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        text = "".join(words[k] for k in places).encode("utf-32-le")
        letters = np.frombuffer(text, dtype="<u4").reshape(len(places), length)
        yield places, letters.astype(np.uint64)


def _word_keys(letters: np.ndarray) -> np.ndarray:
    length = letters.shape[1]
    return _mixed((letters * _powers(length)).sum(axis=1, dtype=np.uint64), length)


def _edits(letters: np.ndarray, alphabet: np.ndarray):
    """(row, at, letter, key, length) arrays of the words' edits: every replacement by a later
    letter of the alphabet, and every deletion that gives a result of its own, with letter 0.
    Insertions and replacements by earlier letters are these, seen from the other word."""
    n, length = letters.shape
    powers = _powers(length)
    terms = letters * powers
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = before[:, -1:]
    fresh = np.ones(letters.shape, dtype=bool)
    fresh[:, 1:] = letters[:, 1:] != letters[:, :-1]
    step = max(1, EDITS // (n * (len(alphabet) + 1)))
    for low in range(0, length, step):
        at = slice(low, low + step)
        here = letters[:, at]
        rows, places, kinds = np.nonzero(alphabet > here[:, :, None])
        change = (alphabet[kinds] - here[rows, places]) * powers[low + places]
        yield rows, low + places, alphabet[kinds], _mixed(whole[rows, 0] + change, length), length
        if length > 1:
            rows, places = np.nonzero(fresh[:, at])
            rest = (whole - before)[rows, low + places] * _INVERSE
            sums = before[rows, low + places] - terms[rows, low + places] + rest
            none = np.zeros(len(rows), dtype=np.uint64)
            yield rows, low + places, none, _mixed(sums, length - 1), length - 1


# ---- filters

class _Layout:
    """Where the blocks of each length's filter are: filters are whole segments, one after the
    other, so that any range of segments can be broadcast alone."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = np.zeros(LONGEST + 1, dtype=np.uint64)
        self.first = np.zeros(LONGEST + 1, dtype=np.int64)
        at = 0
        for shard, n in sorted(counts.items()):
            self.blocks[shard] = max(1, -(-n * BITS_PER_WORD // _BLOCK_BITS))
            self.first[shard] = at
            at += -(-int(self.blocks[shard]) // SEGMENT_BLOCKS) * SEGMENT_BLOCKS
        self.segments = at // SEGMENT_BLOCKS

    def block(self, keys: np.ndarray, length: int) -> np.ndarray:
        """The block of each key, counted over all filters; -1 where its length has no words."""
        shard = min(length, LONGEST)
        if not self.blocks[shard]:
            return np.full(len(keys), -1)
        # of all bits of the keys, whatever range these are from
        high = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) * self.blocks[shard]
        high >>= np.uint64(32)
        return self.first[shard] + high.astype(np.int64)


def _lane_bits(keys: np.ndarray, lane: int) -> np.ndarray:
    place = keys * np.uint64(0x9FB21C651E98DF25) >> np.uint64(24 + 5 * lane) & np.uint64(31)
    return np.uint32(1) << place.astype(np.uint32)


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """(word, n, key) of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            keys = np.zeros(len(words), dtype=np.uint64)
            for places, letters in _by_length(words):
                keys[places] = _word_keys(letters)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys.view(np.int64))], ["word", "n", "key"]
            )

    return map_batches(vocabulary, run, "word string, n long, key long")


def _segments(keyed: DataFrame, layout: _Layout) -> DataFrame:
    """(segment, bits): each segment's blocks, made by one task from the words that fall into it.
    Keys are spread evenly, so a segment has about `SEGMENT_BLOCKS` * 16 words."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            blocks = np.zeros(len(keys), dtype=np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                blocks[own] = layout.block(keys[own], int(length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(blocks), pa.array(blocks // SEGMENT_BLOCKS)],
                ["key", "block", "segment"],
            )

    def filled(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(np.uint64)
        segment = rows.column("segment")[0].as_py()
        blocks = rows.column("block").to_numpy() - segment * SEGMENT_BLOCKS
        bits = np.zeros((SEGMENT_BLOCKS, _LANES), dtype=np.uint32)
        for lane in range(_LANES):
            np.bitwise_or.at(bits[:, lane], blocks, _lane_bits(keys, lane))
        return pa.table({
            "segment": pa.array([segment], pa.int64()),
            "bits": pa.array([bits.tobytes()], pa.binary()),
        })

    send_package(keyed.sparkSession)
    rows = keyed.select("key", F.length("word").alias("length"))
    placed = map_batches(rows, numbered, "key long, block long, segment long")
    return placed.groupBy("segment").applyInArrow(filled, "segment long, bits binary")


def _positives(keyed: DataFrame, layout: _Layout, first: int, bits, alphabet) -> DataFrame:
    """(word_key, edit_key, at, letter) of the edits that may be words, as far as the broadcast
    segments from `first` on tell. Only hashes and places are made, no edited word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = bits.value
        low, size = first * SEGMENT_BLOCKS, len(filters)
        for batch in batches:
            words = batch.column(0).to_pylist()
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for places, letters in _by_length(words):
                rows = max(1, EDITS // (letters.shape[1] * (len(alphabet) + 1)))
                for start in range(0, len(places), rows):
                    part = letters[start:start + rows]
                    for row, at, letter, edited, length in _edits(part, alphabet):
                        block = layout.block(edited, length) - low
                        there = np.flatnonzero((block >= 0) & (block < size))
                        for lane in range(_LANES):
                            want = _lane_bits(edited[there], lane)
                            there = there[filters[block[there], lane] & want != 0]
                        if len(there):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(keys[places[start + row[there]]]),
                                    pa.array(edited[there].view(np.int64)),
                                    pa.array(at[there], pa.int32()),
                                    pa.array([chr(x) if x else "" for x in letter[there].tolist()]),
                                ],
                                ["word_key", "edit_key", "at", "letter"],
                            )

    return map_batches(keyed.select("word", "key"), run, _EDIT)


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): pairs of words that differ by one inserted, deleted or replaced
    code point, in both directions.

    `vocabulary` has distinct, non-null words and their n. Every word's edits are probed in
    blocked Bloom filters, one for each length, that are broadcast in passes of at most
    `filter_bytes`; positives alone are shuffled, as hashes, and joined with the vocabulary, where
    the edited word has to be equal. Edits take the letters that occur in the vocabulary. Without
    words there are no pairs.
    """
    spark = vocabulary.sparkSession
    keyed = materialised(_keyed(vocabulary.select("word", "n")), "keyed-words")
    shard = F.least(F.length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r.shard: r.n for r in keyed.groupBy(shard).agg(F.count("*").alias("n")).collect()}
    layout = _Layout(counts)
    used = keyed.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = np.array(
        sorted(ord(r.letter) for r in used.where("letter <> ''").collect()), dtype=np.uint64
    )
    segments = materialised(_segments(keyed, layout), "filter-segments")
    at_a_time = max(1, filter_bytes // (SEGMENT_BLOCKS * _BLOCK_BITS // 8))
    found = None
    for first in range(0, layout.segments, at_a_time):
        own = segments.where(F.col("segment").between(first, first + at_a_time - 1))
        many = min(at_a_time, layout.segments - first)
        filters = np.zeros((many, SEGMENT_BLOCKS, _LANES), dtype=np.uint32)
        for row in own.toLocalIterator():
            filters[row.segment - first] = np.frombuffer(row.bits, np.uint32).reshape(-1, _LANES)
        bits = spark.sparkContext.broadcast(filters.reshape(-1, _LANES))
        passed = materialised(_positives(keyed, layout, first, bits, alphabet), "positives")
        found = passed if found is None else found.union(passed)
        bits.unpersist()
    if found is None:
        found = spark.createDataFrame([], _EDIT)
    a, b = (
        keyed.select(*(F.col(c).alias(f"{side}_{c}") for c in ("word", "n", "key")))
        for side in "ab"
    )
    at, word = F.col("at"), F.col("a_word")
    edited = F.concat(
        F.substring(word, F.lit(1), at), F.col("letter"),
        F.substring(word, at + 2, F.length(word)),
    )
    pairs = (
        found.join(b, F.col("edit_key") == F.col("b_key"))
        .join(a, F.col("word_key") == F.col("a_key"))
        .where(edited == F.col("b_word"))
    )
    ends = F.array(
        F.struct(F.col("a_word").alias("word"), F.col("a_n").alias("n"),
                 F.col("b_word").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b_word").alias("word"), F.col("b_n").alias("n"),
                 F.col("a_word").alias("near"), F.col("a_n").alias("near_n")),
    )
    return pairs.select(F.inline(ends))


def variants(vocabulary: DataFrame, times: int = TIMES, filter_bytes: int = FILTER_BYTES):
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n).

    `n_near` counts the words near to it. Its form is the near word of largest n, of equal ones
    the first in code-point order, if it occurs `times` as often; else null. Its root is where
    forms lead to in the end, the word itself if it has none. As n grows at each step, there are
    no cycles, and a chain's length is bounded by the logarithm of the largest n; roots are found
    by doubling. Rows with a null word or n are left out; rows of one word are added up.
    """
    words = materialised(
        vocabulary.dropna(subset=["word", "n"]).groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    best = near_words(words, filter_bytes).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    formed = materialised(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    most, least = formed.agg(F.max("n"), F.min("n")).first()
    steps = int(math.log(most / max(least, 1), times)) + 1 if most and times > 1 else 1
    up = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, steps).bit_length()):
        step = up.select(F.col("word").alias("via"), F.col("root").alias("further"))
        up = materialised(
            up.join(step, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ),
            "roots",
        )
    return formed.join(up, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
