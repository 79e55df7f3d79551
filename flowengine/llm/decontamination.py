"""Benchmark decontamination: test phrases searched for in an FM-index of each training shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised
from flowengine.llm.fm_index import SHARD_SYMBOLS, Index, Vocabulary, hashes, ranges

#: Words of a phrase; an item of fewer is one phrase.
WINDOW = 10
#: Words of items that are broadcast at a time; more items are searched for in several passes.
BLOCK_WORDS = 2_000_000
#: Longer items are cut into parts of so many words, which overlap by a phrase less one word.
PART_WORDS = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPAN = "struct<first_word:long,last_word:long,start:long,end:long>"


def _byte_classes() -> np.ndarray:
    """What each byte is in a word: itself, lower-cased if A-Z; 0 if it separates words."""
    table = np.zeros(256, dtype=np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low:high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_CLASSES = _byte_classes()


@dataclass
class _Phrases:
    """A block of items: distinct words, the items as numbers of these, and the phrases' places."""

    text: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    hashed: np.ndarray
    words: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    names: list[str]


def _item_parts(items: DataFrame, window: int) -> DataFrame:
    """(item, words) of each part of an item that has words."""
    lowered = F.translate(F.col("text"), _UPPER, _LOWER)
    words = F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))
    step = PART_WORDS - window + 1
    last = F.greatest(F.size("words") - window, F.lit(0))
    return (
        items.select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .withColumn("from", F.explode(F.sequence(F.lit(0), last, F.lit(step))))
        .select("item", F.slice("words", F.col("from") + 1, F.lit(PART_WORDS)).alias("words"))
    )


def _phrases(parts: pa.Table, window: int) -> _Phrases:
    known: dict[str, int] = {}
    names: dict[str, int] = {}
    numbers, begins, lengths, owners, at = [], [], [], [], 0
    for item, words in zip(parts.column(0), parts.column(1), strict=True):
        found = np.array(
            [known.setdefault(w, len(known)) for w in words.as_py()], dtype=np.int64
        )
        many = max(1, len(found) - window + 1)
        name = item.as_py()
        owner = -1 if name is None else names.setdefault(name, len(names))
        numbers.append(found)
        begins.append(at + np.arange(many))
        lengths.append(np.full(many, min(window, len(found))))
        owners.append(np.full(many, owner))
        at += len(found)
    raw = [w.encode() for w in known]
    # a zero byte parts the words
    text = np.frombuffer(b"\0".join(raw) + b"\0", dtype=np.uint8)
    sizes = np.array([len(w) for w in raw], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    return _Phrases(
        text, starts, starts + sizes, hashes(text, starts, starts + sizes),
        *map(np.concatenate, (numbers, begins, lengths, owners)), list(names),
    )


class _Texts:
    """The words of a batch's texts, as places in its bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        edges = np.frombuffer(offsets, dtype=np.int32)[texts.offset:][:len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        self.raw = raw[edges[0]:edges[-1]]
        self.edges = edges.astype(np.int64) - edges[0]
        self.text = _CLASSES[self.raw]
        inside = np.zeros(len(self.text) + 1, dtype=bool)
        inside[:-1] = self.text != 0
        # a word ends where its text ends
        fresh = np.zeros(len(inside), dtype=bool)
        fresh[self.edges] = True
        before = np.concatenate([[False], inside[:-1]])
        self.starts = np.flatnonzero(inside & (fresh | ~before))
        self.stops = np.flatnonzero(before & (fresh | ~inside))
        self.first_words = np.searchsorted(self.starts, self.edges)
        self.hashed = hashes(self.text, self.starts, self.stops)

    def segments(self, window: int) -> Iterator[tuple[int, int]]:
        """(first, last) words of stretches that fit into a shard; a longer text is several, with
        overlaps that hold every phrase."""
        most = SHARD_SYMBOLS - 1
        for first, last in zip(self.first_words[:-1], self.first_words[1:], strict=True):
            while last - first > most:
                yield first, first + most
                first += most - window + 1
            if last > first:
                yield first, last

    def characters(self, row: int, places: np.ndarray) -> np.ndarray:
        """How many characters of the row's text are before each place."""
        start, stop = self.edges[row], self.edges[row + 1]
        begun = np.cumsum(self.raw[start:stop] & 0xC0 != 0x80)
        return np.concatenate([[0], begun])[places - start]


def _shards(segments: Iterator[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    shard, size = [], 0
    for first, last in segments:
        if size + last - first + 1 > SHARD_SYMBOLS:
            yield shard
            shard, size = [], 0
        shard.append((first, last))
        size += last - first + 1
    if shard:
        yield shard


def _hits(texts: _Texts, shard: list[tuple[int, int]], phrases: _Phrases):
    """(word, length, phrases) of each occurrence in a shard: where it begins, and the number of
    its group of equal phrases; and the group of each phrase that occurs, as (phrase, group)."""
    firsts, lasts = (np.array(x, dtype=np.int64) for x in zip(*shard, strict=True))
    sizes = lasts - firsts
    inside = ranges(firsts, sizes)
    vocabulary = Vocabulary(
        texts.text, texts.starts[inside], texts.stops[inside], texts.hashed[inside]
    )
    ids = vocabulary.find(phrases.text, phrases.starts, phrases.stops, phrases.hashed)
    spelled = ids[phrases.words]
    unknown = np.concatenate([[0], np.cumsum(spelled == 0)])
    possible = np.flatnonzero(
        unknown[phrases.begins] == unknown[phrases.begins + phrases.lengths]
    )
    if not len(possible):
        return None
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    word_at = np.zeros(len(symbols), dtype=np.int64)
    places = ranges(ends - sizes, sizes)
    symbols[places], word_at[places] = vocabulary.ids, inside
    index = Index(symbols, vocabulary.size)
    found, low, high = index.search(spelled, phrases.begins[possible], phrases.lengths[possible])
    if not len(found):
        return None
    found = possible[found]
    # equal phrases have the same rows, which are located once
    rows, first, group = np.unique(
        np.stack([low, high, phrases.lengths[found]]), axis=1, return_index=True,
        return_inverse=True,
    )
    many = rows[1] - rows[0]
    located = word_at[index.locate(ranges(rows[0], many))]
    groups = np.arange(len(many))
    return (
        located, np.repeat(rows[2], many), np.repeat(groups, many), found, group.reshape(-1)
    )


def _pairs(rows: np.ndarray, groups: np.ndarray, owners: np.ndarray, of: np.ndarray):
    """The distinct (row, item) of occurrences; `of` is the group of each owner's phrase."""
    known = np.unique(np.stack([of, owners]), axis=1)
    known = known[:, known[1] >= 0]
    low = np.searchsorted(known[0], groups, side="left")
    many = np.searchsorted(known[0], groups, side="right") - low
    return np.repeat(rows, many), known[1][ranges(low, many)]


def _searched(texts: _Texts, phrases: _Phrases, window: int):
    """(hit, rows, items): which words of the batch are in an occurrence, and distinct pairs."""
    change = np.zeros(len(texts.starts) + 1, dtype=np.int64)
    pairs = [np.zeros((2, 0), dtype=np.int64)]
    for shard in _shards(texts.segments(window)):
        hits = _hits(texts, shard, phrases)
        if hits is None:
            continue
        words, lengths, groups, found, of = hits
        change += np.bincount(words, minlength=len(change))
        change -= np.bincount(words + lengths, minlength=len(change))
        rows = np.searchsorted(texts.first_words, words, side="right") - 1
        seen = np.unique(np.stack([rows, groups]), axis=1)
        pairs.append(np.stack(_pairs(*seen, phrases.items[found], of)))
    rows, items = np.unique(np.concatenate(pairs, axis=1), axis=1)
    return np.cumsum(change[:-1]) > 0, rows, items


def _spans(texts: _Texts, hit: np.ndarray) -> dict[int, list[dict]]:
    """The runs of hit words of each row that has some."""
    edge = np.zeros(len(hit) + 1, dtype=bool)
    edge[texts.first_words] = True
    before = np.concatenate([[False], hit])
    after = np.concatenate([hit, [False]])
    begins = np.flatnonzero(after & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~after))
    rows = np.searchsorted(texts.first_words, begins, side="right") - 1
    out: dict[int, list[dict]] = {}
    for row in np.unique(rows):
        those = rows == row
        first, last = begins[those], ends[those]
        base = texts.first_words[row]
        start = texts.characters(row, texts.starts[first])
        end = texts.characters(row, texts.stops[last - 1])
        out[int(row)] = [
            dict(zip(("first_word", "last_word", "start", "end"), map(int, span), strict=True))
            for span in zip(first - base, last - base, start, end, strict=True)
        ]
    return out


def _search(rows: DataFrame, phrases, window: int, carried: str) -> DataFrame:
    """(key, n_words, items, spans and what `carried` names) of rows with key, text and those."""
    span = pa.struct([(n, pa.int64()) for n in ("first_word", "last_word", "start", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = _Texts(batch.column(1))
            hit, owners, items = _searched(texts, phrases.value, window)
            names = [[] for _ in range(batch.num_rows)]
            for row, item in zip(owners.tolist(), items.tolist(), strict=True):
                names[row].append(phrases.value.names[item])
            spans = _spans(texts, hit)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.diff(texts.first_words), pa.int64()),
                    pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                    pa.array([spans.get(k, []) for k in range(batch.num_rows)], pa.list_(span)),
                    *batch.columns[2:],
                ],
                ["key", "n_words", "items", "spans", *batch.schema.names[2:]],
            )

    schema = f"key long, n_words long, items array<string>, spans array<{_SPAN}>{carried}"
    return map_batches(rows, run, schema)


def _merged(spans: Column) -> Column:
    """Spans of several passes as one list in order, those that meet joined."""
    none = F.array().cast(f"array<{_SPAN}>")

    def join(done, span):
        last = F.try_element_at(done, F.lit(-1))
        whole = F.struct(
            last["first_word"].alias("first_word"),
            F.greatest(last["last_word"], span["last_word"]).alias("last_word"),
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"),
        )
        earlier = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(
            span["first_word"] <= last["last_word"], F.concat(earlier, F.array(whole))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), none, join)


def find(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, keep_text: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every document, and its text if `keep_text`.

    Words are runs of digits, letters a-z and everything beyond ASCII, with A-Z lower-cased. A
    phrase is `window` consecutive words of an item (item_id, text), or all of a shorter item; a
    document's word is hit if it is in any occurrence of a phrase. `items` are the ids, sorted as
    strings, of the items with phrases that occur; `spans` are the runs of hit words, as words
    [first_word, last_word) and as characters [start, end) of the text, all counted from 0.

    A task indexes its documents in shards of up to 2^20 words and separators, which bounds its
    memory; a longer text is several shards that overlap. Phrases that occur are located once for
    all items that share them. Items are broadcast in blocks of about `block_words` words, and
    documents are searched once for each block. No document is shuffled.

    Null and empty texts have no words. An item without words has no phrases; one without an id
    hits words but is in no list; rows of one id are one item. Every input row gives one row,
    repeated rows and null ids too. Without items or documents nothing is hit. Other columns are
    left out, whatever their names.
    """
    spark = documents.sparkSession
    parts = materialised(_item_parts(items, window), "phrases")
    total = parts.agg(F.sum(F.size("words"))).first()[0] or 0
    rows = documents.select(F.col("doc_id").cast("long").alias("key"), "text")
    if keep_text:
        rows = rows.withColumn("kept", F.col("text"))
    carried = ", kept string" if keep_text else ""
    blocks = max(1, -(-total // block_words))
    if blocks > 1:
        rows = materialised(
            rows.withColumn("id", F.col("key")).withColumn("key", F.monotonically_increasing_id()),
            "numbered-documents",
        )
        carried += ", id long"
    if not total:
        found = rows.select(
            "key", F.size(F.regexp_extract_all(
                F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0)
            )).cast("long").alias("n_words"),
            F.array().cast("array<string>").alias("items"),
            F.array().cast(f"array<{_SPAN}>").alias("spans"), *rows.columns[2:],
        )
    else:
        passes = []
        for block in range(blocks):
            own = F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block
            table = parts.where(own).toArrow() if blocks > 1 else parts.toArrow()
            if table.num_rows:
                phrases = spark.sparkContext.broadcast(_phrases(table, window))
                passes.append(_search(rows, phrases, window, carried))
        found = passes[0] if blocks == 1 else _over_passes(passes)
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"]
    )
    text = [F.col("kept").alias("text")] if keep_text else []
    return found.select(
        F.col("key").alias("doc_id"), "n_words", n_hit.alias("n_hit"), "items", "spans", *text
    )


def _over_passes(passes: list[DataFrame]) -> DataFrame:
    """One row for each document, of the rows that each pass has of it."""
    every = materialised(passes[0], "pass")
    for later in passes[1:]:
        every = every.unionByName(materialised(later, "pass"))
    kept = [F.any_value("kept").alias("kept")] if "kept" in every.columns else []
    together = every.groupBy("key").agg(
        F.any_value("id").alias("id"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"), *kept,
    )
    return together.withColumn("spans", _merged(F.col("spans"))).drop("key").withColumnRenamed(
        "id", "key"
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text less its spans of characters, which are in order and apart; null of a null text."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(
        F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long"))
    )
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda x: F.substring(text, x["a"] + 1, x["b"] - x["a"]),
    )
    return F.when(text.isNotNull(), F.array_join(pieces, ""))


def decontaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_hit, items): the documents without the words that are hit, nor what stands
    between two of them in one span. A null text stays null."""
    found = find(documents, items, window, keep_text=True)
    return found.select(
        "doc_id", without_spans(F.col("text"), F.col("spans")).alias("text"), "n_hit", "items"
    )
