"""Byte-pair encoding and decoding with an explicit merge queue."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import Learned, map_batches, windows

#: Fixed value: the rule by which byte-level BPE vocabularies of this kind split a text into words.
SPLIT_RULE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Texts are encoded in parts of about so many characters.
WINDOW_CHARS = 1 << 20
#: Texts and parts of about so many characters together are encoded at a time.
CHUNK_CHARS = 4 << 20
#: Short pieces that a Python worker remembers with their ids, about 200 bytes each.
REMEMBERED, REMEMBERED_CHARS = 1 << 18, 32
#: Words that are merged side by side, and the bytes of a longer one, which is merged alone.
SIDE_BY_SIDE, SHORT_BYTES = 1 << 12, 48
#: Ids that are decoded at a time.
DECODED_IDS = 1 << 18
_ID_BITS = 20
_NONE, _NO_RANK = -1, (1 << 31) - 1

_models: dict[str, "Model"] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others for the code points from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Model:
    """A byte-level BPE vocabulary: merge ranks for encoding, byte strings for decoding."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        kind = (stored["model"]["type"], stored["pre_tokenizer"]["type"], stored["normalizer"])
        if kind != ("BPE", "ByteLevel", None) or stored["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        vocabulary = stored["model"]["vocab"]
        letters = _byte_letters()
        self.byte_ids = [vocabulary[letter] for letter in letters]
        self.rank_of, self.merged = {}, []
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[vocabulary[left] << _ID_BITS | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.strings = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in vocabulary.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.strings[i] = token.encode()
        self.added = {token: _packed([i]) for token, i in added.items()}
        self.added_rule = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.words = regex.compile(SPLIT_RULE).findall
        self.known = Learned(self._pieces_ids, REMEMBERED, REMEMBERED_CHARS)
        self._arrays(stored_pairs=sorted(self.rank_of.items()))

    def _arrays(self, stored_pairs: list[tuple[int, int]]) -> None:
        """The same tables for many words at a time."""
        self.pair_keys = np.array([key for key, _ in stored_pairs] + [1 << 62], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in stored_pairs] + [_NO_RANK], dtype=np.int32)
        self.merged_ids = np.array(self.merged + [0], dtype=np.int32)
        self.byte_id_array = np.array(self.byte_ids, dtype=np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << _ID_BITS | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NO_RANK)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many words. Short ones of like length are merged side by side."""
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        out: list[bytes] = [b""] * len(words)
        for start in range(0, len(order), SIDE_BY_SIDE):
            part = [k for k in order[start:start + SIDE_BY_SIDE] if len(words[k]) <= SHORT_BYTES]
            if part:
                for k, ids in zip(part, self._side_by_side([words[k] for k in part]), strict=True):
                    out[k] = ids
        for k in order:
            if len(words[k]) > SHORT_BYTES:
                out[k] = _packed(self.merge(words[k]))
        return out

    def _side_by_side(self, words: list[bytes]) -> Iterator[bytes]:
        """`merge` for many words at once, a row of arrays each: `queue` has a word's ranks at the
        places of their pairs, `after` and `before` link its symbols. Each round pops every word's
        lowest rank, leftmost first; entries of places that are merged away are stale and skipped.
        """
        lengths = np.array([len(w) for w in words])
        n, width = len(words), int(lengths.max())
        symbols = np.full((n, width), _NONE, dtype=np.int32)
        symbols[np.arange(width) < lengths[:, None]] = self.byte_id_array[
            np.frombuffer(b"".join(words), dtype=np.uint8)
        ]
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        after[np.arange(n), lengths - 1] = width
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (n, 1))
        queue = np.full((n, width), _NO_RANK, dtype=np.int32)
        if width > 1:
            pairs = symbols[:, 1:] >= 0
            queue[:, :-1][pairs] = self._ranks(symbols[:, :-1][pairs], symbols[:, 1:][pairs])
        rows = np.arange(n)
        while len(rows):
            at = queue[rows].argmin(axis=1)
            rank = queue[rows, at]
            some = rank < _NO_RANK
            rows, at, rank = rows[some], at[some], rank[some]
            stale = symbols[rows, at] < 0
            queue[rows[stale], at[stale]] = _NO_RANK
            r, at, merged = rows[~stale], at[~stale], self.merged_ids[rank[~stale]]
            other = after[r, at]
            following = after[r, other]
            symbols[r, at], symbols[r, other] = merged, _NONE
            after[r, at] = following
            queue[r, at] = _NO_RANK
            more = np.flatnonzero(following < width)
            there = following[more]
            before[r[more], there] = at[more]
            queue[r[more], at[more]] = self._ranks(merged[more], symbols[r[more], there])
            preceding = before[r, at]
            more = np.flatnonzero(preceding >= 0)
            there = preceding[more]
            queue[r[more], there] = self._ranks(symbols[r[more], there], merged[more])
        left = symbols >= 0
        ids = symbols[left].astype("<u4").tobytes()
        ends = np.cumsum(left.sum(axis=1)) * 4
        return (ids[a:b] for a, b in itertools.pairwise([0, *ends.tolist()]))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none is left.

        Symbols form a doubly linked list. The queue holds ranks with the places of their pairs;
        `waiting` has each place's newest entry, and an entry that is not the newest is skipped.
        """
        symbols = [*map(self.byte_ids.__getitem__, word)]
        n = len(symbols)
        if n == 1:
            return symbols
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        rank_of, push, pop = self.rank_of.get, heapq.heappush, heapq.heappop
        bits = n.bit_length()
        places = (1 << bits) - 1
        waiting = [
            _NONE if (rank := rank_of(left << _ID_BITS | right)) is None else rank << bits | at
            for at, (left, right) in enumerate(itertools.pairwise(symbols))
        ]
        queue = [entry for entry in waiting if entry >= 0]
        if not queue:
            return symbols
        heapq.heapify(queue)
        waiting.append(_NONE)
        while queue:
            entry = pop(queue)
            at = entry & places
            if waiting[at] != entry:
                continue
            symbols[at] = merged = self.merged[entry >> bits]
            other = after[at]
            symbols[other] = waiting[other] = waiting[at] = _NONE
            after[at] = following = after[other]
            if following < n:
                before[following] = at
                rank = rank_of(merged << _ID_BITS | symbols[following])
                if rank is not None:
                    waiting[at] = entry = rank << bits | at
                    push(queue, entry)
            preceding = before[at]
            if preceding >= 0:
                rank = rank_of(symbols[preceding] << _ID_BITS | merged)
                if rank is None:
                    waiting[preceding] = _NONE
                else:
                    waiting[preceding] = entry = rank << bits | preceding
                    push(queue, entry)
        return [s for s in symbols if s >= 0]

    def _pieces_ids(self, unknown: list[str]) -> Iterator[bytes]:
        """Packed ids of pieces, whose words are merged together."""
        # letters alone, with or without a blank before them, are one word
        split = [
            [p] if p.isascii() and p[p[0] == " ":].isalpha() else self.words(p) for p in unknown
        ]
        words = list(dict.fromkeys(itertools.chain.from_iterable(split)))
        ids_of = dict(zip(words, self.merge_many([w.encode() for w in words]), strict=True))
        for parts in split:
            yield ids_of[parts[0]] if len(parts) == 1 else b"".join(map(ids_of.__getitem__, parts))

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        """Every whole text's ids, packed as little-endian unsigned 32-bit integers."""
        packed: list[list[bytes]] = []

        def windowed() -> Iterator[tuple[int, str]]:
            """Every place among the ids that a stretch of ordinary text fills, with the text."""
            for text in texts:
                packed.append([])
                for k, part in enumerate(self.added_rule.split(text) if self.added_rule else [text]):
                    if k % 2:
                        packed[-1].append(self.added[part])
                        continue
                    for window in windows(part, WINDOW_CHARS) if part else ():
                        packed[-1].append(b"")
                        places.append((len(packed) - 1, len(packed[-1]) - 1))
                        yield len(places) - 1, window

        places: list[tuple[int, int]] = []
        ids_of = self.known.__getitem__
        for number, parts in self.known.over(windowed(), CHUNK_CHARS):
            row, at = places[number]
            packed[row][at] = b"".join(map(ids_of, parts))
        return [b"".join(p) for p in packed]

    def encode(self, text: str) -> bytes:
        """One text's ids."""
        return self.encode_many([text])[0]

    def decoded(self, packed: bytes) -> Iterator[str]:
        """The text of packed ids in parts: their byte strings one after the other."""
        decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
        ids = np.frombuffer(packed, dtype="<u4")
        for at in range(0, len(ids), DECODED_IDS):
            part = ids[at:at + DECODED_IDS].tolist()
            yield decoder.decode(b"".join(map(self.strings.__getitem__, part)))
        yield decoder.decode(b"", final=True)

    def decode(self, packed: bytes) -> str:
        """The whole text of packed ids."""
        return "".join(self.decoded(packed))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def model(path: str) -> Model:
    """The vocabulary at `path`, read once by a Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids): every whole text's token ids, packed as little-endian unsigned 32-bit
    integers, which is how training loaders map them.

    `tokenizer` is the path of a byte-level BPE file that every executor has. Strings of added
    tokens inside a text become those tokens; none are put at the ends.

    A null text counts as an empty one and has no ids. Every input row gives one row, repeated
    rows and null ids too; other columns are left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model(tokenizer)
        for batch in batches:
            ids = vocabulary.encode_many(t.as_py() or "" for t in batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text): the text of each row's packed ids, added tokens' strings included.

    Null ids count as none: their text is empty. Bytes that are not UTF-8 become U+FFFD. Every
    input row gives one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model(tokenizer)
        for batch in batches:
            texts = [vocabulary.decode(ids.as_py() or b"") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"],
            )

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return map_batches(rows, run, "doc_id long, ids binary, text string")


def round_trip(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): every whole text's packed ids as
    `encode` has them, and digests of them and of the text that they decode to.

    One function does all of it, so that a task has one Python worker with one vocabulary, and
    texts and ids cross to Python and back once. A null text counts as an empty one. Every input
    row gives one row, repeated rows and null ids too; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model(tokenizer)
        for batch in batches:
            ids = vocabulary.encode_many(t.as_py() or "" for t in batch.column(1))
            marks, texts = [], []
            for packed in ids:
                digest = hashlib.sha256()
                for part in vocabulary.decoded(packed):
                    digest.update(part.encode())
                marks.append(hashlib.sha256(packed).hexdigest())
                texts.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(ids, pa.binary()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(marks, pa.string()), pa.array(texts, pa.string()),
                ],
                ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(
        rows, run,
        "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
