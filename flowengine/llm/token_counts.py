"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import Learned, map_batches, windows

#: Texts are taken apart in parts of about so many characters.
WINDOW_CHARS = 1 << 20
#: Texts and parts of about so many characters are counted together.
CHUNK_CHARS = 4 << 20
#: One call of the encoder gets pieces of about so many bytes, if no piece has more.
BATCH_BYTES = 1 << 20
#: Lengths of at most twice so many short pieces are remembered by a Python worker.
REMEMBERED, REMEMBERED_CHARS = 1 << 17, 32

_counters: dict[str, "_Counter"] = {}


class _Counter:
    """Token lengths of pieces. Equal pieces are encoded once while they are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # a task has one core; the library's own threads would spin on the others'
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Learned(self._lengths, REMEMBERED, REMEMBERED_CHARS)

    def _lengths(self, pieces: list[str]) -> Iterator[int]:
        """Tokens of each piece, encoded in batches that have about as many bytes each."""
        sizes = np.cumsum([len(p.encode()) for p in pieces], dtype=np.int64)
        batches = max(1, round(int(sizes[-1]) / BATCH_BYTES)) if pieces else 0
        ends = np.searchsorted(sizes, np.arange(1, batches + 1) * sizes[-1] / batches) + 1 if batches else []
        for low, high in itertools.pairwise([0, *map(int, ends)]):
            batch = pieces[low:high]
            if batch:
                yield from map(
                    len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                )

    def count_many(self, texts: Iterable[str]) -> list[int]:
        """Tokens of every whole text."""
        totals: list[int] = []

        def windowed() -> Iterator[tuple[int, str]]:
            for text in texts:
                totals.append(0)
                for window in windows(text, WINDOW_CHARS) if text else ():
                    yield len(totals) - 1, window

        length_of = self.known.__getitem__
        for number, parts in self.known.over(windowed(), CHUNK_CHARS):
            totals[number] += sum(map(length_of, parts))
        return totals

    def count(self, text: str) -> int:
        """Tokens of one text."""
        return self.count_many([text])[0]


def _counter(path: str) -> _Counter:
    if path not in _counters:
        _counters[path] = _Counter(path)
    return _counters[path]


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document's whole text.

    `tokenizer` is the path of a byte-level BPE file of the tokenizers library that every executor
    has. Counts are the library's, without added special tokens; special strings inside a text
    count as the library takes them by default. The task cuts texts at places where no token can
    cross and encodes the distinct pieces of many texts in batches of equal bytes, so a very long
    text is many small pieces, short texts share a batch, and no encoding is ever held.

    A null text counts as an empty one: 0 bytes, 0 tokens. Every input row gives one row, repeated
    rows and null ids too; other columns are left out, whatever their names.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            counts = counter.count_many(t.as_py() or "" for t in batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("n"))
    counted = map_batches(rows, lengths, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
