"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches

#: N-grams in a profile, of a language or of a document.
PROFILE = 300
#: Languages that one model may have; a label column with more holds something else.
MAX_LANGUAGES = 5_000
#: Verdict on texts without a letter.
UNDETERMINED = "und"
#: Characters of a text whose n-grams are counted at a time.
WINDOW_CHARS = 1 << 20
#: (n-gram, count) pairs that a task adds up before it hands them on.
PENDING = 1 << 18
_BITS = 21

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """By code point: is it a letter?"""
    if not _tables:
        _tables.append(np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)]))
    return _tables[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's 1- to 3-grams as numbers, ascending, and their counts.

    Letters are lower-cased; each run of anything else is one blank, as are both ends. An n-gram
    lies within one word and its blanks. The whole text counts, a stretch at a time.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    line = np.where(is_letter, points, 32)[kept].astype(np.int64)
    line = np.pad(line, (int(line[0] != 32), int(line[-1] != 32)), constant_values=32)
    parts = [_counted(_codes(line, at)) for at in range(0, len(line), WINDOW_CHARS)]
    return parts[0] if len(parts) == 1 else _added(parts)


def _codes(line: np.ndarray, start: int) -> np.ndarray:
    """Numbers of the n-grams that start in one stretch of the line."""
    end = min(start + WINDOW_CHARS, len(line))
    one = line[start:end]
    two = line[start:end + 1]
    three = line[start:end + 2]
    second, third = three[1:-1], three[2:]
    return np.concatenate((
        one[one != 32],
        two[:-1] << _BITS | two[1:],
        (three[:-2] << 2 * _BITS | second << _BITS | third)[second != 32],
    ))


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes.sort()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that a model never learns from; null ids count as one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(documents: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """The profile of each language: its `profile` most frequent n-grams, most frequent first,
    ties to the smaller number.

    `documents` has text and lang; rows with a null in either teach nothing. N-grams of all texts
    are counted: each task adds up its own, Spark adds those up and ranks them. What reaches the
    driver is `profile` numbers a language, and the number of languages is checked.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[str, list] = {}
        size = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, parts in pending.items():
                codes, counts = _added(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)],
                    ["lang", "gram", "n"],
                )

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                codes, counts = ngrams(text.as_py())
                if len(codes):
                    pending.setdefault(lang.as_py(), []).append((codes, counts))
                    size += len(codes)
                if size >= PENDING:
                    pending = {k: [_added(v)] for k, v in pending.items()}
                    size = sum(len(v[0][0]) for v in pending.values())
                    if size >= PENDING // 2:
                        yield from handed_on()
                        pending, size = {}, 0
        yield from handed_on()

    rows = documents.select("lang", "text").dropna()
    counts = (
        map_batches(rows, count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    # one language more than allowed is enough to see that there are too many
    found = ranked.select("lang", "gram", "rank").limit((MAX_LANGUAGES + 1) * profile).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(found, key=lambda r: (r.lang, r.rank)):
        profiles.setdefault(row.lang, []).append(row.gram)
    if len(profiles) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    return profiles


class _Ranks:
    """All profiles in one table: for each known n-gram its rank in each language, and the
    profile length where a language lacks it."""

    def __init__(self, profiles: dict[str, list[int]], profile: int):
        self.langs, self.absent = sorted(profiles), profile
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), profile, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            rows = np.searchsorted(self.grams, np.array(profiles[lang], dtype=np.int64))
            self.ranks[rows, k] = np.arange(len(rows))

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language at the smallest out-of-place distance, ties to the smaller name, and how
        far that distance is below the largest possible one, from 0 to 1."""
        grams, counts = ngrams(text) if text else ((), ())
        if not len(grams) or not self.langs:
            return UNDETERMINED, 0.0
        own = grams[np.argsort(-counts, kind="stable")[:self.absent]]
        at = np.searchsorted(self.grams, own)
        known = self.grams[np.minimum(at, len(self.grams) - 1)] == own
        ranks = self.ranks[np.where(known, at, len(self.grams))]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks == self.absent, self.absent, apart).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.absent * len(own))


def predict(
    documents: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE
) -> DataFrame:
    """(doc_id, text, lang, source, n_chars, lang_pred, score) of every document.

    Only the text decides. A null text, or one without a letter, is `und` with score 0, as is any
    text if no language was learned. Every input row gives one row, repeated rows and null ids
    too; columns other than those of documents are left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _Ranks(profiles, profile)
        for batch in batches:
            judged = [model.judge(text.as_py()) for text in batch.column(1)]
            langs, scores = zip(*judged, strict=True) if judged else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = documents.select(*_cast(columns))
    return map_batches(rows, run, f"{columns}, lang_pred string, score double")


def _cast(columns: str) -> list[Column]:
    pairs = (c.split() for c in columns.split(", "))
    return [F.col(name).cast(kind).alias(name) for name, kind in pairs]
