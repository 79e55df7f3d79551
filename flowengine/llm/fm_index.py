"""An FM-index over the words of a shard of documents, all steps vectorised over many patterns."""

from __future__ import annotations

import numpy as np
import xxhash

#: Symbols in one index, words and a separator for each document.
SHARD_SYMBOLS = 1 << 20
#: Every so many positions of a text are stored; the others are found by steps back to one.
SAMPLE = 8

_BITS = 20
_MASK = np.uint64((1 << _BITS) - 1)
# words are hashed by powers of an odd number modulo 2^64, so that one running sum serves all
_BASE = 0x9E3779B97F4A7C15
_CHUNK, _LONG = 1 << 20, 1 << 12
_ONE = np.uint64(1)


def _powers(base: int) -> np.ndarray:
    steps = np.full(_CHUNK + _LONG, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_tables: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _tables:
        _tables.extend([_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))])
    return _tables


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after the other."""
    total = int(lengths.sum())
    jumps = np.cumsum(lengths) - lengths
    return np.repeat(starts - jumps, lengths) + np.arange(total, dtype=np.int64)


def hashes(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word text[start:stop]; the bytes are not zero, the starts ascend and
    words do not overlap. Bytes between words have to be zero."""
    powers, inverses = _power_tables()
    out = np.zeros(len(starts), dtype=np.uint64)
    long = stops - starts > _LONG
    edges = np.searchsorted(starts, np.arange(0, len(text) + _CHUNK, _CHUNK))
    for chunk, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if low == high:
            continue
        base = chunk * _CHUNK
        part = text[base:base + _CHUNK + _LONG]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers[:len(part)], out=sums[1:])
        first = starts[low:high] - base
        last = np.minimum(stops[low:high] - base, len(part))
        out[low:high] = (sums[last] - sums[first]) * inverses[first]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    for k in np.flatnonzero(long):
        out[k] = xxhash.xxh64_intdigest(text[starts[k]:stops[k]].tobytes())
    return out


def _same(a, a_starts, b, b_starts, lengths) -> np.ndarray:
    """For each pair of places whether so many bytes there are equal."""
    equal = a[ranges(a_starts, lengths)] == b[ranges(b_starts, lengths)]
    wrong = np.zeros(len(lengths), dtype=bool)
    if not equal.all():
        owner = np.repeat(np.arange(len(lengths)), lengths)
        wrong[owner[~equal]] = True
    return ~wrong


class Vocabulary:
    """The distinct words of a shard, numbered from 1. Words with equal hashes are told apart by
    their bytes, so equal numbers mean equal words."""

    def __init__(self, text, starts, stops, hashed):
        n = len(starts)
        keys = np.sort(hashed & ~_MASK | np.arange(n, dtype=np.uint64))
        places = (keys & _MASK).astype(np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = keys[1:] >> np.uint64(_BITS) != keys[:-1] >> np.uint64(_BITS)
        groups = np.cumsum(new)
        self.ids = np.empty(n, dtype=np.int64)
        self.ids[places] = groups
        self.first = places[new]
        self.text, self.starts, self.lengths = text, starts, stops - starts
        self.keys = hashed[self.first] >> np.uint64(_BITS)
        of = self.first[self.ids - 1]
        alike = self.lengths == self.lengths[of]
        self.exact = bool(alike.all()) and bool(
            _same(text, starts, text, starts[of], self.lengths).all()
        )
        if not self.exact:
            self._by_bytes()

    def _by_bytes(self) -> None:
        self.known: dict[bytes, int] = {}
        for k, (start, length) in enumerate(zip(self.starts, self.lengths, strict=True)):
            word = self.text[start:start + length].tobytes()
            self.ids[k] = self.known.setdefault(word, len(self.known) + 1)

    @property
    def size(self) -> int:
        return len(self.first) if self.exact else len(self.known)

    def find(self, text, starts, stops, hashed) -> np.ndarray:
        """The numbers of other words, 0 for those that are not in the shard."""
        if not self.exact:
            words = (text[a:b].tobytes() for a, b in zip(starts, stops, strict=True))
            return np.array([self.known.get(w, 0) for w in words], dtype=np.int64)
        at = np.searchsorted(self.keys, hashed >> np.uint64(_BITS))
        at = np.minimum(at, len(self.keys) - 1)
        word = self.first[at]
        found = (self.keys[at] == hashed >> np.uint64(_BITS)) & (
            self.lengths[word] == stops - starts
        )
        k = np.flatnonzero(found)
        found[k] = _same(
            text, starts[k], self.text, self.starts[word[k]], self.lengths[word[k]]
        )
        return np.where(found, at + 1, 0)


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a text of fewer than 2^20 symbols, each below 2^20. Its last
    symbol occurs once. By doubling: suffixes are sorted by twice as many symbols each time, and
    those that are alone already are left out."""
    n = len(ranks)
    rank = ranks.astype(np.uint64)
    place = np.arange(n, dtype=np.uint64)
    order = np.empty(n, dtype=np.int64)
    slots, positions, ahead = np.arange(n), place, 1
    while len(slots):
        behind = np.minimum(positions.astype(np.int64) + ahead, n - 1)
        keys = rank[positions.astype(np.int64)] << np.uint64(2 * _BITS)
        keys |= rank[behind] << np.uint64(_BITS)
        keys |= positions
        keys.sort()
        found = (keys & _MASK).astype(np.int64)
        order[slots] = found
        head = np.ones(len(keys) + 1, dtype=bool)
        head[1:-1] = keys[1:] >> np.uint64(_BITS) != keys[:-1] >> np.uint64(_BITS)
        rank[found] = np.maximum.accumulate(np.where(head[:-1], slots, 0)).astype(np.uint64)
        still = ~(head[:-1] & head[1:])
        slots, positions, ahead = slots[still], found[still].astype(np.uint64), ahead * 2
    return order


class _Bits:
    """A bit vector that counts its ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.cumsum(counts, dtype=np.int64) - counts
        self.zeros = int(len(bits) - self.before[-1] - counts[-1])

    def ones(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        below = (_ONE << (places & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64) & _ONE).astype(bool)


class Index:
    """The index of a text of word numbers; 0 separates documents and ends the text."""

    def __init__(self, symbols: np.ndarray, distinct: int):
        n = len(symbols)
        separators = symbols == 0
        documents = int(separators.sum())
        # for sorting, separators differ, so that no comparison runs on into the next document
        ranks = np.where(separators, np.cumsum(separators) - 1, symbols + documents - 1)
        order = suffix_array(ranks)
        before = symbols[order - 1]
        counts = np.bincount(symbols, minlength=distinct + 1)
        self.first = np.cumsum(counts) - counts
        self.counts = counts
        self._wavelets(before, distinct, counts)
        # a row is stored if the walk back could not go on or has gone far enough
        stored = (order % SAMPLE == 0) | (before == 0)
        self.stored, self.samples = _Bits(stored), order[stored].astype(np.int32)
        self.size = n

    def _wavelets(self, before: np.ndarray, distinct: int, counts: np.ndarray) -> None:
        """The wavelet matrix of the symbols before the sorted suffixes, highest bit first."""
        self.levels: list[tuple[int, _Bits]] = []
        row = before.astype(np.int32)
        for shift in reversed(range(max(1, int(distinct).bit_length()))):
            bit = (row >> shift & 1).astype(bool)
            self.levels.append((shift, _Bits(bit)))
            row = np.concatenate([row[~bit], row[bit]])
        # where the matrix has come to hold each symbol
        begins = np.zeros(distinct + 1, dtype=np.int64)
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        begins[row[heads]] = heads
        self.shift = self.first - begins

    def _follow(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each place the row at which suffixes with the symbol before them go on."""
        for shift, bits in self.levels:
            ones = bits.ones(places)
            one = (symbols >> shift & 1).astype(bool)
            places = np.where(one, bits.zeros + ones, places - ones)
        return self.shift[symbols] + places

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one symbol earlier."""
        symbols, places = np.zeros(len(rows), dtype=np.int64), rows
        for shift, bits in self.levels:
            one, ones = bits.get(places), bits.ones(places)
            symbols |= one.astype(np.int64) << shift
            places = np.where(one, bits.zeros + ones, places - ones)
        return self.shift[symbols] + places

    def search(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(pattern, low, high): the rows of the suffixes that begin with each pattern that occurs.
        Pattern k is ids[starts[k]:starts[k] + lengths[k]], none of which is 0."""
        last = ids[starts + lengths - 1]
        low = self.first[last]
        high = low + self.counts[last]
        alive, step = np.flatnonzero(high > low), 1
        ended = []
        while len(alive):
            more = lengths[alive] > step
            ended.append(alive[~more])
            alive = alive[more]
            symbol = ids[starts[alive] + lengths[alive] - 1 - step]
            low[alive], high[alive] = (
                self._follow(symbol, low[alive]), self._follow(symbol, high[alive])
            )
            alive = alive[high[alive] > low[alive]]
            step += 1
        found = np.sort(np.concatenate(ended)) if ended else alive
        return found, low[found], high[found]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position in the text of each row's suffix."""
        positions = np.empty(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            there = self.stored.get(at)
            positions[open_[there]] = self.samples[self.stored.ones(at[there])] + steps
            open_, at = open_[~there], at[~there]
            at = self._back(at) if len(at) else at
            steps += 1
        return positions
