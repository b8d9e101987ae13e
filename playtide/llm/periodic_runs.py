"""Periodic runs of words, found on a harmonic grid and extended by a recompression grammar.

A run is a stretch of words with smallest period q and a length of at least ``LEAST`` and
``TIMES * q`` that no neighbouring word extends. For each period p the words i and i + p
are compared on a grid whose step is the least length of the stretch where they agree, so
every run meets the grid of its period: about n log n points for n words. A point counts
only if eight words on one side of it agree as well, which every run has.

How far the agreement reaches from a point is the longest common extension of i and i + p
to both sides. It comes from a grammar made by recompression: block compression replaces
maximal powers of one symbol, pair compression every pair of a left and a right symbol of
a split alphabet, in turn, each a level of shorter strings. Equal stretches are compressed
alike but for their borders, so an extension climbs the levels, passing at most one
rest of a pair or of a block at each, until the symbols differ, and comes down to the
first different word. All extensions of a batch of documents take each step together;
levels are made while one of them still climbs. Nothing depends on hashes of words: word
numbers come from a dictionary, symbol numbers from the sorted pairs.

A period and its multiples give the same stretch; the smallest stays.

Defined results: null, empty and short texts have no run; equal words are equal UTF-8 bytes;
each row is a document of its own, so repeated rows and ids give repeated results; other
columns are left out and their names do not matter; an empty table gives no row. A document
of any length is one piece of work of about 50 bytes a word with candidates (grid points are
looked at in blocks).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.llm.common import sliced

LEAST, TIMES = 24, 3  # words, and periods, of the shortest run
SIDE = 8  # words next to a grid point on one side that agree in every run
ROWS, CHARS = 2_000, 2_000_000  # of the documents that are worked on at once
POINTS = 1 << 20  # grid points looked at in a block
HELD = 1 << 14  # words up to which the grid of a size is remembered

Change = Callable[[int | None, list[bytes]], list[bytes]]


def _grid(words: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and period of the grid points with periods from ``first`` to ``last``."""
    periods = np.arange(first, last + 1)
    steps = np.maximum((TIMES - 1) * periods, LEAST - periods)
    counts = (words - periods - 1) // steps + 1
    period = np.repeat(periods, counts)
    number = np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)
    return number * np.repeat(steps, counts), period


@lru_cache(maxsize=16)
def _remembered(words: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole grid for ``words`` words by the second word that a point compares."""
    place, period = _grid(words, 1, words // TIMES)
    order = np.argsort(place + period, kind="stable")
    return place[order], period[order]


def _grids(words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All grid points of a document, in blocks."""
    if words <= HELD:
        size = 1 << max(5, (words - 1).bit_length())
        place, period = _remembered(size)
        end = _ends(size).searchsorted(words)
        yield place[:end], period[:end]
        return
    first = 1
    while first <= words // TIMES:
        step = max((TIMES - 1) * first, LEAST - first, 1)
        last = min(words // TIMES, first + max(1, POINTS * step // words))
        yield _grid(words, first, last)
        first = last + 1


@lru_cache(maxsize=16)
def _ends(words: int) -> np.ndarray:
    place, period = _remembered(words)
    return place + period


def _candidates(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of the grid points of one document around which words agree."""
    n, places, periods = len(x), [], []
    for place, period in _grids(n) if n >= LEAST else ():
        agree = x[place] == x[place + period]
        place, period = place[agree], period[agree]
        sides = []
        for sign in (1, -1):
            at, apart, rows = place, period, np.arange(len(place))
            for k in range(1, SIDE):
                inside = (at + sign * k >= 0) & (at + sign * k + apart < n)
                at, apart, rows = at[inside], apart[inside], rows[inside]
                same = x[at + sign * k] == x[at + sign * k + apart]
                at, apart, rows = at[same], apart[same], rows[same]
                if not len(rows):
                    break
            sides.append(rows)
        rows = np.union1d(*sides)
        places.append(place[rows])
        periods.append(period[rows])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


class Level:
    """A string of the grammar and how the next, shorter one covers it.

    ``first`` marks the symbols that start one of the next level, ``up`` is the number of the
    symbol there and ``down`` the first symbol here of each one there. ``block`` tells which
    compression made the next level.
    """

    def __init__(self, symbols: np.ndarray, first: np.ndarray, block: bool):
        self.symbols, self.first, self.block = symbols, first, block
        self.up = (np.cumsum(first) - 1).astype(np.int32)
        self.down = np.append(np.flatnonzero(first), len(symbols)).astype(np.int32)

    def turned(self) -> Level:
        """The same level read from right to left."""
        return Level(self.symbols[::-1], np.append(self.first[1:], True)[::-1], self.block)

    def rest(self, at: np.ndarray) -> np.ndarray:
        """Symbols from a place to the end of its block."""
        return self.down[self.up[at] + 1] - at

    def step(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that two places with equal symbols pass together on this level."""
        return np.minimum(self.rest(a), self.rest(b)) if self.block else np.ones(len(a), np.int64)


def _numbered(keys: np.ndarray, base: int) -> tuple[np.ndarray, int]:
    """Symbol numbers of keys, after ``base`` others."""
    values, number = np.unique(keys, return_inverse=True)
    return base + number, base + len(values)


def compressed(symbols: np.ndarray, count: int, block: bool, turn: int) -> tuple[Level, np.ndarray, int]:
    """The level of a string, and the next string with its number of symbols."""
    if block:
        first = np.append(True, symbols[1:] != symbols[:-1])
        starts = np.flatnonzero(first)
        size = np.diff(np.append(starts, len(symbols)))
        after = symbols[starts].astype(np.int64)
        more = size > 1
        after[more], count = _numbered(after[more] * (len(symbols) + 1) + size[more], count)
    else:
        mixed = (symbols.astype(np.uint64) + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
        right = (mixed >> np.uint64(40)) & np.uint64(1) == 1
        pair = ~right[:-1] & right[1:]
        other = right[:-1] & ~right[1:]
        if other.sum() > pair.sum():
            pair = other
        first = np.append(True, ~pair)
        starts = np.flatnonzero(first)
        after = symbols[starts].astype(np.int64)
        lead = np.append(pair, False)[starts]
        joined = symbols[starts[lead]].astype(np.int64) * count + symbols[starts[lead] + 1]
        after[lead], count = _numbered(joined, count)
    return Level(symbols, first, block), after, count


def extensions(symbols: np.ndarray, count: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols in which the string agrees from ``a`` and ``b`` on to the right, and before them to the left.

    Two different symbols that occur once stand at the ends of the string.
    """
    size = len(symbols)
    climbs = [_Climb(a, b), _Climb(size - a, size - b)]  # to the left: from the word before
    turn = 0
    while any(len(c.rows) for c in climbs):
        level, symbols, count = compressed(symbols, count, turn % 2 == 0, turn)
        for climb, own in zip(climbs, (level, level.turned())):
            climb.climb(own)
        if len(symbols) == 1 and any(len(c.rows) for c in climbs):
            raise AssertionError("two places of a string are one symbol")
        turn += 1
    return climbs[0].found(), climbs[1].found()


class _Climb:
    """Pairs of places that climb the levels as long as their symbols are equal."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.start = a
        self.rows, self.a, self.b = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        self.levels: list[Level] = []
        self.apart: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per level

    def climb(self, level: Level) -> None:
        rows, a, b = self.rows, self.a, self.b
        same = level.symbols[a] == level.symbols[b]
        left = [(rows[~same], a[~same], b[~same])]
        rows, a, b = rows[same], a[same], b[same]
        inside = ~(level.first[a] & level.first[b])
        step = level.step(a[inside], b[inside])
        a[inside] += step
        b[inside] += step
        here = level.first[a] & level.first[b]
        left.append((rows[~here], a[~here], b[~here]))  # one block is longer: the next symbols differ
        self.rows, self.a, self.b = rows[here], level.up[a[here]].astype(np.int64), level.up[b[here]].astype(np.int64)
        self.levels.append(level)
        self.apart.append(tuple(np.concatenate(part) for part in zip(*left)))

    def found(self) -> np.ndarray:
        """Down to the first different symbols: the length of each agreement."""
        rows, a, b = (np.zeros(0, np.int64) for _ in range(3))
        for level, here in zip(self.levels[::-1], self.apart[::-1]):
            a, b = level.down[a].astype(np.int64), level.down[b].astype(np.int64)
            same = level.symbols[a] == level.symbols[b]
            step = level.step(a[same], b[same])
            a[same] += step
            b[same] += step
            rows, a, b = (np.concatenate(part) for part in zip((rows, a, b), here))
        out = np.zeros(len(self.start), np.int64)
        out[rows] = a - self.start[rows]
        return out


def runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, given as word numbers, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    owner, place, period, parts, at = [], [], [], [], 1
    for number, words in enumerate(documents):
        i, p = _candidates(words)
        if len(i):
            owner.append(np.full(len(i), number))
            place.append(i + at)
            period.append(p)
            parts.append((number, at, words))
            at += len(words)
    if not parts:
        return out
    whole = np.empty(at + 1, np.int64)
    whole[0], whole[-1] = -1, -2
    for number, start, words in parts:
        whole[start : start + len(words)] = words + (number << 32)  # no agreement crosses documents
    whole, count = _numbered(whole, 0)
    owner, place, period = np.concatenate(owner), np.concatenate(place), np.concatenate(period)
    right, left = extensions(whole, count, place, place + period)
    size = period + right + left
    enough = size >= np.maximum(LEAST, TIMES * period)
    begin = {number: start for number, start, _ in parts}
    found: dict[tuple[int, int, int], int] = {}
    for number, start, length, p in zip(*(v[enough].tolist() for v in (owner, place - left, size, period))):
        key = (number, start - begin[number], length)
        found[key] = min(p, found.get(key, p))
    for (number, start, length), p in sorted(found.items(), key=lambda f: (f[0][0], f[0][1], f[1])):
        out[number].append((start, length, p))
    return out


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period, then of the smallest start, then of the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not found:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _worked(batches: Iterable[pa.RecordBatch], change: Change | None) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]], list[list[tuple[int, int, int]]]]]:
    """Batches of (id, text) with the words and the runs of each row."""
    for batch in sliced(batches, ROWS, CHARS, "text"):
        words = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        if change:
            words = [change(i, w) for i, w in zip(batch.column(0).to_pylist(), words)]
        number: dict[bytes, int] = {}
        for word in set().union(*words):
            number[word] = len(number)
        coded = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
        yield batch, words, runs(coded)


def _columns(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", change: Change | None = None) -> DataFrame:
    """doc_id, start, length and period of every run; ``change`` rewrites the words of a document first."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found in _worked(batches, change):
            rows = [k for k, f in enumerate(found) for _ in f]
            flat = [r for f in found for r in f]
            columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=["doc_id", "start", "length", "period"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return _columns(docs, text, doc_id).mapInArrow(task, f"doc_id {kind}, start long, length long, period long")


def without_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", change: Change | None = None) -> DataFrame:
    """doc_id and the words of every text, joined by one space, with each run cut to its first period."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, found in _worked(batches, change):
            texts = [b" ".join(collapsed(w, f)).decode() for w, f in zip(words, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return _columns(docs, text, doc_id).mapInArrow(task, f"doc_id {kind}, text string")


def tiled(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document of every tenth hash, made periodic from a place on; others unchanged."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def digests(documents: DataFrame, change: Change | None = tiled) -> DataFrame:
    """Count, best run and digests of every document."""
    names = ("n_runs", "start", "length", "period", "exponent_milli")
    fields = [T.StructField("doc_id", documents.schema["doc_id"].dataType)]
    fields += [T.StructField(n, T.LongType()) for n in names]
    fields += [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, found in _worked(batches, change):
            tops = [best(f) for f in found]
            columns = [pa.array([len(f) for f in found], pa.int64())]
            columns += [pa.array([t and t[k] for t in tops], pa.int64()) for k in range(3)]
            columns.append(pa.array([t and 1000 * t[1] // t[2] for t in tops], pa.int64()))
            listed = ["".join(f"{s},{n},{p}\n" for s, n, p in f).encode() for f in found]
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in listed], pa.string()))
            kept = (b" ".join(collapsed(w, f)) for w, f in zip(words, found))
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[f.name for f in fields])

    return _columns(documents, "text", "doc_id").mapInArrow(task, T.StructType(fields))
