"""Best-fit packing of tokenised documents into sequences by bin completion.

Documents become pieces of at most ``size`` tokens; how they fit depends on their lengths
only. One aggregation counts the pieces of each length (at most ``size`` rows, whatever the
corpus), and a branch-and-bound search plans the sequences on these counts: it takes the
largest length left, enumerates the undominated fillings of the space around it, applies
one as often as the counts allow and goes on. The first descent takes the best fit at each
step and is the incumbent; the search backs up to other fillings where the waste so far
still allows fewer sequences, until the bound is met or ``nodes`` steps are spent. Pieces
then find their place by (length, rank within the length): ranks come from counts per
partition, so a length that many rows share is never gathered in one task.

The plan has a size bound that does not depend on the rows: applying a filling leaves some
length with fewer pieces than the filling holds, so a descent has at most the sum over
lengths of 1 + size / length steps (about 18,000 for 2,048).

Defined results: null text is an empty document, which is the end id alone; a document of
more than ``size`` tokens is cut into pieces of ``size`` of which the first may be shorter;
each row is a document, so repeated rows and ids are packed one by one; an empty table
gives no piece. Other columns are left out.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from playtide.llm.common import coded, sliced, stored, summed, taken

ROW = 500  # words that are encoded as one text
ROWS, CHARS = 20_000, 2_500_000  # of an Arrow batch that is worked on at once
BLANK = r"[\p{Z}\s\x0b\x1c-\x1f\x{85}]"  # white space, of Arrow's regular expressions
BREADTH = 12  # fillings kept at a step of the search
LOOKED = 150  # fillings looked at in a step
NODES = 1_000  # steps of the search after the first descent


class Words:
    """Token ids of texts, each different word of a batch encoded once.

    The pattern that splits a text before the merges never joins a character that is not
    white space to a following single space: a text may be cut before such a space. Texts
    that hold the string of an added token go to the library as they are.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        space = self.library.encode(" ", add_special_tokens=False).tokens[0]
        self.led = np.array([(self.library.id_to_token(i) or "").startswith(space) for i in range(self.library.get_vocab_size())])
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.careful = "|".join([r"^\z", rf"\A{BLANK}", rf"{BLANK}\z", rf"{BLANK}{{2}}", *(rf"\Q{c}\E" for c in self.added)])

    def one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by the library, one after the other, and their numbers."""
        found = [array("I", e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that begin with their only space and end with no white space: many make one text.

        Each of them starts with a token that starts with a space, and holds no other.
        """
        ids, sizes = self.one_by_one(["".join(words[k : k + ROW]) for k in range(0, len(words), ROW)])
        starts = np.flatnonzero(self.led[ids])
        found = np.searchsorted(starts, np.append(0, np.cumsum(sizes)))
        if (np.diff(found) == [len(words[k : k + ROW]) for k in range(0, len(words), ROW)]).all():
            return ids, np.diff(np.append(starts, len(ids)))
        return self.one_by_one(words)

    def split(self, text: str) -> list[str]:
        """Words of any text, with the space before them."""
        if not text or any(c in text for c in self.added):
            return [text] if text else []
        first, *rest = re.split(r"(?<=\S) (?=\S)", text)
        return [first, *(" " + w for w in rest)]

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        texts = pc.fill_null(texts, "")
        careful = pc.match_substring_regex(texts, self.careful).to_numpy(zero_copy_only=False)
        plain = pc.split_pattern(texts.filter(pa.array(~careful)), " ")
        odd = pa.array([self.split(t) for t in texts.filter(pa.array(careful)).to_pylist()], pa.list_(pa.string()))
        order = np.argsort(np.append(np.flatnonzero(~careful), np.flatnonzero(careful)), kind="stable")
        counts = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (plain, odd)])
        spaced = np.ones(len(plain.flatten()), bool)  # all words of a plain text but the first follow a space
        spaced[np.cumsum(counts[: len(plain)]) - counts[: len(plain)]] = False
        at, words = coded(plain.flatten().filter(pa.array(spaced)))
        others, rest = coded(pa.concat_arrays([plain.flatten().filter(pa.array(~spaced)), odd.flatten()]))
        index = np.empty(len(spaced) + len(odd.flatten()), np.int64)
        index[: len(spaced)][spaced] = at
        index[np.append(~spaced, np.ones(len(odd.flatten()), bool))] = others + len(words)
        index, counts = taken(index, counts, order)
        values, sizes = zip(self.together([" " + w for w in words]), self.one_by_one(rest))
        ids, sizes = taken(np.concatenate(values), np.concatenate(sizes), index)
        return ids, summed(sizes, counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each text."""
        ids, sizes = self.numbered(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes).tolist()
        return [ids[b - n : b].tobytes() for b, n in zip(ends, sizes.tolist())]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Words:
    """The tokenizer of a file, read once per Python worker; its threads would only take the cores of other tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)


def pieces(docs: DataFrame, path: str, size: int = 2048, end: int = 0, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, with its ``ids`` if wanted."""
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType)]
    fields += [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []
    last = array("I", [end]).tobytes()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in sliced(batches, ROWS, CHARS, "text"):
            owner, piece, start, length, crc, own = [], [], [], [], [], []
            tokens, sizes = words.numbered(batch.column(1))
            for row, (stop, number) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist())):
                packed = tokens[stop - number : stop].tobytes() + last
                total = len(packed) // 4
                first = total % size or size  # only a first piece is shorter
                cuts = [0, *range(min(first, total), total + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(packed[4 * a : 4 * b]))
                    if ids:
                        own.append(np.frombuffer(packed[4 * a : 4 * b], np.int32))
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(own, pa.list_(pa.int32()))] if ids else []
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(task, T.StructType(fields))


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Sequences that any packing needs: pieces of over half a sequence, and what cannot fit around them."""
    lengths = np.arange(len(counts))
    best = math.ceil(int((counts * lengths).sum()) / size)
    for k in range(size // 2 + 1):
        alone = counts[size - k + 1 :].sum()
        halves = slice(size // 2 + 1, size - k + 1)
        free = counts[halves].sum() * size - (counts[halves] * lengths[halves]).sum()
        small = (counts[k : size // 2 + 1] * lengths[k : size // 2 + 1]).sum()
        best = max(best, int(alone + counts[halves].sum()) + max(0, math.ceil(int(small - free) / size)))
    return int(best)


def _fits(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the pieces of ``small`` can stand inside those of ``large`` (both descending)."""
    free = list(large)
    for s in small:
        where = next((i for i, f in enumerate(free) if f >= s), None)
        if where is None:
            return False
        free[where] -= s
    return True


def fillings(space: int, counts: np.ndarray, most: int, enough: int = BREADTH) -> list[tuple[int, ...]]:
    """Undominated fillings of ``space``, fullest first: tuples of lengths, descending.

    One filling dominates another if the pieces of the other fit inside its own pieces, so
    a single length that fills the space exactly is the only one to look at. The search
    ends when ``enough`` fillings leave no waste.
    """
    if space <= 0:
        return [()]
    if space < len(counts) and counts[space] > 0:
        return [(space,)]
    there = np.flatnonzero(counts[: min(space, most) + 1] > 0)
    if not len(there):
        return [()]
    sizes = there[::-1].tolist()
    found: set[tuple[int, ...]] = set()
    left = {s: int(counts[s]) for s in sizes}
    smallest, looked, perfect = sizes[-1], 0, 0
    room, greedy = space, ()  # always the largest that fits: there however deep the search gets
    for s in sizes:
        use = min(left[s], room // s)
        room, greedy = room - use * s, greedy + (s,) * use
    found.add(greedy)
    perfect += room == 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(space, 0, ())]
    while stack and looked < LOOKED and perfect < enough:
        room, at, chosen = stack.pop()
        looked += 1
        if room < smallest or at >= len(sizes):
            found.add(chosen)
            perfect += room == 0
            continue
        while at < len(sizes) and (sizes[at] > room or chosen.count(sizes[at]) >= left[sizes[at]]):
            at += 1
        if at >= len(sizes):
            found.add(chosen)
            continue
        if left.get(room, 0) > chosen.count(room) and room <= sizes[at]:
            found.add((*chosen, room))
            perfect += 1
            continue
        rest = room - sizes[at]
        if rest and chosen:  # deeper down only the largest that fits and a pair that fits exactly
            pair = next((s for s in sizes[at : at + 64] if room - s <= s and left[s] > chosen.count(s) and left.get(room - s, 0) > (room - s == s) + chosen.count(room - s)), None)
            if pair is not None:
                found.add((*chosen, pair, room - pair))
                perfect += 1
                continue
        elif at + 1 < len(sizes):
            stack.append((room, at + 1, chosen))
        stack.append((rest, at, (*chosen, sizes[at])))
    ranked = sorted(found, key=lambda f: (-sum(f), len(f), f))[: 4 * BREADTH]
    kept: list[tuple[int, ...]] = []
    for f in ranked:
        if not any(_fits(f, k) for k in kept):
            kept.append(f)
    return kept[:BREADTH]


def plan(lengths: dict[int, int], size: int, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Fillings (lengths, largest first) and how many sequences have each."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in lengths.items():
        counts[length] = n
    total, bound = int((counts * np.arange(size + 1)).sum()), lower_bound(counts, size)
    best: list[tuple[tuple[int, ...], int]] = []
    least, waste, largest, spent = math.inf, 0, size, 0
    steps: list[tuple[int, list[tuple[int, ...]], int, int]] = []  # largest, fillings, next one, times

    def applied(large: int, filling: tuple[int, ...], sign: int, times: int) -> None:
        for s in (large, *filling):
            counts[s] += sign * times

    while True:
        while largest and not counts[largest]:
            largest -= 1
        if not largest:
            used = sum(t for *_, t in steps)
            if used < least:
                least, best = used, [((large, *options[i - 1]), t) for large, options, i, t in steps]
        allowed = (least - 1) * size - total
        if largest and waste <= allowed:
            counts[largest] -= 1
            options = fillings(size - largest, counts, largest, BREADTH if best else 1)
            counts[largest] += 1
            steps.append((largest, options, 0, 0))
        if least <= bound or spent >= nodes and best:
            return best
        while steps:  # the next filling of the last step that has one
            large, options, i, times = steps.pop()
            if i:
                applied(large, options[i - 1], 1, times)
                waste -= times * (size - large - sum(options[i - 1]))
            if i < len(options) and (waste + size - large - sum(options[i]) <= allowed or least == math.inf):
                chosen = (large, *options[i])
                times = min(int(counts[s]) // chosen.count(s) for s in set(chosen))
                applied(large, options[i], -1, times)
                waste += times * (size - sum(chosen))
                steps.append((large, options, i + 1, times))
                largest = large
                spent += bool(best)
                break
        else:
            return best


def packed(found: DataFrame, size: int = 2048, nodes: int = NODES) -> DataFrame:
    """Pieces (with a column ``length``) with the sequence and the offset of each."""
    spark = found.sparkSession
    rows = stored(found.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    per_part = rows.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    per_part = stored(per_part)
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``size`` rows
    base, taken, table = 0, dict.fromkeys(histogram, 0), []
    for filling, times in plan(histogram, size, nodes) if histogram else []:
        offset = 0
        for length in dict.fromkeys(filling):
            use = filling.count(length)
            table.append((length, taken[length], times, base, offset))
            taken[length] += use * times
            offset += use * length
        base += times
    places = np.array(sorted(table), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(places)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_part", "length").orderBy("_row")
    ranked = rows.withColumn("_in", F.row_number().over(inside) - 1).join(starts, ["_part", "length"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_in")).select(*found.columns, "_rank")
    schema = T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    step = 1 << 44  # over any rank

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = shared.value
        keys = plans[:, 0] * step + plans[:, 1]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            at = np.searchsorted(keys, length * step + rank, side="right") - 1
            _, first, times, sequence, offset = plans[at].T
            item = rank - first
            columns = [*batch.columns[:-1], pa.array(sequence + item % times), pa.array(offset + item // times * length)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(task, schema)


def pack(docs: DataFrame, path: str, size: int = 2048, end: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return packed(pieces(docs, path, size, end, text, doc_id), size)
