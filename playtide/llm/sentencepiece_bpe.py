"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is split into symbols (its characters, each space written as U+2581 and one put in
front). An agenda holds the adjacent pairs whose joined text is a piece, best score first
and leftmost among equals; the top pair is merged and its new neighbours join the agenda.
What stays outside the vocabulary becomes byte pieces. The vocabulary shows which merges
can happen: if no piece has U+2581 after another character, no merge crosses the start of
a run of spaces, so the runs of spaces with the word that follows are encoded one by one,
each different one once in a batch of at most ``CHARS`` bytes of text; nothing is kept
between batches. Every encoding of a word and every decoded text is compared with the
sentencepiece library, one call per batch; a difference raises.

Null or empty text gives no ids; ids that are null decode to an empty text. Other columns
are kept; a column named like the output is replaced. Rows are independent, so ties,
repeated rows and empty tables need no rule, and a text of any length is one agenda per
word (or one in whole where the vocabulary has pieces across spaces).
"""

from __future__ import annotations

import codecs
import re
from array import array
from bisect import bisect
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.llm.common import coded, sliced, summed, taken

SPACE = "▁"
CUT = "\ue000"  # between words that are cut into runs together
PARTS = re.compile(f"{CUT}|[^\n.,{CUT}]+|[.,]+|\n+")
SHORT = 48  # characters of a word below which its agenda is a row of a matrix
TOGETHER = 8_192  # rows of such a matrix
NEVER = np.int32(2**31 - 1)  # no merge
ROWS, CHARS = 20_000, 4_000_000  # of an Arrow batch that is worked on at once
DECODED = 400  # rows that are decoded at once

codecs.register_error("byte_by_byte", lambda e: ("�", e.start + 1))


class Vocabulary:
    """Pieces and scores of a model file, and the encoder made from them."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        names = [library.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        self.library = library
        self.ids = {names[i]: i for i in plain}
        self.rank = {names[i]: -library.get_score(i) for i in plain}
        self.bytes = {int(names[i][3:5], 16): i for i in ids if library.is_byte(i)}
        self.unknown = library.unk_id()
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)  # pieces across words
        self.led = {i for i in plain if names[i].startswith(SPACE)}
        self.surface = [b"" if library.is_control(i) else names[i].replace(SPACE, " ").encode() for i in ids]
        self.surface[self.unknown] = " ⁇ ".encode()
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self._pairs()
        self.touching = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}

    def merged(self, text: str) -> list[str]:
        """Symbols left when the agenda of adjacent pairs is empty."""
        symbols: list[str | None] = list(text)
        size, rank = len(symbols), self.rank
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        agenda = [(rank[pair], i, pair) for i, pair in enumerate(map("".join, zip(text, text[1:]))) if pair in rank]
        heapify(agenda)
        while agenda:
            _, left, pair = heappop(agenda)
            right = after[left]
            if symbols[left] is None or right >= size or symbols[left] + symbols[right] != pair:
                continue  # one side was merged elsewhere
            symbols[left], symbols[right] = pair, None
            after[left] = follower = after[right]
            if follower < size:
                before[follower] = left
                if (joined := pair + symbols[follower]) in rank:
                    heappush(agenda, (rank[joined], left, joined))
            if (leader := before[left]) >= 0 and (joined := symbols[leader] + pair) in rank:
                heappush(agenda, (rank[joined], leader, joined))
        return [s for s in symbols if s is not None]

    def numbers(self, text: str) -> list[int]:
        """Ids of an escaped text of any length and any characters."""
        out: list[int] = []
        for symbol in self.merged(text):
            if symbol in self.ids:
                out.append(self.ids[symbol])
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _pairs(self) -> None:
        """Tables of the merges by symbol number, for many short words at once."""
        loose = {c for p in self.ids for c in p}.difference(self.ids)  # characters only within pieces
        number = self.ids | {c: len(self.surface) + i for i, c in enumerate(sorted(loose))}
        self.base = len(self.surface) + len(loose)
        self.symbol = np.full(0x110000, -1, np.int64)
        for piece, i in number.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        order = {s: i for i, s in enumerate(sorted(set(self.rank.values())))}
        found = {
            number[p[:k]] * self.base + number[p[k:]]: (i, order[self.rank[p]])
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        }
        self.pair_key = np.array(sorted(found), np.int64)
        self.pair_to = np.array([found[k][0] for k in self.pair_key.tolist()], np.int64)
        self.pair_rank = np.array([found[k][1] for k in self.pair_key.tolist()], np.int32)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the agenda and symbol of the merge of each pair of symbols."""
        key = np.where((left >= 0) & (right >= 0), left * self.base + right, -1)
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        found = self.pair_key[at] == key
        return np.where(found, self.pair_rank[at], NEVER), np.where(found, self.pair_to[at], -1)

    def many(self, words: list[str]) -> list[bytes]:
        """Packed ids of escaped words of about one length: each row of a matrix is an agenda.

        A row's cell holds the place in the score order of the pair that starts there; the
        least cell of the row, the first among equals, is merged in every row per step.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        rows, width = len(words), int(sizes.max()) + 1
        symbols = np.full((rows, width), -1, np.int64)
        symbols[np.arange(width) < sizes[:, None]] = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        strange = (symbols < 0).sum(axis=1) > width - sizes
        alive = np.arange(width) < sizes[:, None]
        after = np.tile(np.minimum(np.arange(1, width + 1), width - 1), (rows, 1))  # the last cell stands for the end
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        agenda, joined = self._look(symbols, np.hstack([symbols[:, 1:], np.full((rows, 1), -1)]))
        open_rows = np.flatnonzero(~strange)
        while len(open_rows):
            left = agenda[open_rows].argmin(axis=1)
            more = agenda[open_rows, left] < NEVER
            row, left = open_rows[more], left[more]
            right = after[row, left]
            follower, leader = after[row, right], before[row, left]
            merged = joined[row, left]
            symbols[row, left], symbols[row, right] = merged, -1
            alive[row, right], agenda[row, right] = False, NEVER
            after[row, left], before[row, follower] = follower, left
            agenda[row, left], joined[row, left] = self._look(merged, symbols[row, follower])
            led, first = row[leader >= 0], leader[leader >= 0]
            agenda[led, first], joined[led, first] = self._look(symbols[led, first], merged[leader >= 0])
            open_rows = row
        flat, ends = symbols[alive].astype(np.int32).tobytes(), np.cumsum(alive.sum(axis=1)) * 4
        odd = strange | ((symbols >= len(self.surface)) & alive).any(axis=1)
        starts = [0, *ends[:-1].tolist()]
        return [self.packed(w) if o else flat[a:b] for w, o, a, b in zip(words, odd.tolist(), starts, ends.tolist())]

    def packed(self, text: str) -> bytes:
        """Packed ids of one escaped text."""
        return array("i", self.numbers(text)).tobytes()

    def runs(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different runs of escaped words between which no merge can happen, the number of each in order, and runs per word.

        Letters are cut from full stops, commas and line ends, unless a piece has the two
        characters in a row: then the word is one run.
        """
        plain = [w if CUT not in w else "" for w in words]
        at, names = coded(pa.array(PARTS.findall(CUT.join(plain)), pa.string()))
        ends = np.array([ord(n[-1]) for n in names], np.int64)[at]
        starts = np.array([ord(n[0]) for n in names], np.int64)[at]
        cut = starts == ord(CUT)
        word = np.cumsum(cut)
        pair = ends[:-1] << 21 | starts[1:]
        inside = ~(cut[:-1] | cut[1:])
        touching = [p for p in np.unique(pair[inside]).tolist() if chr(p >> 21) + chr(p & 0x1FFFFF) in self.touching]
        whole = set(word[:-1][inside & np.isin(pair, touching)].tolist()).union(i for i, w in enumerate(words) if plain[i] != w)
        kept = ~cut & ~np.isin(word, list(whole)) if whole else ~cut
        at, word = at[kept], word[kept]
        if whole:
            at, word = np.append(at, len(names) + np.arange(len(whole))), np.append(word, sorted(whole))
            names += [words[i] for i in sorted(whole)]
            order = np.argsort(word, kind="stable")
            at, word = at[order], word[order]
        return names, at, np.bincount(word, minlength=len(words))

    def fill(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (without their first space) one after the other and their numbers, compared with the library's."""
        names, at, counts = self.runs([SPACE + w for w in words])
        order = sorted(range(len(names)), key=lambda i: len(names[i]))
        new = [names[i] for i in order]
        short = bisect(new, SHORT, key=len)
        packed: list[bytes] = []
        for start in range(0, short, TOGETHER):
            packed += self.many(new[start : min(short, start + TOGETHER)])
        packed += [self.packed(run) for run in new[short:]]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        own, sizes = taken(np.frombuffer(b"".join(packed), np.int32), sizes, place[at])
        sizes = summed(sizes, counts)
        theirs = self.library.encode([w.replace(SPACE, " ") for w in words], num_threads=1)
        if "" in words:  # a space that ends a text is an empty word, to which the library adds no space
            theirs[words.index("")] = [self.library.piece_to_id(SPACE)]
        same = np.array_equal(sizes, np.fromiter(map(len, theirs), np.int64, len(theirs)))
        if not same or own.tobytes() != array("i", chain.from_iterable(theirs)).tobytes():
            ends = np.cumsum(sizes)
            bad = next(w for w, b, n, t in zip(words, ends, sizes, theirs) if own[b - n : b].tolist() != t)
            raise ValueError(f"the agenda and the sentencepiece library differ on {bad!r}")
        return own, sizes

    def split(self, text: str) -> list[str]:
        """Runs of spaces, less the first space, with the word that follows."""
        if not text:
            return []
        if self.whole:
            return [text.replace(" ", SPACE)]
        if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        texts = pc.fill_null(texts, "")
        careful = np.ones(len(texts), bool) if self.whole else pc.match_substring_regex(texts, f"^$|^ | $|  |{SPACE}").to_numpy(zero_copy_only=False)
        plain = pc.split_pattern(texts.filter(pa.array(~careful)), " ")
        odd = pa.array([self.split(t) for t in texts.filter(pa.array(careful)).to_pylist()], pa.list_(pa.string()))
        order = np.argsort(np.append(np.flatnonzero(~careful), np.flatnonzero(careful)), kind="stable")
        counts = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (plain, odd)])
        index, words = coded(pa.concat_arrays([plain.flatten(), odd.flatten()]))
        index, counts = taken(index, counts, order)
        ids, sizes = taken(*self.fill(words), index) if words else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        return ids, summed(sizes, counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each text."""
        ids, sizes = self.numbered(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes).tolist()
        return [ids[b - n : b].tobytes() for b, n in zip(ends, sizes.tolist())]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces joined, invalid bytes replaced one by one."""
        parts = list(map(self.surface.__getitem__, ids))
        if b"" in parts:  # a control piece ends a run of byte pieces
            text = "".join(b"".join(run).decode("utf-8", "byte_by_byte") for empty, run in groupby(parts, b"".__eq__) if not empty)
        else:
            text = b"".join(parts).decode("utf-8", "byte_by_byte")
        first = next((i for i in ids if self.surface[i]), self.unknown)
        return text[1:] if first in self.led else text


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per Python worker."""
    return Vocabulary(path)


def _add(df: DataFrame, name: str, kind: T.DataType, task) -> DataFrame:
    kept = df.drop(name)
    return df.mapInArrow(task, T.StructType([*kept.schema.fields, T.StructField(name, kind)]))


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), values], names=[*names, name])


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as an array of int. ``model``: path on every executor."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in sliced(batches, ROWS, CHARS, text):
            values, sizes = words.numbered(batch.column(batch.schema.get_field_index(text)))
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            yield _with(batch, ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))

    return _add(df, ids, T.ArrayType(T.IntegerType()), task)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            out = []
            for start in range(0, batch.num_rows, DECODED):
                part = column.slice(start, DECODED)
                flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
                sizes = part.value_lengths().fill_null(0).to_pylist()
                each = [flat[b - n : b] for b, n in zip(accumulate(sizes), sizes)]
                own = list(map(words.decode, each))
                theirs = words.library.decode(each, num_threads=1)
                if own != theirs:
                    bad = next(x for x, a, b in zip(each, own, theirs) if a != b)
                    raise ValueError(f"the decoded text and that of the sentencepiece library differ on {bad[:100]}")
                out += own
            yield _with(batch, text, pa.array(out, pa.string()))

    return _add(df, text, T.StringType(), task)


def digests(documents: DataFrame, model: str) -> DataFrame:
    """Token count and digests of ids and decoded text for every document."""
    both = decode(encode(documents.select("doc_id", "text"), model).drop("text"), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
