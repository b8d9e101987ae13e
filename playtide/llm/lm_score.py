"""Language-model scoring by prediction by partial matching, with a word unigram base.

The model is a byte-context trie of depth ``ORDER`` taken from all training documents and
not changed while scoring (pretrained). The context of a byte is the ``ORDER`` bytes before
it, whatever they are; before a text stand spaces. No node is left out: the same text and
the same shares of counts give the same score at every corpus size. A symbol unseen in a
context costs an escape of probability 0.5 * distinct / occurrences (and a seen one its
occurrences less 0.5), and is looked for in the next shorter context without the symbols
seen in the longer one (exclusion); after the empty context what remains is uniform. A
longer context's symbols are among the shorter one's, so one number for each context, the
occurrences there of the longer context's symbols, is all that exclusion needs. A text's
score is the log10 probability of its bytes, A-Z in lower case, and of an end symbol (byte
255, which no text has).

Counts of words and of grams (a context and its symbol) grow with the corpus and are never
in one place: each task counts its own and sends them by bucket, to be summed. A bucket of
grams holds all grams of its contexts' last three bytes, so it is a trie of its own from
the third order on; the shorter orders (grams of three bytes, no more than 2^24 whatever
the corpus) go to all tasks. The number of buckets follows the bytes of the documents.
The words and grams that occur most (no more than ``HOT`` words and ``HOT_GRAMS`` grams,
with their finished probabilities) also go to all tasks, as a cache that changes no result;
the others of a chunk of documents go to their buckets as one message each, and return as
one sum per document. So no word and no gram is a hot key.

The base sums log10((c + 0.1) / (N + 0.1 * (V + 1))) over a text's words and one end token.

Defined results: null text is empty (one end token); rows are scored one by one, repeated
ids too; without training rows N = V = 0 and every byte costs log10(256). Other columns
are left out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import id_remainder, partitions, sliced, stored

HOT = 2**19  # words whose counts all tasks hold, 16 bytes each
HOT_GRAMS = 2**21  # grams whose probabilities all tasks hold, 16 bytes each
ORDER = 6  # bytes of the longest context
LOW = 2  # orders up to this one go to all tasks
BUCKET = 2**26  # bytes of documents for each bucket
ROWS, CHARS = 4_000, 6_000_000  # of a chunk of documents
PIECE = 2**19  # bytes that are looked at together, some 100 bytes of memory each
SENT = 4_000_000  # counted grams or words that a task holds
STRIDE, MERGED = 2**12, 2**18  # rows between two that are looked at for bounds, and rows that are merged together
END = b"\xff"  # stands for the end of a text
LEAD = b" " * ORDER
END_TOKEN = xxhash.xxh64_intdigest(b" ")  # no word is a space


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and end tokens of all texts, and how many each text has."""
    parts, sizes = [], np.empty(len(texts), np.int64)
    end = np.array([END_TOKEN], np.uint64)
    for i, text in enumerate(texts):
        words = text.split()  # of bytes: at ASCII white space
        parts += [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), end]
        sizes[i] = len(words) + 1
    return np.concatenate(parts), sizes


def grams(texts: list[bytes], piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Context and symbol of every byte and end as one number, and the text it is of; ``piece`` bytes at a time."""
    if not texts:
        return
    data = np.frombuffer(LEAD + (END + LEAD).join(texts) + END, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + ORDER)[: len(data) - ORDER]
    gaps = (np.cumsum(sizes + ORDER) - ORDER)[:-1]
    owner[(gaps[:, None] + np.arange(ORDER)).ravel()] = -1  # where the lead of the next text is the symbol
    for start in range(0, len(owner), piece):
        raw = data[start : start + piece + ORDER].astype(np.uint64)
        two = raw[1:] | raw[:-1] << np.uint64(8)
        four = two[2:] | two[:-2] << np.uint64(16)
        keys = four[3:] | two[1:-4] << np.uint64(32) | raw[:-6] << np.uint64(48)
        of = owner[start : start + piece]
        yield keys[of >= 0], of[of >= 0]


def bucket_of(kind: str, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each word, or of the last three bytes of each gram's context."""
    if kind == "gram":
        keys = (keys >> np.uint64(8) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (keys % np.uint64(buckets)).astype(np.int64)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each different one of sorted keys begins."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])


def _summed(keys: np.ndarray, counts: np.ndarray, kind: str = "quicksort") -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind=kind)
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(counts[order], first).astype(np.int64, copy=False)


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums of sorted runs, a range of keys of about ``MERGED`` rows at a time: beside the runs and the sums little is held."""
    seen = np.sort(np.concatenate([keys[::STRIDE] for keys, _ in runs]))
    bounds = seen[MERGED // STRIDE :: MERGED // STRIDE]
    cuts = [[0, *np.searchsorted(keys, bounds).tolist(), len(keys)] for keys, _ in runs]
    parts = []
    for ends in zip(*(zip(c[:-1], c[1:]) for c in cuts)):
        own = [(keys[a:b], counts[a:b]) for (keys, counts), (a, b) in zip(runs, ends)]
        parts.append(_summed(*(np.concatenate(x) for x in zip(*own)), "stable"))
    return parts


class Tally:
    """Counts by key in sorted runs, merged when the later runs have as many rows as the first.

    So a row is merged again only when the tally has doubled.
    """

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.later = 0

    def __len__(self) -> int:
        return self.later + (len(self.runs[0][0]) if self.runs else 0)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Count sorted different keys too."""
        self.later += len(keys) if self.runs else 0
        self.runs.append((keys, counts))
        if self.later >= max(MERGED, len(self.runs[0][0])):
            self.merge()

    def merge(self) -> None:
        """One run of them all."""
        if len(self.runs) > 1:
            parts = _merged(self.runs)
            self.runs = []
            keys, counts = zip(*parts)
            del parts
            keys = np.concatenate(keys)
            self.runs, self.later = [(keys, np.concatenate(counts))], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """All sorted keys and their counts; the tally is empty after it."""
        self.merge()
        return self.runs.pop()


def _counting(buckets: int):
    """(text, held_out) -> (kind, bucket, keys, counts): words and grams of the training rows of a task."""

    def packed(kind: str, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = bucket_of(kind, keys, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.cumsum(np.bincount(bucket, minlength=buckets))
        del bucket
        for b in np.flatnonzero(np.diff(cuts, prepend=0)).tolist():
            piece = order[cuts[b - 1] if b else 0 : cuts[b]]
            yield pa.RecordBatch.from_pydict({"kind": [kind], "bucket": pa.array([b], pa.int32()), "keys": [keys[piece].tobytes()], "counts": [counts[piece].tobytes()]})

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {"word": Tally(), "gram": Tally()}
        for batch in sliced(batches, ROWS, CHARS):
            texts = [(t or "").encode().lower() for t, h in zip(batch["text"].to_pylist(), batch["held_out"].to_pylist()) if not h]
            if not texts:
                continue
            held["word"].add(*np.unique(tokens(texts)[0], return_counts=True))
            for keys, _ in grams(texts):
                held["gram"].add(*np.unique(keys, return_counts=True))
                for kind, tally in held.items():
                    if len(tally) > SENT:
                        tally.merge()
                        if len(tally) > SENT * 3 // 4:  # a bound on memory: what is sent is summed again
                            yield from packed(kind, *tally.taken())
        for kind, tally in held.items():
            if len(tally):
                yield from packed(kind, *tally.taken())

    return task


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed counts sorted by (kind, bucket) -> one row of each with the sums, their total and their number."""
    held, last = Tally(), None

    def out() -> pa.RecordBatch:
        keys, counts = held.taken()
        row = {"kind": [last[0]], "bucket": pa.array([last[1]], pa.int32()), "keys": [keys.tobytes()], "counts": [counts.tobytes()], "total": [int(counts.sum())], "distinct": [len(keys)]}
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        for kind, bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if last is not None and last != (kind, bucket):
                yield out()
            last = (kind, bucket)
            held.add(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64))
    if last is not None:
        yield out()


def shorter(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of an order from longer ones."""
    return _summed(keys & np.uint64(2 ** (8 * order + 8) - 1), counts)


def trie_of(low: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, counts: np.ndarray) -> Trie:
    """The trie of a bucket: the low orders of all grams, the others of its own."""
    return Trie([*low, *(shorter(keys, counts, k) for k in range(LOW + 1, ORDER)), (keys, counts)])


class Trie:
    """Grams of each order, and for each context its occurrences, distinct symbols and exclusion."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        self.orders, self.contexts = orders, []
        for k, (keys, counts) in enumerate(orders):
            context, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            fewer = self._count(k - 1, keys) if k else np.zeros(len(keys))
            sums = [np.bincount(at, weights=w, minlength=len(context)) for w in (counts, np.ones(len(keys)), fewer)]
            self.contexts.append((context, np.stack(sums)))

    def _count(self, order: int, keys: np.ndarray) -> np.ndarray:
        found, counts = self.orders[order]
        return _found(found, counts, keys & np.uint64(2 ** (8 * order + 8) - 1))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol after its context; fastest where the grams are sorted."""
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        excluded, fewer = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(ORDER, -1, -1):
            of = keys[left]
            count = self._count(k, of)
            context, sums = self.contexts[k]
            total, distinct, below = _found(context, sums, (of & np.uint64(2 ** (8 * k + 8) - 1)) >> np.uint64(8))
            n, d = total - excluded, distinct - fewer
            hit, miss = count > 0, (count == 0) & (n > 0)
            out[left[hit]] += np.log10((count[hit] - 0.5) / n[hit])
            out[left[miss]] += np.log10(0.5 * d[miss] / n[miss])
            left, excluded, fewer = left[~hit], below[~hit], distinct[~hit]
        out[left] -= np.log10(256 - fewer)
        return out


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of wanted keys among sorted ones (the last axis), 0 where they are not there."""
    if not len(keys):
        return np.zeros((*values.shape[:-1], len(wanted)))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[..., at], 0)


def octave(counts: np.ndarray) -> np.ndarray:
    """Quarter octave of each count; many grams share one, so a limit in them needs a small table only."""
    return np.floor(4 * np.log2(counts)).astype(np.int64)


def _messages(kind: str, keys: np.ndarray, doc: np.ndarray, times: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, message) of rows sorted by key: the keys, and for each the documents and how often they have it."""
    bucket = bucket_of(kind, keys, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, doc, times = keys[order], doc[order], times[order]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.unique(bucket).tolist():
        own = keys[cuts[b] : cuts[b + 1]]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        piece = slice(cuts[b], cuts[b + 1])
        body = [own[first], first.astype(np.int32), doc[piece].astype(np.uint16), times[piece].astype(np.int32)]
        yield b, struct.pack("<qq", len(first), len(own)) + b"".join(x.tobytes() for x in body)


def _scoring(buckets: int, shared):
    """(doc_id, text, held_out) -> rows of documents, and messages with the words and grams that are not hot."""
    names = ["kind", "bucket", "chunk", "message", "doc_id", "held_out", "row", "n_tokens", "known", "base", "score"]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_counts, often, worth = shared.value
        number = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, ROWS, CHARS):
            n, chunk = batch.num_rows, number
            number += 1
            texts = [(t or "").encode().lower() for t in batch["text"].to_pylist()]
            found, sizes = tokens(texts)
            word, at = np.unique(found, return_inverse=True)
            pair, times = np.unique(at * n + np.repeat(np.arange(n), sizes), return_counts=True)
            of, doc = pair // n, pair % n
            spot = np.minimum(np.searchsorted(hot, word), max(0, len(hot) - 1))
            is_hot = hot[spot] == word if len(hot) else np.zeros(len(word), bool)
            c = np.where(is_hot, hot_counts[spot], 0) if len(hot) else np.zeros(len(word), np.int64)
            now = is_hot[of]
            base = np.bincount(doc[now], weights=times[now] * np.log10(c[of[now]] + 0.1), minlength=n)
            known = np.bincount(doc[now], weights=times[now] * (c[of[now]] > 0), minlength=n).astype(np.int64)
            score, rare = np.zeros(n), []
            for keys, owner in grams(texts):
                code, own = pd.factorize(keys)
                order = np.argsort(own)  # a search for sorted keys stays in the CPU's cache
                there, value = np.zeros(len(own), bool), np.zeros(len(own))
                if len(often):
                    spot = np.minimum(np.searchsorted(often, own[order]), len(often) - 1)
                    there[order] = hit = often[spot] == own[order]
                    value[order] = np.where(hit, worth[spot], 0)
                score += np.bincount(owner, weights=value[code], minlength=n)
                left = np.flatnonzero(~there[code])
                rare.append((keys[left], owner[left]))
            keys, at = np.unique(np.concatenate([k for k, _ in rare]), return_inverse=True)
            pair, often_in = np.unique(at * n + np.concatenate([o for _, o in rare]), return_counts=True)
            rows = pa.array((np.int64(chunk) << 13) + np.arange(n))
            none = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, batch["doc_id"], batch["held_out"], rows, pa.array(sizes), pa.array(known), pa.array(base), pa.array(score)], names=names)
            sent = [("word", *m) for m in _messages("word", word[of[~now]], doc[~now], times[~now], buckets)]
            sent += [("gram", *m) for m in _messages("gram", keys[pair // n], pair % n, often_in, buckets)]
            if sent:
                k = len(sent)
                kinds, to, messages = zip(*sent)
                other = [pa.nulls(k, batch.schema.field("doc_id").type), pa.nulls(k, pa.bool_()), *[pa.nulls(k, pa.int64())] * 3, *[pa.nulls(k, pa.float64())] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(to, pa.int32()), pa.array([chunk] * k, pa.int64()), pa.array(messages, pa.binary()), *other], names=names)

    return task


def _answers(shared):
    """Rows by kind and bucket, counts before messages -> packed sums by chunk and document."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, last, trie = np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None
        for batch in batches:
            kinds, chunks, sums = [], [], []
            for kind, b, chunk, k, v, message in zip(*(batch[c].to_pylist() for c in ("kind", "bucket", "chunk", "keys", "counts", "message"))):
                if last != (kind, b):
                    keys, counts, last, trie = np.zeros(0, np.uint64), np.zeros(0, np.int64), (kind, b), None
                if message is None:
                    keys, counts = np.frombuffer(k, np.uint64), np.frombuffer(v, np.int64)
                    continue
                n, m = struct.unpack_from("<qq", message)
                wanted = np.frombuffer(message, np.uint64, n, 16)
                first = np.frombuffer(message, np.int32, n, 16 + 8 * n)
                doc = np.frombuffer(message, np.uint16, m, 16 + 12 * n)
                times = np.frombuffer(message, np.int32, m, 16 + 12 * n + 2 * m)
                if kind == "gram":
                    trie = trie or trie_of(shared.value, keys, counts)
                    worth, there = trie.log10(wanted), np.zeros(n)
                else:
                    there = _found(keys, counts, wanted)
                    worth = np.log10(there + 0.1)
                worth, there = (np.repeat(x, np.diff(np.r_[first, m])) for x in (worth, there))
                docs, at = np.unique(doc, return_inverse=True)
                found = np.bincount(at, weights=times * worth), np.bincount(at, weights=times * (there > 0))
                kinds.append(kind)
                chunks.append(chunk)
                sums.append(struct.pack("<q", len(docs)) + docs.tobytes() + b"".join(x.tobytes() for x in found))
            if chunks:
                yield pa.RecordBatch.from_pydict({"kind": kinds, "chunk": pa.array(chunks, pa.int64()), "sums": pa.array(sums, pa.binary())})

    return task


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sums sorted by chunk -> (row, more_base, more_known, more_score)."""
    total, last = np.zeros((3, 1 << 13)), None

    def out() -> pa.RecordBatch:
        there = np.flatnonzero(total.any(axis=0))
        base, known, score = total[:, there]
        return pa.RecordBatch.from_pydict({"row": (np.int64(last) << 13) + there, "more_base": base, "more_known": known.astype(np.int64), "more_score": score})

    for batch in batches:
        for kind, chunk, sums in zip(*(batch[c].to_pylist() for c in ("kind", "chunk", "sums"))):
            if last is not None and chunk != last:
                yield out()
                total[:] = 0
            last = chunk
            (n,) = struct.unpack_from("<q", sums)
            doc = np.frombuffer(sums, np.uint16, n, 8)
            worth, known = np.frombuffer(sums[8 + 2 * n :], np.float64, 2 * n).reshape(2, n)
            total[2 if kind == "gram" else 0, doc] += worth
            total[1, doc] += known
    if last is not None:
        yield out()


def _low(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed buckets -> (kind, key, n): grams of the order ``LOW``, and how many grams each quarter octave has."""
    for batch in batches:
        for k, v in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
            keys, counts = np.frombuffer(k, np.uint64), np.frombuffer(v, np.int64)
            step, n = np.unique(octave(counts), return_counts=True)
            for kind, own, times in (("low", *shorter(keys, counts, LOW)), ("octave", step, n)):
                yield pa.RecordBatch.from_pydict({"kind": [kind] * len(own), "key": own.astype(np.int64), "n": times.astype(np.int64)})


def scored(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    held_out = id_remainder(F.col(doc_id), 10) == 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(partitions(spark), -(-size // BUCKET))
    sent = rows.select("text", "held_out").mapInArrow(_counting(buckets), "kind string, bucket int, keys binary, counts binary")
    sent = sent.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    summed = stored(sent.mapInArrow(_sums, "kind string, bucket int, keys binary, counts binary, total long, distinct long"))
    words, all_grams = summed.filter("kind = 'word'"), summed.filter("kind = 'gram'")
    train_tokens, distinct = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    least = max(1, -(-train_tokens // HOT))

    def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, v in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
                counts = np.frombuffer(v, np.int64)
                yield pa.RecordBatch.from_pydict({"key": np.frombuffer(k, np.int64)[counts >= least], "n": counts[counts >= least]})

    hot = words.select("keys", "counts").mapInArrow(frequent, "key long, n long").toPandas()  # at most HOT rows
    hot_keys = hot["key"].to_numpy(np.int64).view(np.uint64)
    order_ = np.argsort(hot_keys)

    # at most 2^24 grams of three bytes, and some hundred octaves
    small = all_grams.select("keys", "counts").mapInArrow(_low, "kind string, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toPandas()
    grams_ = small[small["kind"] == "low"]
    keys, counts = grams_["key"].to_numpy(np.int64).view(np.uint64), grams_["n"].to_numpy(np.int64)
    low = [shorter(keys, counts, k) for k in range(LOW + 1)]
    octaves = small[small["kind"] == "octave"].sort_values("key", ascending=False)
    fits = octaves["key"][octaves["n"].cumsum() <= HOT_GRAMS]
    from_octave = int(fits.min()) if len(fits) else 1 << 20
    shared_low = spark.sparkContext.broadcast(low)

    def likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, v in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
                keys, counts = np.frombuffer(k, np.uint64), np.frombuffer(v, np.int64)
                own = keys[octave(counts) >= from_octave]
                worth = trie_of(shared_low.value, keys, counts).log10(own)
                yield pa.RecordBatch.from_pydict({"keys": [own.tobytes()], "worth": [worth.tobytes()]})

    found = all_grams.select("keys", "counts").mapInArrow(likely, "keys binary, worth binary").collect()  # at most HOT_GRAMS grams
    often = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["keys"], np.uint64) for r in found)])
    worth = np.concatenate([np.zeros(0), *(np.frombuffer(r["worth"]) for r in found)])
    by_key = np.argsort(often)
    shared = spark.sparkContext.broadcast((hot_keys[order_], hot["n"].to_numpy(np.int64)[order_], often[by_key], worth[by_key]))
    schema = f"kind string, bucket int, chunk long, message binary, doc_id {kind}, held_out boolean, row long, n_tokens long, known long, base double, score double"
    both = stored(rows.mapInArrow(_scoring(buckets, shared), schema))
    nothing = F.lit(None)
    tables = summed.select("kind", "bucket", nothing.cast("long").alias("chunk"), "keys", "counts", nothing.cast("binary").alias("message"))
    asked = both.filter("message is not null").select("kind", "bucket", "chunk", nothing.cast("binary").alias("keys"), nothing.cast("binary").alias("counts"), "message")
    met = tables.union(asked).repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", F.col("chunk").asc_nulls_first())
    sums = met.mapInArrow(_answers(shared_low), "kind string, chunk long, sums binary").repartition("chunk").sortWithinPartitions("chunk", "kind")
    more = sums.mapInArrow(_gathered, "row long, more_base double, more_known long, more_score double")
    total = F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(train_tokens + 0.1 * (distinct + 1))))
    return both.filter("message is null").join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        total.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
