"""Language identification by a byte convolutional network.

A text in lower case is cut into windows of ``WINDOW`` bytes, the last one filled with
zeros, so every byte of every text is read. A window's bytes are embedded and convolved
with filters of several widths; each filter's maximum over the window goes through a
rectifier to a softmax over the languages. The document's score is the mean of its windows'
probabilities, weighted by their bytes. Training is stochastic gradient descent in numpy on
windows of a bounded sample of labelled rows, ``PER_LANGUAGE`` documents of each language
taken by a hash of their ids. For prediction the embedding and the filters are folded into
tables of byte pairs, so that a convolution is a sum of two lookups.

Defined results: a text that is null or has no letter is ``und`` with score 0; ties go to
the language that sorts first; without any labelled row every text is ``und``. Rows are
independent; a text of any length is a list of windows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.llm.common import id_remainder, sliced

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)  # bytes under a filter
FILTERS = 12  # of each width
EMBEDDED = 8  # numbers that stand for a byte
PER_LANGUAGE = 400  # sampled documents of a language
PER_DOCUMENT = 4  # windows of a sampled document, spread over its whole text
EPOCHS, STEPS = 6, 300  # at least so many of both
LETTER = regex.compile(r"\p{L}")
ROWS, CHARS = 1_000, 1_000_000


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts as rows of bytes, and the text that each belongs to."""
    raw = [t.lower().encode() for t in texts]
    counts = np.array([-(-len(r) // WINDOW) for r in raw], np.int64)
    block = b"".join(r.ljust(n * WINDOW, b"\0") for r, n in zip(raw, counts.tolist()))
    return np.frombuffer(block, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(raw)), counts)


class Network:
    """Filters and output weights; ``fit`` trains them, ``probabilities`` applies them."""

    def __init__(self, languages: list[str], seed: int = 5):
        draw = np.random.RandomState(seed)
        self.languages = languages
        self.embedding = draw.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32)
        self.filters = [draw.normal(0, (2 / (w * EMBEDDED)) ** 0.5, (w * EMBEDDED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = draw.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def fit(self, found: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """Adam on the cross entropy, in batches of 64 windows."""
        draw = np.random.RandomState(seed)
        weights = [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for epoch in range(epochs):
            order = draw.permutation(len(found))
            for start in range(0, len(order), 64):
                chosen = order[start : start + 64]
                step += 1
                rate = 0.004 / (1 + epoch) ** 0.5
                for w, g, m, v in zip(weights, self._gradients(found[chosen], labels[chosen]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, found: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        n, at = len(found), np.arange(len(found))[:, None]
        embedded = self.embedding[found]
        pooled, places, views = [], [], []
        for w, filters, bias in zip(WIDTHS, self.filters, self.bias):
            view = np.concatenate([embedded[:, k : WINDOW - w + 1 + k] for k in range(w)], axis=2)
            mapped = view @ filters + bias
            places.append(mapped.argmax(axis=1))
            pooled.append(mapped.max(axis=1))
            views.append(view)
        hidden = np.maximum(np.hstack(pooled), 0)
        error = softmax(hidden @ self.out + self.out_bias)
        error[np.arange(n), labels] -= 1
        error /= n
        back = (error @ self.out.T) * (hidden > 0)
        g_embedding, g_filters, g_bias = np.zeros_like(self.embedding), [], []
        for i, (w, filters) in enumerate(zip(WIDTHS, self.filters)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            taken = views[i][at, places[i]]  # what stood under each filter's maximum
            g_filters.append(np.einsum("nfe,nf->ef", taken, part))
            g_bias.append(part.sum(axis=0))
            spread = part[:, :, None] * filters.T[None]
            for k in range(w):
                np.add.at(g_embedding, found[at, places[i] + k].ravel(), spread[:, :, k * EMBEDDED : (k + 1) * EMBEDDED].reshape(-1, EMBEDDED))
        return [g_embedding, *g_filters, *g_bias, hidden.T @ error, error.sum(axis=0)]

    def fold(self) -> None:
        """Tables of the filters' values by byte and by pair of bytes."""
        self.tables = []
        for w, filters in zip(WIDTHS, self.filters):
            single = [self.embedding @ filters[k * EMBEDDED : (k + 1) * EMBEDDED] for k in range(w)]
            steps = []
            for k in range(0, w - 1, 2):
                steps.append((k, (single[k][None, :, :] + single[k + 1][:, None, :]).reshape(65536, FILTERS)))
            if w % 2:
                steps.append((-(w - 1), single[w - 1]))
            self.tables.append(steps)

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        """Languages' probabilities for each window."""
        out = np.empty((len(found), len(self.languages)), np.float32)
        for start in range(0, len(found), 64):
            block = found[start : start + 64]
            pairs = block[:, :-1].astype(np.int32) + 256 * block[:, 1:].astype(np.int32)
            pooled = []
            for w, steps, bias in zip(WIDTHS, self.tables, self.bias):
                span, total = WINDOW - w + 1, None
                for k, table in steps:
                    index = block[:, -k : span - k] if k < 0 else pairs[:, k : k + span]
                    value = table.take(index, axis=0)
                    total = value if total is None else np.add(total, value, out=total)
                pooled.append(total.max(axis=1) + bias)
            out[start : start + 64] = softmax(np.maximum(np.hstack(pooled), 0) @ self.out + self.out_bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(rows: DataFrame, per_language: int = PER_LANGUAGE, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Network:
    """A network from a sample of at most ``per_language`` rows of each language.

    The sample takes the rows whose ids hash lowest, whatever their text, and brings a few
    windows of each to the driver, spread over the text.
    """
    labelled = rows.filter(F.col(lang).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / float(1 << 40)
    # one row per language: the share of its rows that holds about twice the sample
    shares = labelled.groupBy("_lang").agg(F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.count(F.lit(1))).alias("_share"))
    near = labelled.join(F.broadcast(shares), "_lang").filter((place < F.col("_share")) & (F.length("_text") > 0))
    size = F.length("_text")
    spots = [F.expr(f"substring(_text, cast(1 + greatest(length(_text) - {WINDOW}, 0) * {k} / {max(1, PER_DOCUMENT - 1)} as int), {WINDOW})") for k in range(PER_DOCUMENT)]
    spots = F.when(size <= WINDOW, F.array(F.col("_text"))).otherwise(F.array(*spots))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_place", "_id", "_parts"))
    chosen = near.select("_id", "_lang", place.alias("_place"), spots.alias("_parts")).withColumn("_rank", rank).filter(F.col("_rank") <= per_language)
    sample = chosen.select(F.col("_lang").alias("lang"), F.explode("_parts").alias("part")).toPandas()  # at most languages * sample * windows
    sample = sample[np.array([bool(LETTER.search(t)) for t in sample["part"]], bool)]
    languages = sorted(sample["lang"].unique())
    network = Network(languages)
    if languages:
        found, owner = windows(sample["part"].tolist())
        labels = np.array([languages.index(x) for x in sample["lang"]])[owner]
        network.fit(found, labels, max(EPOCHS, -(-64 * STEPS // len(found))))
        network.fold()
    return network


def predict(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed size, some 5 MB
    rows = docs.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches, ROWS, CHARS, text):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            lettered = [bool(model.languages) and LETTER.search(t) is not None for t in texts]
            found, owner = windows([t if x else "" for t, x in zip(texts, lettered)])
            total = np.zeros((len(texts), max(1, len(model.languages))))
            weight = np.zeros(len(texts))
            if len(found):
                filled = (found != 0).sum(axis=1)
                np.add.at(total, owner, model.probabilities(found) * filled[:, None])
                np.add.at(weight, owner, filled)
            best = total.argmax(axis=1)
            score = total[np.arange(len(texts)), best] / np.maximum(weight, 1)
            names = [model.languages[b] if x else "und" for b, x in zip(best.tolist(), lettered)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1))], names=schema.names)

    return rows.mapInArrow(task, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that training leaves out: crc32 of the id is 2 modulo 4."""
    return id_remainder(F.col(doc_id), 4) == 2


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learnt from the rows that are not held out."""
    network = train(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text"), network).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
