"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages: all its windows of ``PASSAGE`` bytes. Each passage is
encoded from the frequencies of its pairs of byte classes and the share of its byte
four-grams that are new within it, through one hidden layer. Gated attention weighs the
passages of a document, the weighted representation gives the score. Labels belong to
documents only, so the network learns by itself which passages speak. Training runs in
numpy on ``PER_LABEL`` documents of each label, taken by a hash of their ids, each with up
to ``PER_DOCUMENT`` passages spread over its text; scoring reads every passage.

Defined results: null and empty texts have one empty passage and get its score; a document
with several labels counts with the largest; without labels of both kinds every score is
the share of label 1 (0.5 without any). Rows are independent, repeated rows get the same
score; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm.common import id_remainder, sliced

PASSAGE = 512  # bytes
PER_LABEL = 1_000  # sampled documents of a label
PER_DOCUMENT = 12  # passages of a sampled document
HIDDEN, GATES = 24, 16
EPOCHS = 20
GOOD = 0.7  # least score of a document that is predicted to be good
ROWS, CHARS = 1_000, 1_000_000
BLOCK = 2_048  # passages that are encoded at once, whatever the length of their document

SIGNS = b" \n.,!?|#%$&*=@:;-/()\"'"  # bytes with a class of their own


def _classes() -> np.ndarray:
    """Class of each byte: signs, vowels, consonants, capitals, digits, other signs, bytes of other letters."""
    kind = np.full(256, 31, np.int64)
    kind[128:] = 30
    kind[ord("a") : ord("z") + 1] = 29
    for b in b"aeiou":
        kind[b] = 28
    kind[ord("A") : ord("Z") + 1] = 27
    kind[ord("0") : ord("9") + 1] = 26
    for i, b in enumerate(SIGNS):
        kind[b] = 1 + i
    kind[0] = 0
    return kind


CLASS = _classes()


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All passages as rows of bytes filled with zeros, and the text that each belongs to."""
    counts = np.array([max(1, -(-len(t) // PASSAGE)) for t in texts], np.int64)
    block = b"".join(t.ljust(n * PASSAGE, b"\0") for t, n in zip(texts, counts.tolist()))
    return np.frombuffer(block, np.uint8).reshape(-1, PASSAGE), np.repeat(np.arange(len(texts)), counts)


def encoded(found: np.ndarray) -> np.ndarray:
    """Root frequencies of pairs of byte classes, and the share of new four-grams."""
    out = np.empty((len(found), 1025), np.float32)
    for start in range(0, len(found), 256):
        block = found[start : start + 256]
        kinds = CLASS[block]
        pairs = kinds[:, :-1] * 32 + kinds[:, 1:] + np.arange(len(block))[:, None] * 1024
        counts = np.bincount(pairs.ravel(), minlength=len(block) * 1024).reshape(-1, 1024)
        counts[:, 0] = 0  # filling
        size = np.maximum((block != 0).sum(axis=1), 1)
        wide = block.astype(np.uint32)
        grams = np.sort(wide[:, :-3] | wide[:, 1:-2] << 8 | wide[:, 2:-1] << 16 | wide[:, 3:] << 24, axis=1)
        fresh = ((grams[:, 1:] != grams[:, :-1]).sum(axis=1) + 1) / size
        out[start : start + 256, :1024] = np.sqrt(counts / size[:, None])
        out[start : start + 256, 1024] = fresh
    return out


class Attention:
    """The network: hidden layer, two gates, attention weights and the output."""

    def __init__(self, seed: int = 11):
        draw = np.random.RandomState(seed)
        shape = lambda *s: draw.normal(0, (1 / s[0]) ** 0.5, s).astype(np.float32)
        self.inner, self.inner_bias = shape(1025, HIDDEN) * 3, np.zeros(HIDDEN, np.float32)
        self.v, self.u, self.w = shape(HIDDEN, GATES), shape(HIDDEN, GATES), shape(GATES, 1)
        self.out, self.out_bias = shape(HIDDEN, 1), np.zeros(1, np.float32)

    def forward(self, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple:
        """Hidden values, gates, attention and scores; passages of a document stand together."""
        return self.attend(self.hidden(x), starts, owner)

    def hidden(self, x: np.ndarray) -> np.ndarray:
        """Hidden values of passages."""
        return np.tanh(x @ self.inner + self.inner_bias)

    def attend(self, hidden: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple:
        """``forward`` from the hidden values, which take a tenth of a passage's bytes."""
        t, g = np.tanh(hidden @ self.v), 1 / (1 + np.exp(-(hidden @ self.u)))
        e = ((t * g) @ self.w)[:, 0]
        e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        a = e / np.add.reduceat(e, starts)[owner]
        z = np.add.reduceat(hidden * a[:, None], starts, axis=0)
        return hidden, t, g, a, z, 1 / (1 + np.exp(-(z @ self.out + self.out_bias)[:, 0]))

    def fit(self, x: np.ndarray, owner: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 13) -> None:
        """Adam on the cross entropy, both labels weighing the same, 32 documents a step."""
        draw = np.random.RandomState(seed)
        bounds = np.searchsorted(owner, np.arange(len(labels) + 1))
        weigh = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
        params = [self.inner, self.inner_bias, self.v, self.u, self.w, self.out, self.out_bias]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for epoch in range(epochs):
            order = draw.permutation(len(labels))
            for start in range(0, len(order), 32):
                bags = order[start : start + 32]
                rows = np.concatenate([np.arange(bounds[b], bounds[b + 1]) for b in bags])
                sizes = bounds[bags + 1] - bounds[bags]
                grads = self._gradients(x[rows], np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes), labels[bags], weigh[bags])
                step += 1
                rate = 0.003 / (1 + 0.2 * epoch)
                for p, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, x, starts, owner, labels, weigh) -> list[np.ndarray]:
        hidden, t, g, a, z, p = self.forward(x, starts, owner)
        error = ((p - labels) * weigh / len(labels))[:, None].astype(np.float32)
        dz = (error @ self.out.T)[owner]
        dh = a[:, None] * dz
        da = (hidden * dz).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[owner])
        gate = de[:, None] @ self.w.T
        dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
        dh = (dh + dt @ self.v.T + dg @ self.u.T) * (1 - hidden * hidden)
        return [x.T @ dh + 1e-5 * self.inner, dh.sum(axis=0), hidden.T @ dt, hidden.T @ dg, (t * g).T @ de[:, None], z.T @ error, error.sum(axis=0)]


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", per_label: int = PER_LABEL, text: str = "text", doc_id: str = "doc_id") -> Attention | float:
    """A network from at most ``per_label`` documents of each label, or the share of label 1 if one label is missing."""
    known = labels.filter(F.col(target).isNotNull()).groupBy(doc_id).agg((F.max(target) > 0).cast("int").alias("_label"))
    # two rows: the share of a label's documents that holds about twice the sample; only those are ranked
    shares = known.groupBy("_label").agg(F.least(F.lit(1.0), F.lit(2.0 * per_label) / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64(doc_id), F.lit(1 << 40)) / float(1 << 40)
    near = known.join(F.broadcast(shares), "_label").withColumn("_place", place).filter(F.col("_place") < F.col("_share")).drop("_share")
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_place", doc_id))
    chosen = near.withColumn("_rank", rank).drop("_place").filter(F.col("_rank") <= per_label).drop("_rank")
    size = F.length(text)
    spots = [F.expr(f"substring(`{text}`, cast(1 + greatest(length(`{text}`) - {PASSAGE}, 0) * {k} / {PER_DOCUMENT - 1} as int), {PASSAGE})") for k in range(PER_DOCUMENT)]
    parts = F.when(size <= PASSAGE, F.array(F.col(text))).otherwise(F.array(*spots))
    joined = docs.select(doc_id, text).join(F.broadcast(chosen), doc_id)  # two labels * per_label rows
    sample = joined.filter(size > 0).select("_label", parts.alias("parts")).toPandas()
    labels_ = sample["_label"].to_numpy()
    if len(set(labels_)) < 2:
        return float(labels_.mean()) if len(labels_) else 0.5
    bags = [[p.encode()[:PASSAGE] for p in parts] for parts in sample["parts"]]
    found, _ = passages([p for bag in bags for p in bag])
    network = Attention()
    network.fit(encoded(found), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), labels_)
    return network


def score(docs: DataFrame, network: Attention | float, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed size, some 100 KB

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches, ROWS, CHARS, "text"):
            if isinstance(model, float):
                value = np.full(batch.num_rows, model)
            else:
                found, owner = passages([(t or "").encode() for t in batch.column(1).to_pylist()])
                starts = np.searchsorted(owner, np.arange(batch.num_rows))
                hidden = np.concatenate([model.hidden(encoded(found[i : i + BLOCK])) for i in range(0, len(found), BLOCK)])
                value = model.attend(hidden, starts, owner)[-1].astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(task, f"doc_id {kind}, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, learnt from the labels that are not held out."""
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    network = train(docs, labels.filter(~held_out))
    scored = score(docs, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
