"""Near duplicates among embeddings by iterative quantisation and multi-index Hamming tables.

Rows of one label and one vector form a class; from here on only classes count. On a bounded
sample the principal axes are rotated until the signs of the coordinates lose least (iterative
quantisation), once for each ``BITS`` bits; the signs are a class's code. The code is cut into
substrings, each the key of a table: codes that differ in fewer bits than there are tables
share a substring. The bits of a substring grow with the logarithm of the largest label, and
tables are added until nearly all (``RECALL``) of simulated pairs at the limit, drawn around
the sample, share one. Every class is in every table.

Two passes rerank with the original vectors. The first takes from each table entry a forest
of the closest codes and joins classes along confirmed links, so that alike vectors, however
many, leave no more pairs than members. The second takes all pairs of an entry whose codes
are close enough and whose components still differ. Then every two members of a component
are compared in double precision, block against block, so that the links of a class are
counted without a row for each pair; links across components are those of the second pass.
Entries with more than ``LARGE`` classes are dealt into parts for the first pass and compared
block against block in the second, unless both blocks are of one component.

Work: a component (vectors that links join) is compared with itself, quadratic in its
classes; so are alike classes below the limit within an entry. Blocks bound the memory.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or
whose label is null, is linked with nothing and is its own component; so are vectors of unequal
length with each other. Equal vectors of one label are linked. Repeated rows and ids are rows of their
own; the smallest non-null id names a component; a row without an id has a component only if
a row with one is in it, and is never kept. An empty table gives no row. Other columns are
left out and their names do not matter. Vectors of more than ``WIDTH`` components are folded to
that length with random signs for their codes only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.llm.common import each_group, stored
from playtide.llm.near_dedup import _blocks, components, mix

BITS = 64  # of one rotation; fewer where vectors are shorter
WIDTH = 4_096  # components that codes are made of
SAMPLE, VALUES = 8_192, 1 << 21  # vectors, and components in all, that the rotations are learnt on
ROUNDS = 30  # of the iterative quantisation
FILL = 32  # classes of the largest label in an entry of a table, were they dealt evenly
LEAST_BITS, MOST_TABLES = 8, 96
RECALL, CLOSE = 0.999, 0.9995  # of simulated pairs: share that meets in a table, share within the radius
LARGE = 2_000  # classes of an entry that are compared at once
MEMORY = 16_000_000  # bytes of the vectors in a block of a component


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(vectors: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors of one length from their bytes."""
    return _unit(np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1))


def _folded(unit: np.ndarray, width: int) -> np.ndarray:
    """The rows with ``width`` components: zeros behind, or longer ones folded with random signs."""
    out = np.zeros((len(unit), width))
    for start in range(0, unit.shape[1], width):
        part = unit[:, start : start + width]
        sign = np.where(mix(np.arange(start, start + part.shape[1], dtype=np.uint64)) % 2 == 0, 1.0, -1.0) if unit.shape[1] > width else 1.0
        out[:, : part.shape[1]] += part * sign
    return out


def _wide(vectors: list[bytes], kind: str, width: int) -> np.ndarray:
    """Unit vectors of any lengths, padded or folded to ``width`` components."""
    sizes, out = np.fromiter(map(len, vectors), np.int64, len(vectors)), np.zeros((len(vectors), width))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows] = _folded(_matrix([vectors[i] for i in rows], kind), width)
    return out


class Codes:
    """Learnt rotations, and the cut of their signs into the substrings of the tables."""

    def __init__(self, sample: np.ndarray, limit: float, largest: int):
        self.width = sample.shape[1]
        self.bits = min(BITS, self.width)
        self.mean = sample.mean(axis=0)
        _, _, axes = np.linalg.svd(np.vstack([sample - self.mean, np.zeros((self.bits, self.width))]), full_matrices=False)
        self.axes = axes[: self.bits].T
        self.turns: list[np.ndarray] = []
        self.random = np.random.RandomState(20250111)
        self.substring = max(LEAST_BITS, int(np.ceil(np.log2(max(1, largest) / FILL))))
        self.tables = 4
        noise = self.random.standard_normal(sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.sqrt((noise * noise).sum(axis=1, keepdims=True)), 1e-300)
        partner = limit * sample + np.sqrt(1 - limit * limit) * noise
        while True:
            self._learn(sample)
            one, other = self.signs(sample), self.signs(partner)
            different = (one != other).reshape(len(sample), self.tables, self.substring)
            if (~different.any(axis=2)).any(axis=1).mean() >= RECALL or self.tables >= MOST_TABLES:
                break
            self.tables += 2
        self.radius = int(np.quantile(different.sum(axis=(1, 2)), CLOSE, method="higher"))

    def _learn(self, sample: np.ndarray) -> None:
        """Rotations until there is a bit for each place of each substring."""
        flat = (sample - self.mean) @ self.axes
        while len(self.turns) * self.bits < self.tables * self.substring:
            turn = np.linalg.qr(self.random.standard_normal((self.bits, self.bits)))[0]
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
                turn = (left @ right).T
            self.turns.append(turn)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """The bits of all tables, one row a vector."""
        flat = (unit - self.mean) @ self.axes
        return np.hstack([flat @ t >= 0 for t in self.turns])[:, : self.tables * self.substring]

    def entries(self, signs: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The entry of each vector in each table, as a hash of its group, the table and the substring."""
        out = np.empty((len(signs), self.tables), np.uint64)
        weight = np.uint64(1) << np.arange(self.substring, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for t in range(self.tables):
                value = (signs[:, t * self.substring : (t + 1) * self.substring] * weight).sum(axis=1, dtype=np.uint64)
                out[:, t] = mix(mix(group + np.uint64(t + 1) * np.uint64(0x9E3779B97F4A7C15)) ^ value)
        return out


def _packed(signs: np.ndarray) -> list[bytes]:
    """Codes as bytes, whole words of 64 bits."""
    bits = np.zeros((len(signs), -(-signs.shape[1] // 64) * 64), bool)
    bits[:, : signs.shape[1]] = signs
    return [row.tobytes() for row in np.packbits(bits, axis=1)]


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _apart(codes: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Bits in which one code differs from others."""
    return np.bitwise_count(codes[others] ^ codes[one]).sum(axis=1, dtype=np.int64)


def _vectors(kind: str):
    """A task from (id, label, vector) to (id, group, digest and bytes of a vector that can be linked, else null)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, digests, vectors = [], [], []
            for label, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                x = None if label is None or not value.is_valid or value.values.null_count else value.values.to_numpy().astype(kind)
                if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                    groups.append(None)
                    digests.append(None)
                    vectors.append(None)
                    continue
                own = (x + 0).tobytes()  # -0.0 becomes 0.0
                name = f"{len(x)}:{label}".encode()
                groups.append(int.from_bytes(xxhash.xxh3_64_digest(name), "little", signed=True))
                digests.append(xxhash.xxh3_128_digest(name + b"\0" + own))
                vectors.append(own)
            columns = [batch.column(0), pa.array(groups, pa.int64()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_group", "_digest", "_vector"])

    return task


def learnt(classes: DataFrame, kind: str, limit: float) -> Codes | None:
    """Rotations from a sample of at most ``SAMPLE`` classes, taken by hash; None without any class."""
    size = F.octet_length("_vector") / np.dtype(kind).itemsize
    known = classes.agg(F.count(F.lit(1)), F.max(size)).first()
    if not known[0]:
        return None
    width = int(min(WIDTH, known[1]))
    wanted = max(2, min(SAMPLE, VALUES // width))
    least = classes.select("_vector", F.xxhash64("_digest").alias("_h"))
    share = 1.5 * wanted / known[0]
    if share < 1:  # so that tasks sort few rows
        least = least.filter(F.abs(F.col("_h") % 1_000_003) < 1_000_003 * share)
    rows = least.orderBy("_h").limit(wanted).collect()
    largest = classes.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return Codes(_wide([bytes(r[0]) for r in rows], kind, width), limit, largest)


def _filed(codes: Codes, kind: str):
    """A task from (cls, group, vector) to a row of (table, node, cls, code) for every table."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                signs = codes.signs(_wide(part.column(2).to_pylist(), kind, codes.width))
                nodes = codes.entries(signs, part.column(1).to_numpy().view(np.uint64))
                code = pa.array(_packed(signs), pa.binary())
                for t in range(codes.tables):
                    table = pa.array(np.full(len(signs), t, np.int32))
                    yield pa.RecordBatch.from_arrays([table, pa.array(nodes[:, t].view(np.int64)), part.column(0), code], names=["table", "node", "cls", "code"])

    return task


def _forest(codes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a forest of the closest codes (Prim), none longer than the radius."""
    least, source, left, now, out = np.full(len(codes), 1 << 30), np.zeros(len(codes), np.int64), np.arange(1, len(codes)), 0, []
    while len(left):
        far = _apart(codes, now, left)
        closer = far < least[left]
        least[left[closer]], source[left[closer]] = far[closer], now
        at = int(least[left].argmin())
        now = int(left[at])
        if least[now] <= radius:
            out.append((int(source[now]), now))
        left = np.delete(left, at)
    return out


def _crossing(codes: np.ndarray, labels: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Pairs of different components whose codes are close."""
    for one in range(len(codes) - 1):
        others = one + 1 + np.flatnonzero(labels[one + 1 :] != labels[one])
        for other in others[_apart(codes, one, others) <= radius].tolist():
            yield one, other


def _pairs(radius: int, forest: bool):
    """A task from rows sorted by node (node, cls, label, code) to candidate pairs of classes."""

    def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = np.array(pairs, np.int64).T
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for node in each_group(batches, "node"):
            cls, at = np.unique(node["cls"].to_numpy(), return_index=True)
            if len(cls) < 2:
                continue
            codes = _codes(node["code"].combine_chunks())[at]
            found = _forest(codes, radius) if forest else _crossing(codes, node["label"].to_numpy()[at], radius)
            for a, b in found:
                held.append((cls[a], cls[b]))
                if len(held) >= 50_000:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    return task


def _confirmed(pairs: DataFrame, classes: DataFrame, kind: str, limit: float) -> DataFrame:
    """The pairs (a, b) of one group whose cosine reaches the limit."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                keep = np.zeros(part.num_rows, bool)
                ones, others = part.column(2).to_pylist(), part.column(3).to_pylist()
                sizes = np.fromiter(map(len, ones), np.int64, len(ones))
                for size in np.unique(sizes):  # one group has one length
                    rows = np.flatnonzero(sizes == size)
                    x, y = (_matrix([side[i] for i in rows], kind) for side in (ones, others))
                    keep[rows] = (x * y).sum(axis=1) >= limit
                yield part.select(["a", "b"]).filter(pa.array(keep))

    whose = classes.select("cls", "_group", "_vector")
    one = whose.select(F.col("cls").alias("a"), F.col("_group").alias("_ga"), F.col("_vector").alias("_va"))
    two = whose.select(F.col("cls").alias("b"), F.col("_group").alias("_gb"), F.col("_vector").alias("_vb"))
    full = pairs.join(one, "a").join(two, "b").filter("_ga = _gb and octet_length(_va) = octet_length(_vb)")
    return stored(full.select("a", "b", "_va", "_vb").mapInArrow(task, "a long, b long"))


def _entries(filed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, cls, code) of entries with two classes or more, larger ones in parts that share the first class; (node, cls) of the larger ones."""
    counted = filed.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("cls", "code")).alias("_first")).filter("_n > 1")
    kept = filed.join(counted.select("node", "_n"), "node")
    over = stored(kept.filter(F.col("_n") > LARGE).select("node", "cls"))
    parts = F.ceil(F.col("_n") / LARGE)
    own = kept.select(F.xxhash64("node", F.pmod(F.xxhash64("cls", "table"), parts)).alias("node"), "cls", "code")
    led = counted.filter(F.col("_n") > LARGE).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    led = led.select(F.xxhash64("node", "_part").alias("node"), "_first.cls", "_first.code")
    return stored(own.union(led)), over


def _lined(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node").select("node", "cls", "label", "code")


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, cls, label, code) of the nodes with two components or more."""
    marked = rows.join(labels, rows["cls"] == labels["_of"], "left").select("node", "cls", F.coalesce("root", "cls").alias("label"), "code")
    nodes = marked.groupBy("node").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
    return marked.join(nodes.select("node"), "node")


def _counted(members: DataFrame, kind: str, limit: float) -> DataFrame:
    """cls and the rows that its class is linked with, for classes (cls, root, n, vector) of the same component."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in each_group(batches, "key"):
            n, side = table["n"].to_numpy(), table["side"].to_numpy()
            unit = _matrix(table["_vector"].to_pylist(), kind)
            links = np.zeros(len(n), np.int64)
            if table["alone"][0].as_py():
                left = right = np.arange(len(n))
            else:
                left, right = np.flatnonzero(side == table["low"][0].as_py()), np.flatnonzero(side != table["low"][0].as_py())
            for start in range(0, len(left), 1_000):
                rows = left[start : start + 1_000]
                close = unit[rows] @ unit[right].T >= limit
                if left is right:
                    close[np.arange(len(rows)), rows] = False
                else:
                    links[right] += n[rows] @ close
                links[rows] += close @ n[right]
            yield pa.RecordBatch.from_arrays([table["cls"].combine_chunks(), pa.array(links)], names=["cls", "links"])

    per_block = F.greatest(F.lit(1), F.lit(MEMORY) / (8 / np.dtype(kind).itemsize * F.octet_length("_vector")))
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.first(per_block)).alias("_blocks"))
    dealt = members.join(sizes, "root").withColumn("side", F.pmod(F.xxhash64("cls"), "_blocks"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    low, high = F.least("side", "_other"), F.greatest("side", "_other")
    dealt = dealt.withColumns({"key": F.concat_ws("-", "root", low, high), "low": low, "alone": low == high})
    rows = dealt.repartition("key").sortWithinPartitions("key").select("key", "cls", "side", "low", "alone", "n", "_vector")
    return rows.mapInArrow(task, "cls long, links long")


def near_duplicates(vectors: DataFrame, limit: float = 0.98, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; links have a cosine of ``limit`` at least and equal labels."""
    element = vectors.schema[vector].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    id_type = vectors.schema[vec_id].dataType.simpleString()
    picked = vectors.select(F.col(vec_id).alias("_id"), F.col(label).cast("string").alias("_label"), F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>"))
    made = picked.mapInArrow(_vectors(kind), f"_id {id_type}, _group long, _digest binary, _vector binary")
    rows = stored(made.withColumns({"_row": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))
    sets = stored(rows.filter("_digest is not null").groupBy("_digest").agg(F.min("_row").alias("cls"), F.min("_id").alias("_least"), F.count(F.lit(1)).alias("n")))
    classes = rows.join(sets.select(F.col("cls").alias("_row"), "n"), "_row").select(F.col("_row").alias("cls"), "n", "_group", "_digest", "_vector")
    classes = stored(classes)
    codes = learnt(classes, kind, limit)
    spark = vectors.sparkSession
    root, links = spark.createDataFrame([], "_of long, root long"), spark.createDataFrame([], "cls long, links long")
    if codes:
        filed = stored(classes.select("cls", "_group", "_vector").mapInArrow(_filed(codes, kind), "table int, node long, cls long, code binary"))
        entries, over = _entries(filed)
        first = _lined(entries.withColumn("label", F.col("cls"))).mapInArrow(_pairs(codes.radius, True), "a long, b long").distinct()
        first = _confirmed(stored(first), classes, kind, limit)
        root = stored(components(first).select(F.col("node").alias("_of"), "root"))
        crossing = _mixed(entries, root)
        if not over.isEmpty():
            code = filed.filter("table = 0").select("cls", "code")
            crossing = crossing.union(_mixed(_blocks(over, root).join(code, "cls"), root))
        second = _lined(crossing).mapInArrow(_pairs(codes.radius, False), "a long, b long").distinct()
        second = _confirmed(stored(second), classes, kind, limit)
        joined = root.union(root.select("root", "root").distinct())  # a root is not listed as its own member
        members = classes.join(joined, classes["cls"] == joined["_of"]).select("cls", "root", "n", "_vector")
        links = _counted(members, kind, limit)
        sizes = classes.select("cls", "n")
        for one, other in (("a", "b"), ("b", "a")):
            links = links.union(second.join(sizes.withColumnRenamed("cls", other), other).select(F.col(one).alias("cls"), F.col("n").alias("links")))
        if not second.isEmpty():
            root = components(first.union(second)).select(F.col("node").alias("_of"), "root")
    total = links.groupBy("cls").agg(F.sum("links").alias("links"))
    named = sets.join(root, sets["cls"] == root["_of"], "left").join(total, "cls", "left")
    named = stored(named.select("_digest", "_least", F.coalesce("root", "cls").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    lowest = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = named.join(lowest, "root").select("_digest", "component_id", "n_links")
    # one row per class and partition meets the answer, and the rows of a partition then meet it
    met = rows.filter("_digest is not null").select("_digest", "_part").distinct().join(named, "_digest")
    out = rows.select("_id", "_digest", "_part").join(met, ["_digest", "_part"], "left")
    component = F.coalesce("component_id", "_id")
    return out.select(
        F.col("_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
    )
