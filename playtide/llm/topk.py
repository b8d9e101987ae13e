"""Exact top-k search by an impact-ordered, score-at-a-time index.

Vectors of whole numbers are dealt into blocks. Within a block every dimension is a list of
postings (positions of vectors) ordered by quantised value, ``LEVELS`` segments of equal width;
a block of n vectors has n postings per dimension, whatever they hold. For a query the
impact of a segment is the query's component times the segment's distance from the value
that scores least there, so the segments of a dimension come in descending impact from one
end or the other. Segments are processed score at a time, in ``ROUNDS`` classes of
descending impact: a round adds the postings of its own segments to the sums of their
vectors, and no posting is read twice. After each round every vector has a lower and an
upper bound of its score: processed postings count with the greatest value of their segment,
for the lower bound less the width of all segments together, each dimension not yet met with
what the round's limit still allows. A query stops only on
proof: when the vectors whose upper bound reaches its k-th best lower bound are no more
than ``FEW``, or when no segment is left. These possible members are rescored exactly in
whole numbers, so the result is exact wherever a query stops. The k best of each block meet
in a second step.

Queries are a stated share of the rows; each block of vectors meets each block of queries
once, and both blocks are bounded. Blocks of queries are as large as those of vectors, so
that neither side is copied oftener than the other needs.

Defined results: vectors that are null, empty, or hold a null or a component that is not
finite take no part, neither as queries nor as candidates; a shorter vector counts as
filled with zeros; a query does not find its own row but does find other rows with its id;
ties go to the smaller vec_id; with fewer candidates than k all are returned; a null id
takes part as a candidate, last among ties, and is no query; where the dimensions times the
square of the largest component reach 2^52 bounds are no proof and all candidates are rescored,
from 2^63 on, where a score may not fit its type, an OverflowError is raised.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm.common import stored

LEVELS = 64  # segments of a dimension's list
ROUNDS = 4  # classes of impact
FEW = 64  # possible members that are rescored at once
BLOCK = 4_096  # vectors of a block
QUERIES = 4_096  # queries of a block


def whole(vector: Column) -> Column:
    """floor(1024 * x) of each component; null where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(vector) > 0) & ~bad, F.transform(x, lambda v: F.floor(v * 1024)))


class Index:
    """Segments of a block: for each dimension the vectors in the order of their levels, and the levels' value ranges."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n, dims = vectors.shape
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        width = np.maximum(1, -(-(high - low + 1) // LEVELS))
        level = ((vectors - low) // width).astype(np.int64)
        self.low = low[:, None] + np.arange(LEVELS) * width[:, None]  # least value of a segment
        self.high = np.minimum(self.low + width[:, None] - 1, high[:, None])
        self.low = np.minimum(self.low, high[:, None])
        self.postings = np.ascontiguousarray(np.argsort(level, axis=0, kind="stable").T)
        self.sizes = np.bincount((np.arange(dims) * LEVELS + level).ravel(), minlength=dims * LEVELS).reshape(dims, LEVELS)
        self.ends = np.concatenate([np.zeros((dims, 1), np.int64), self.sizes.cumsum(axis=1)], axis=1)

    def possible(self, query: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """Positions among ``others`` that may be in the ``k`` best of a query, and the postings read to prove it."""
        dims, n = self.postings.shape
        if len(others) <= k:
            return others, 0
        a, b = query[:, None] * self.low.astype(np.float64), query[:, None] * self.high.astype(np.float64)
        least, most = np.minimum(a, b), np.maximum(a, b)
        floor = least.min(axis=1, keepdims=True)  # what every vector has at least; left out of both bounds
        impact = most - floor
        spread = (most - least).max(axis=1).sum()  # a vector's greatest and least possible score are no farther apart
        rising, each = query > 0, np.arange(dims)
        upper, met, read = np.zeros(n), np.zeros(n, np.int64), 0
        done, before = np.zeros(impact.shape, bool), np.zeros(dims, np.int64)
        limits = np.ceil(np.quantile(impact, 1 - np.arange(1, ROUNDS + 1) / ROUNDS))
        limits[-1] = 0
        reach = others
        for limit in limits:
            fresh = (impact >= limit) & ~done
            done |= fresh
            upto = before + fresh.sum(axis=1)  # segments met, from the end where impacts are greatest
            start = np.where(rising, self.ends[each, LEVELS - upto], self.ends[each, before])
            stop = np.where(rising, self.ends[each, LEVELS - before], self.ends[each, upto])
            before = upto
            whose = np.concatenate([self.postings[d, i:j] for d, (i, j) in enumerate(zip(start.tolist(), stop.tolist()))])
            read += len(whose)
            upper += np.bincount(whose, np.repeat(impact[fresh], self.sizes[fresh]), n)
            met += np.bincount(whose, minlength=n)
            found = upper[others]
            sure = np.partition(found, len(found) - k)[len(found) - k] - spread
            reach = others[found + limit * (dims - met[others]) >= sure]
            if len(reach) <= max(FEW, k):
                break
        return reach, read


def best(index: Index, ids: np.ndarray, own: np.ndarray, queries: np.ndarray, own_query: np.ndarray, k: int, proof: bool = True) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query, members, scores): the k best of the block for each query, ties by id; without ``proof`` all are rescored."""
    out = []
    for q, query in enumerate(queries):
        reach = np.flatnonzero(own != own_query[q])
        if proof:
            reach, _ = index.possible(query, reach, k)
        exact = index.vectors[reach] @ query
        order = np.lexsort((ids[reach], -exact))[:k]
        out.append((q, reach[order], exact[order]))
    return out


NO_ID = 2**63 - 1  # stands for a null id among ties


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the highest inner product for each query row."""
    rows = vectors.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("id"), whole(F.col(vector)).alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stored(rows.filter("x is not null").withColumn("row", F.monotonically_increasing_id()))
    largest = F.max(F.array_max(F.transform("x", lambda v: F.abs(v.cast("double")))))
    total, asked, dims, largest = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(largest, F.lit(0.0))).first()
    if dims * largest**2 >= 2.0**63:
        raise OverflowError(f"components up to {largest / 1024:g} in {dims} dimensions: a score may not fit 64 bits")
    proof = dims * largest**2 < 2.0**52  # below it the bounds are whole numbers that doubles hold exactly
    blocks, sets = max(1, -(-total // BLOCK)), max(1, -(-asked // QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    index = rows.select("id", "x", "row", deal(blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set"))
    asks = rows.filter("asks").select("id", "x", "row", deal(sets).alias("set"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if held.empty or queries.empty:
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "row": [], "score": []}).astype("int64")
        ids, own = held["id"].to_numpy(np.int64), held["row"].to_numpy()
        own_query, query_ids = queries["row"].to_numpy(), queries["id"].to_numpy(np.int64)
        found = best(Index(_matrix(held["x"], dims)), ids, own, _matrix(queries["x"], dims), own_query, k, proof)
        whose = np.concatenate([np.full(len(m), q) for q, m, _ in found]).astype(np.int64)
        members, scores = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        return pd.DataFrame({"query": own_query[whose], "query_id": query_ids[whose], "vec_id": ids[members], "row": own[members], "score": scores})

    schema = "query long, query_id long, vec_id long, row long, score long"
    parts = index.groupBy("block", "set").cogroup(asks.groupBy("block", "set")).applyInPandas(search, schema)
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = parts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    known = F.when(F.col("vec_id") != NO_ID, F.col("vec_id"))
    return ranked.select("query_id", "rank", known.alias("vec_id"), "score")
