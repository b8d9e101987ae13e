import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.llm import topk


def brute(rows, k):
    kept = [(i, n, [math.floor(1024 * x) for x in v]) for n, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, n, q in kept:
        if i is not None and i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j if j is not None else math.inf, m) for j, m, v in kept if m != n)
            out |= {(i, r + 1, None if j == math.inf else j, -s) for r, (s, j, _) in enumerate(scored[:k])}
    return out


def run(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = topk.top_k(df, F.col("vec_id") % 100 == 0, k)
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()}


def test_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 150)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.RandomState(1)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(0, 0.1, (900, 24)))]
    assert run(spark, rows) == brute(rows, 10)


def test_it_stops_on_proof():
    """Clear winners leave few possible members before all segments are read, and they are the right ones."""
    rng = np.random.RandomState(2)
    vectors = rng.randint(-5, 6, (3000, 16))
    vectors[:20] = rng.randint(200, 300, (20, 16))
    queries = np.full((2, 16), 50)
    found = topk.best(topk.Index(vectors), np.arange(3000), np.arange(3000), queries, np.array([-1, -1]), 10)
    exact = vectors @ queries[0]
    assert all((m == np.lexsort((np.arange(3000), -exact))[:10]).all() for _, m, _ in found)
    reach, read = topk.Index(vectors).possible(queries[0], np.arange(3000), 10)
    assert set(range(20)) >= set(found[0][1].tolist()) <= set(reach.tolist()) and len(reach) <= topk.FEW
    assert 0 < read < 3000 * 16 / 4  # most postings are never read


@pytest.mark.parametrize("dims", [1, 7, 1536])
def test_possible_members_hold_the_best_and_no_posting_is_read_twice(dims):
    rng = np.random.RandomState(dims)
    vectors = rng.randint(-40, 41, (400, dims))
    vectors[5:9] = vectors[5]
    vectors[:, 0] = 3  # a dimension of one value
    index = topk.Index(vectors)
    assert index.postings.nbytes == 8 * vectors.size
    for query in [*rng.randint(-40, 41, (12, dims)), np.zeros(dims, int)]:
        others = np.delete(np.arange(400), rng.randint(400))
        reach, read = index.possible(query, others, 10)
        exact = vectors[others] @ query
        kth = np.sort(exact)[-10]
        assert set(others[exact >= kth].tolist()) <= set(reach.tolist()) <= set(others.tolist())
        assert read <= vectors.size


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (100, [1.0, 0.5]), (6, [1.0, 0.5]), (6, [1.0, 0.5]), (None, [1.0, 0.5]), (7, [-1.0, 0.25])]
    assert run(spark, rows, 4) == brute(rows, 4)
    assert run(spark, rows[:1]) == set()
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_large_components_are_exact_or_refused(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    rng = np.random.RandomState(4)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(0, 100_000, (150, 12)))]
    assert run(spark, rows) == brute(rows, 10)
    with pytest.raises(OverflowError):
        run(spark, [(0, [1e11, 1.0]), (1, [2.0, 1e11])])
