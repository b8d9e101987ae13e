import duckdb
import numpy as np
import pandas as pd
import pytest

from playtide.llm import embedding_dedup as E
from playtide.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, cls long, _vector string, root int, n int"


@pytest.fixture(scope="module")
def table(spark):
    def build(rows, element="float"):
        full = [(i, None if e is None else [None if x is None else float(x) for x in e], label, 1, "x", 2, 3) for i, e, label in rows]
        return spark.createDataFrame(full, SCHEMA.replace("array<float>", f"array<{element}>")).repartition(3)

    return build


def plain(rows, kind=np.float32):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    units = {}
    for at, (i, e, label) in enumerate(rows):
        if label is None or e is None or not len(e) or any(x is None for x in e):
            continue
        x = np.array(e, kind).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            units[at] = (label, len(x), x / np.sqrt(x @ x))
    leader, links = list(range(len(rows))), [0] * len(rows)

    def top(k):
        while leader[k] != k:
            k = leader[k]
        return k

    at = list(units)
    for p, a in enumerate(at):
        for b in at[p + 1 :]:
            if units[a][:2] == units[b][:2] and units[a][2] @ units[b][2] >= 0.98:
                links[a] += 1
                links[b] += 1
                leader[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    out = [(i, links[k], least.get(top(k)), i is not None and i == least.get(top(k))) for k, (i, _, _) in enumerate(rows)]
    return sorted(out, key=str)


def planted(seed, alone=300, groups=40, hot=150, dims=48):
    """Vectors of three labels: single ones, groups of near copies, a hot group, exact copies and chains."""
    rng, rows = np.random.default_rng(seed), []

    def near(x, cosine):
        noise = rng.standard_normal(len(x))
        noise -= (noise @ x) / (x @ x) * x
        return cosine * x / np.sqrt(x @ x) + np.sqrt(1 - cosine**2) * noise / np.sqrt(noise @ noise)

    for _ in range(alone):
        rows.append((rng.standard_normal(dims), int(rng.integers(3))))
    for k in range(groups):
        x, label = rng.standard_normal(dims), int(rng.integers(3))
        rows.append((x, label))
        for _ in range(int(rng.integers(1, 5))):
            x = near(rows[-1][0] if k % 2 else x, float(rng.uniform(0.979, 0.999)))
            rows.append((x, label))
        rows.append((x * 3, (label + k) % 3))
    x = rng.standard_normal(dims)
    rows += [(near(x, float(rng.uniform(0.985, 0.9999))), 1) for _ in range(hot)]
    rows += [(x, 1)] * 30 + [(x, 2)] * 3
    order = rng.permutation(len(rows))
    return [(int(i) * 3 + 1, np.float32(e), label) for i, (e, label) in zip(order, rows)]


def found(df):
    got = E.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(scope="module")
def whole():
    rows = planted(1)
    return rows, plain(rows)


def test_rows_equal_brute_force(table, whole):
    rows, wanted = whole
    got = found(table(rows))
    assert len(got) == len(wanted) and [r[0] for r in got] == [r[0] for r in wanted]
    links = [sum(r[1] for r in rs) for rs in (got, wanted)]
    assert 0.998 * links[1] <= links[0] <= links[1]
    assert sum(a != b for a, b in zip(got, wanted)) <= 2


def test_small_blocks_and_entries_give_the_same(table, whole, monkeypatch):
    """Oversized entries are compared block against block, components in many blocks."""
    rows, wanted = whole
    monkeypatch.setattr(E, "LARGE", 12)
    monkeypatch.setattr(E, "MEMORY", 7 * 48 * 8)
    got = found(table(rows))
    assert sum(a != b for a, b in zip(got, wanted)) <= 2


def test_components_that_only_the_second_pass_joins(table, whole, monkeypatch):
    rows, wanted = whole
    monkeypatch.setattr(E, "_forest", lambda codes, radius: [(0, 1)])
    got = found(table(rows))
    assert [r[2:] for r in got] == [r[2:] for r in wanted] or sum(a[2] != b[2] for a, b in zip(got, wanted)) <= 2


def test_odd_rows(table):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1), (2, [], 1), (3, [0, 0], 1), (4, [1, None], 1), (5, [1, inf], 1), (6, [nan, 1], 1), (7, [1, 2], None)]
    rows += [(8, [1, 2], 1), (9, [1, 2], 1), (9, [1, 2], 1), (10, [1, 2, 0], 1), (11, [2, 4], 1), (12, [-1, -2], 1), (13, [1, 2], 2), (None, [1, 2], 1), (None, None, None)]
    rows += [(14, [0.0, 5], 3), (15, [-0.0, 5], 3), (16, [1e30, 1e30], 4), (17, [1e-30, 1e-30], 4)]
    assert found(table(rows)) == plain(rows)
    assert found(table(rows, "double")) == plain(rows, np.float64)
    assert found(table(rows[:0])) == []
    assert found(table(rows[:7])) == plain(rows[:7])


def test_long_vectors_are_folded(table):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6, E.WIDTH + 900))
    rows = [(k, np.float32(e), 1) for k, e in enumerate([*x, x[2] + 0.05 * x[0], x[4] * 2])]
    assert found(table(rows)) == plain(rows)


def test_codes_meet_pairs_at_the_limit():
    rng = np.random.default_rng(3)
    sample = rng.standard_normal((2000, 64))
    sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
    codes = E.Codes(sample, 0.98, 100_000)
    assert codes.substring == 12
    assert 0.4 < codes.signs(sample).mean() < 0.6  # balanced
    other = rng.standard_normal(sample.shape)
    other -= (other * sample).sum(axis=1, keepdims=True) * sample
    other = 0.98 * sample + np.sqrt(1 - 0.98**2) * other / np.sqrt((other**2).sum(axis=1, keepdims=True))
    group = np.zeros(len(sample), np.uint64)
    one, two = (codes.entries(codes.signs(v), group) for v in (sample, other))
    assert (one == two).any(axis=1).mean() > 0.99
    assert len(np.unique(one[:, 0])) > 1000


def test_quantisation_loses_less_than_a_random_rotation():
    rng = np.random.default_rng(4)
    sample = rng.standard_normal((600, 16)) * np.linspace(3, 0.3, 16) + 0.5
    sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
    codes = E.Codes(sample, 0.98, 600)
    flat = (sample - codes.mean) @ codes.axes
    loss = lambda turn: ((np.sign(flat @ turn) - flat @ turn) ** 2).sum()
    random = np.linalg.qr(rng.standard_normal((16, 16)))[0]
    assert loss(codes.turns[0]) < loss(random) and loss(codes.turns[0]) < loss(np.eye(16))


def test_sql_equals_brute_force():
    rows = planted(5, alone=60, groups=15, hot=20)
    frame = pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows], "label": [r[2] for r in rows]})
    con = duckdb.connect()
    con.register("embeddings", frame)
    assert sorted(con.sql(queries.OP13).fetchall(), key=str) == plain(rows)
