from collections import Counter, defaultdict

import numpy as np
from conftest import LOWER

from playtide.llm import near_dedup


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = t.translate(LOWER).encode().split()
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute_components(texts, limit=85):
    sets = shingle_sets(texts)
    holders, leader = defaultdict(list), {i: i for i in sets}

    def find(x):
        while leader[x] != x:
            x = leader[x]
        return x

    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= limit * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                leader[b] = a
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}


def test_small_tables_equal_brute_force(whole, texts):
    assert found(whole) == brute_components(texts)


def test_a_large_group_of_near_copies(docs):
    """A hub, 300 copies of it with one or two words changed, and clean texts that share a passage."""
    rng = np.random.RandomState(4)
    word = lambda: f"w{rng.randint(10**6)}"
    hub = [word() for _ in range(200)]
    rows, passage = [(0, " ".join(hub))], [word() for _ in range(40)]
    for i in range(1, 301):
        copy = list(hub)
        for at in rng.choice(200, 1 + i % 2, replace=False):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join([*passage, *(word() for _ in range(100))])) for i in range(301, 500)]
    result = found(docs(*rows))
    assert result == brute_components(dict(rows))
    assert len({c for i, (_, c) in result.items() if i <= 300}) == 1


def test_nodes_too_large_for_a_task(docs, monkeypatch):
    """With tiny limits all levels and parts are used; the copies stay one component."""
    monkeypatch.setattr(near_dedup, "LARGE", 20)
    monkeypatch.setattr(near_dedup, "LEVELS", 3)
    hub = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*hub[: i % 120], f"x{i}", *hub[i % 120 + 1 :]])) for i in range(150)]
    assert found(docs(*rows)) == brute_components(dict(rows))


def test_estimates_are_close():
    a = near_dedup.shingles(" ".join(f"w{i}" for i in range(2000)))
    b = near_dedup.shingles(" ".join(f"w{i}" for i in range(200, 2000)))
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near_dedup.minhashes(a) == near_dedup.minhashes(b)).mean() - truth) < 0.12


def test_odd_rows(odd):
    rows = near_dedup.near_duplicates(odd).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(rows) == 11
    assert [by[i][0].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 29_996]
    assert [r.component_id for r in by[1] + by[2] + by[3]] == [1, 2, 3]
    assert {r.component_id for r in by[4] + by[5] + by[None]} == {4} and {r.component_id for r in by[6] + by[7]} == {6}
    assert not by[None][0].kept and by[6][0].kept and not by[7][0].kept
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 9]
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_one_row_of_a_component_stays_where_its_id_is_repeated(docs):
    """Near copies and equal rows with one id; the same id in another component is another row."""
    base = [f"w{i}" for i in range(100)]
    near = [*base[:99], "other"]
    rows = [(1, " ".join(base)), (1, " ".join(near)), (2, " ".join(near)), (1, " ".join(base)), (1, "quite another text of some words")]
    kept = [(r.doc_id, r.text.startswith("quite")) for r in near_dedup.deduplicated(docs(*rows)).collect()]
    assert sorted(kept) == [(1, False), (1, True)]


def test_components_of_a_long_path(spark):
    df = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {(r.node, r.root) for r in near_dedup.components(df).collect()} == {(i, 0) for i in range(1, 61)}


def test_lower_limit_keeps_pairs_on_their_way():
    """Pairs at 0.80 that branch down 15 levels meet in a node of one of the trees."""
    rng, pairs = np.random.RandomState(7), 1000
    one = rng.randint(0, 2**32, (pairs, near_dedup.COORDINATES), np.uint64).astype(np.uint32)
    other = np.where(rng.rand(*one.shape) < 0.80, one, ~one)
    met, share = np.zeros(pairs, bool), near_dedup._second(80)
    for tree in range(near_dedup.LOWER_TREES):
        whose, nodes = np.arange(pairs), near_dedup.mix(np.full(pairs, tree + 1, np.uint64))
        for _ in range(15):
            rows, child = near_dedup._children(nodes, one[whose], share)
            twin = near_dedup._children(nodes, other[whose], share)[1]
            whose, nodes = whose[rows[child == twin]], child[child == twin]
        met[whose] = True
    assert met.mean() > 0.99


def test_close_pairs_of_a_template_too_large_for_a_task(docs, monkeypatch):
    """Pages of one template (0.82 alike), each with a twin (0.97): pairs that are not close to the node's first class."""
    monkeypatch.setattr(near_dedup, "LARGE", 20)
    monkeypatch.setattr(near_dedup, "LEVELS", 1)
    template, rng, rows = [f"w{i}" for i in range(400)], np.random.RandomState(3), []
    for i in range(60):
        page = list(template)
        for at in rng.choice(np.arange(10, 380, 10), 4, replace=False):
            page[at] = f"x{i}y{at}"
        twin = [*page[:395], f"z{i}", *page[396:]]
        rows += [(i, " ".join(page)), (1000 + i, " ".join(twin))]
    assert found(docs(*rows)) == brute_components(dict(rows))
