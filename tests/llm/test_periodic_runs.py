import hashlib
import zlib
from fractions import Fraction

import numpy as np

from playtide.llm import periodic_runs as P


def plain_runs(x):
    """All runs by extending every place under every period."""
    found = {}
    for p in range(1, len(x) // 3 + 1):
        i = 0
        while i + p < len(x):
            j = i
            while j + p < len(x) and x[j] == x[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def plain_digests(doc_id, text):
    words = [w for w in (text or "").encode().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    h = zlib.crc32((str(doc_id) if doc_id is not None else "").encode())
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, m, p in runs for i in range(s + p, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def strings(rng, count):
    """Random texts over few letters, some of them periodic with errors, powers of powers and borders."""
    for k in range(count):
        letters = int(rng.integers(1, 5))
        x = rng.integers(0, letters, int(rng.integers(0, 130)))
        if k % 3 == 0:
            x = np.tile(rng.integers(0, letters + 1, int(rng.integers(1, 14))), 14)[: int(rng.integers(20, 140))]
            x[rng.integers(0, len(x), k % 4)] = 9
        if k % 7 == 0:
            inner = np.tile(rng.integers(0, 3, 3), 9)
            x = np.concatenate([x, np.tile(np.append(inner, 7), 4), x])
        yield x.astype(np.int64)


def test_runs_equal_brute_force():
    rng = np.random.default_rng(5)
    documents = list(strings(rng, 400))
    found = P.runs(documents)
    assert sum(map(len, found)) > 200
    for words, own in zip(documents, found):
        assert own == plain_runs(words.tolist())
    assert P.runs([documents[3]]) == [found[3]]  # alone as in a batch


def test_extensions_equal_direct_comparison():
    rng = np.random.default_rng(6)
    for _ in range(30):
        x = np.concatenate([[100], *strings(rng, 3), [101]])
        symbols = np.unique(x, return_inverse=True)[1]
        a, b = np.sort(rng.integers(1, len(x) - 1, (2, 200)), axis=0)
        a, b = a[a < b], b[a < b]
        right, left = P.extensions(symbols, int(symbols.max()) + 1, a, b)
        for i, j, r, back in zip(a, b, right, left):
            assert r == next(k for k in range(len(x)) if j + k >= len(x) or x[i + k] != x[j + k])
            assert back == next(k for k in range(len(x)) if i - 1 - k < 0 or x[i - 1 - k] != x[j - 1 - k])


def test_the_grammar_is_used_up_to_long_extensions():
    x = np.tile(np.arange(37), 3000)
    assert P.runs([x]) == [[(0, len(x), 37)]]
    x[50_000] = 99
    assert P.runs([x]) == [[(0, 50_000, 37), (50_001, len(x) - 50_001, 37)]]


def test_grids_in_blocks_meet_the_same_runs(monkeypatch):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.integers(0, 50, 700), np.tile(rng.integers(0, 50, 90), 5), np.zeros(40, int)])
    whole = P.runs([x])
    monkeypatch.setattr(P, "HELD", 8)
    monkeypatch.setattr(P, "POINTS", 100)
    assert P.runs([x]) == whole == [plain_runs(x.tolist())]


def test_digests_equal_brute_force(spark, docs):
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(f"w{w}" for w in x)) for k, x in enumerate(strings(rng, 150))]
    rows += [(1000 + k, "a b\tc\x0bd\x0ce\rf\n" * k) for k in range(40)]
    found = sorted(map(tuple, P.digests(docs(*rows)).collect()))
    assert found == sorted(plain_digests(*r) for r in rows)
    assert any(r[1] > 1 for r in found)


def test_odd_rows(odd):
    found, rows = P.digests(odd).collect(), odd.select("doc_id", "text").collect()
    assert len(found) == len(rows) and set(f.doc_id for f in found) == set(r.doc_id for r in rows)
    short = {r.doc_id: r.text for r in rows if len(r.text or "") < 1000}
    assert all(tuple(f)[1:] == plain_digests(f.doc_id, "same text")[1:] for f in found if f.doc_id in (4, None))
    assert all(tuple(f) == plain_digests(f.doc_id, short[f.doc_id]) for f in found if f.doc_id in short)
    assert P.digests(odd.limit(0)).collect() == []
    assert P.digests(odd).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_and_texts_without_them(docs):
    rows = docs((1, "x " + "a b " * 20 + "y"), (2, "no run here"), (None, None))
    assert [tuple(r) for r in P.periodic_runs(rows).collect()] == [(1, 1, 40, 2)]
    assert sorted(map(tuple, P.without_runs(rows).collect()), key=str) == sorted([(1, "x a b y"), (2, "no run here"), (None, "")], key=str)


def test_given_documents(whole, texts):
    sample = {i: t for i, t in texts.items() if len(t) < 2500}
    found = {r.doc_id: tuple(r) for r in P.digests(whole).collect()}
    assert len(found) == len(texts)
    assert all(found[i] == plain_digests(i, t) for i, t in sample.items())
