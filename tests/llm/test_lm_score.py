import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import LOWER

from playtide.llm import lm_score, queries


def test_base_and_counts_equal_brute_force(spark, texts):
    tokens = {i: [*t.translate(LOWER).encode().split(), b" "] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = Counter(w for i in tokens if not held[i] for w in tokens[i])
    n, v = sum(c.values()), len(c)
    rows = queries.op6_lm_score(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
        assert r.score < 0


def brute_score(counts, text):
    """log10 probability byte by byte from counts by context."""
    total = 0.0
    whole = lm_score.LEAD + text + lm_score.END
    for at in range(lm_score.ORDER, len(whole)):
        seen, p = set(), 1.0
        for k in range(lm_score.ORDER, -1, -1):
            there = {s: c for s, c in counts[k].get(whole[at - k : at], {}).items() if s not in seen}
            if not there:
                continue
            size = sum(there.values())
            if whole[at] in there:
                p *= (there[whole[at]] - 0.5) / size
                break
            p *= 0.5 * len(there) / size
            seen |= there.keys()
        else:
            p /= 256 - len(seen)
        total += math.log10(p)
    return total


def brute_counts(train):
    counts = [defaultdict(Counter) for _ in range(lm_score.ORDER + 1)]
    for text in train:
        whole = lm_score.LEAD + text + lm_score.END
        for at in range(lm_score.ORDER, len(whole)):
            for k in range(lm_score.ORDER + 1):
                counts[k][whole[at - k : at]][whole[at]] += 1
    return counts


def small_trie(train):
    keys = np.concatenate([k for k, _ in lm_score.grams(train, 7)])
    keys, n = lm_score._summed(keys, np.ones(len(keys)))
    return lm_score.trie_of([lm_score.shorter(keys, n, k) for k in range(lm_score.LOW + 1)], keys, n)


def scores(trie, texts, piece=5):
    out = np.zeros(len(texts))
    for keys, owner in lm_score.grams(texts, piece):
        np.add.at(out, owner, trie.log10(keys))
    return out


def test_trie_equals_brute_force():
    train = [b"the cat sat on the mat", b"a cat and the hat", b"", b"x  y"]
    counts, trie = brute_counts(train), small_trie(train)
    texts = [b"the cat", b"zebra  the", b"", b"that at\nhat"]
    assert scores(trie, texts) == pytest.approx([brute_score(counts, t) for t in texts])


@pytest.mark.parametrize("hot", [0, 500, 2**21])
def test_scores_of_the_operator_equal_a_plain_trie(spark, texts, monkeypatch, hot):
    """With no gram in the cache, with some and with all: messages and cache give the same."""
    monkeypatch.setattr(lm_score, "HOT_GRAMS", hot)
    monkeypatch.setattr(lm_score, "BUCKET", 10_000)
    some = dict(list(texts.items())[:120])
    docs = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(3)
    low = {i: t.translate(LOWER).encode() for i, t in some.items()}
    counts = brute_counts([t for i, t in low.items() if zlib.crc32(str(i).encode()) % 10])
    found = {r.doc_id: r.score for r in lm_score.scored(docs).collect()}
    assert found == pytest.approx({i: brute_score(counts, t) for i, t in low.items()})


def test_order_of_words_counts(spark):
    """Contexts go over spaces: a shuffled text scores lower than the same words in a known order."""
    line = "one two three four five six seven eight nine ten "
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10]
    out = next(i for i in range(200) if not zlib.crc32(str(i).encode()) % 10)
    rows = [(i, line * 3) for i in ids[:20]] + [(out, line * 2), (out, "nine one four ten three seven two six eight five " * 2)]
    found = {r.score for r in lm_score.scored(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()}
    assert min(found) < 3 * max(found)


def test_probabilities_of_a_context_sum_to_one():
    trie = small_trie([b"the cat sat on the mat", b"a cat and the hat"])
    for context in (b"   the", b"    ca", b"zzzzzz", b"      "):
        head = int.from_bytes(context[-lm_score.ORDER :], "big") << 8
        p = 10 ** trie.log10(np.array([head + s for s in range(256)], np.uint64))
        assert p.sum() == pytest.approx(1)


def test_odd_rows(odd):
    rows = lm_score.scored(odd).collect()
    assert len(rows) == 11 and all(r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lm_score.scored(odd.limit(0)).count() == 0
    untrained = lm_score.scored(odd.filter("doc_id IN (2) AND crc32(CAST(doc_id AS STRING)) % 10 = 0"))
    assert all(r.train_tokens == 0 for r in untrained.collect())


def differing(size, seed):
    """A text of random bytes, whose grams nearly all differ."""
    return bytes(np.random.RandomState(seed).randint(0x21, 0x7F, size, np.uint8)).decode()


def batches_of(texts):
    for t in texts:
        yield pa.RecordBatch.from_pydict({"text": [t], "held_out": [False]})


def test_counting_holds_little():
    """Counts that a task holds are merged by ranges instead of being sorted anew all at once."""
    texts = [differing(1_500_000, i) for i in range(6)]
    tracemalloc.start()
    try:
        sent = sum(len(k) // 8 for r in lm_score._counting(8)(batches_of(texts)) for k in r["keys"].to_pylist())
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sent > 8_000_000 and peak < 300e6


@pytest.mark.parametrize("sent", [300, 4_000_000])
def test_counts_are_whole_however_they_are_sent(monkeypatch, sent):
    monkeypatch.setattr(lm_score, "SENT", sent)
    monkeypatch.setattr(lm_score, "MERGED", 64)
    monkeypatch.setattr(lm_score, "STRIDE", 4)
    texts = ["the cat sat on the mat " * 5, differing(900, 1), "", "a cat and the hat", differing(900, 1), "é"]
    packed = sorted(((r["kind"][0].as_py(), r["bucket"][0].as_py(), r["keys"][0].as_py(), r["counts"][0].as_py()) for r in lm_score._counting(5)(batches_of(texts))), key=lambda r: r[:2])
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*packed)], names=["kind", "bucket", "keys", "counts"])
    found = {"word": Counter(), "gram": Counter()}
    for row in lm_score._sums([rows.slice(0, 3), rows.slice(3)]):
        (r,) = row.to_pylist()
        keys, counts = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)
        assert (np.diff(keys.astype(object)) > 0).all() and (r["total"], r["distinct"]) == (counts.sum(), len(keys))
        found[r["kind"]].update(dict(zip(keys.tolist(), counts.tolist())))
    raw = [t.encode().lower() for t in texts]
    assert found["gram"] == Counter(np.concatenate([k for k, _ in lm_score.grams(raw)]).tolist())
    assert found["word"] == Counter(lm_score.tokens(raw)[0].tolist())
    assert (len(packed) > 10) == (sent == 300)
