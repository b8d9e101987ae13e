import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from playtide.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_equal_the_library():
    words, library, rng = packing.Words(PATH), Tokenizer.from_file(PATH), random.Random(5)
    parts = ["a", "b", " ", " ", "\n", "\t", "'s", "é", "1", ".", ",", "!", "\x1f", "　", "\r", "<|endoftext|>", "th", "\x85"]
    many = ["a <|endoftext|> b"]
    for _ in range(10_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        many.append(text)
        assert np.frombuffer(words.encode([text])[0], np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text
    found = [np.frombuffer(p, np.uint32).tolist() for p in words.encode(many)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in many]
    assert found[0] == [64, 220, 50256, 275]  # the string of an added token is that token


def best_possible(lengths, size):
    """Fewest bins by trying every bin for every piece."""
    lengths, least = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, bins):
        if len(bins) >= least[0]:
            return
        if i == len(lengths):
            least[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= size and bins[j] not in bins[:j]:
                place(i + 1, [*bins[:j], bins[j] + lengths[i], *bins[j + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return least[0]


@pytest.mark.parametrize("seed", range(25))
def test_small_plans_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 11))]
    found = packing.plan(dict(Counter(lengths)), 20)
    assert Counter(s for f, t in found for s in f * t) == Counter(lengths)
    assert all(sum(f) <= 20 for f, _ in found)
    assert sum(t for _, t in found) == best_possible(lengths, 20)


@pytest.mark.parametrize("low,high", [(1, 2048), (1, 300), (700, 2048), (1, 3), (2048, 2048)])
def test_large_plans_come_near_the_bound(low, high):
    rng = random.Random(1)
    counts = Counter(rng.randint(low, high) for _ in range(20_000))
    found = packing.plan(dict(counts), 2048)
    array = np.zeros(2049, np.int64)
    for k, v in counts.items():
        array[k] = v
    used, bound = sum(t for _, t in found), packing.lower_bound(array, 2048)
    assert Counter({s: sum(f.count(s) * t for f, t in found) for s in counts}) == counts
    assert bound <= used <= 1.01 * bound + 1


def check_rows(rows, size=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(bins)


def test_query_equals_the_tokenizer(spark, texts):
    library = Tokenizer.from_file(PATH)
    rows = queries.op3_packing(spark, "/root/testdata/sf0.01").collect()
    found, by_doc = check_rows(rows), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == texts.keys()
    for doc, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(math.ceil(len(ids) / 2048)))
        at = 0
        for r in own:
            assert r.start == at and (r.length == 2048 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert found <= 1.01 * math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_odd_rows_are_packed_one_by_one(odd):
    rows = packing.pack(odd, PATH).collect()
    check_rows(rows)
    assert Counter(r.doc_id for r in rows if r.piece == 0)[4] == 2
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    assert packing.pack(odd.limit(0), PATH).count() == 0


def test_a_length_that_all_rows_share(spark):
    df = spark.range(5_000).selectExpr("id AS doc_id", "'a' AS text").repartition(7)
    assert check_rows(packing.pack(df, PATH).collect()) == math.ceil(5_000 / 1_024)


def test_ids_can_be_kept(docs):
    row = packing.pieces(docs((1, "hello world")), PATH, ids=True).first()
    assert row.ids[-1] == 0 and len(row.ids) == row.length
