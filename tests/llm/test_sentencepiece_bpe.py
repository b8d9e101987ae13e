import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from playtide.llm import queries, sentencepiece_bpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ids_of(words, text):
    return np.frombuffer(words.encode([text])[0], np.int32).tolist()


def test_agenda_equals_the_library_on_odd_texts(library):
    words, rng = sentencepiece_bpe.Vocabulary(MODEL), random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\t", ".", ",", "the", "ing", "▁", "é", " ", "😀", "<s>", "\x00", "0"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert ids_of(words, text) == library.encode(text), text
        assert words.decode(library.encode(text)) == library.decode(library.encode(text))


def test_both_agendas_agree(library):
    words = sentencepiece_bpe.Vocabulary(MODEL)
    some = ["▁" + "abcdefghij"[i % 7 :] * (1 + i % 3) for i in range(40)]
    assert words.many(sorted(some, key=len)) == [words.packed(w) for w in sorted(some, key=len)]


def test_a_difference_from_the_library_raises():
    words = sentencepiece_bpe.Vocabulary(MODEL)
    words.many = lambda parts: [b"\0\0\0\0" for _ in parts]
    with pytest.raises(ValueError, match="differ"):
        words.encode(["hello world"])


def test_ids_that_no_text_gives_decode_like_the_library(library):
    words, rng = sentencepiece_bpe.Vocabulary(MODEL), random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 1, 28705, 264]) for _ in range(rng.randrange(6))]
        assert words.decode(ids) == library.decode(ids), ids


def test_query_equals_the_library(spark, texts, library):
    rows = queries.op1_sentencepiece(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_round_trip_of_odd_rows(odd, spark):
    coded = sentencepiece_bpe.encode(odd, MODEL)
    assert coded.columns == [*odd.columns, "ids"]
    for r in sentencepiece_bpe.decode(coded, MODEL).collect():
        assert r.decoded == (r.text or "")
    assert sentencepiece_bpe.digests(odd.limit(0), MODEL).count() == 0
