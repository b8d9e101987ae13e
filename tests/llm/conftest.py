import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
EXTRA = {"_set": "x", "node": "1", "_hash": "h", "_digest": "d", "_bytes": "b", "_key": "k", "_text": "t", "_email": "e", "_term": "m", "_id": "i", "_words": "w", "_rest": "r", "_own": "o", "score": "s", "lang_pred": "l"}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names operators use inside."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), *EXTRA.values()) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "  "), (4, "same text"), (4, "same text"), (5, "SAME text"), (None, "same text"), (6, long), (7, long + " end"), (8, "1234567"), (9, "é\n\t ü")]
    return docs(*rows)


@pytest.fixture(scope="session")
def whole(spark):
    """The documents of the small tables."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(whole):
    return {r.doc_id: r.text or "" for r in whole.select("doc_id", "text").collect()}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
