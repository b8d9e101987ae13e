"""The training-data pipeline: five stages over the documents, each one operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm import exact_dedup, langid, near_dedup, packing, pii
from playtide.llm.common import apart, stored, whole

NEAR = 80  # hundredths of similarity from which documents are near duplicates


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a predicted language: only a null text or one without letters goes.

    Where no row names a language, nothing can be told apart and all texts with a letter stay.
    Other columns stay as they are, also those named like the prediction's; repeated rows are
    judged one by one; an empty table stays empty.
    """
    network = langid.train(docs.filter(~langid.held_out()))
    if not network.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(apart(docs, "text", "doc_id"), network, "_words")
    return whole(found.filter(F.col("lang_pred") != "und"), docs.columns, "text")


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text: that with the largest doc_id; null is empty, a repeated row stays once."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id.

    Texts without a word are no duplicates; a repeated id stays once in its group; a row
    without an id stays if no row of its group has one.
    """
    return near_dedup.deduplicated(docs, limit=NEAR)


def private(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with personal data replaced, and n_chars of the new text; a null text stays null."""
    clean = pii.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents with their sequences; a null or empty text is one piece, its end id."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact dedup", exact),
    ("near dedup", near),
    ("personal data", private),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained network, minhashes and a search are not SQL


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
