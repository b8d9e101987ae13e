"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition makes one run: its digests with the smallest identifier and the
number of rows of each. Runs meet in binomial rounds: round r joins the runs whose numbers
agree after dropping the last FAN bits, so each round merges up to 2**FAN runs and keeps,
for each digest, the smallest of the smallest identifiers. The last round has one run.
Each round is an aggregation on (digest, run), so a text that a third of all rows hold
sends one row per run, and the digests of a run are spread over all tasks. The answer goes
back the same way: (digest, run) pairs learn the group, and documents join on (digest,
run), where no key has more rows than one input partition.

Digests are verified at every level: a group is keyed by sha256, byte length and xxhash64
of the text together, so a collision of one of them does not merge two texts.

Defined results: texts are equal when identical after lower-casing A-Z; null counts as
empty. "Smallest" follows ``keep``: the largest or the smallest doc_id; a null id comes
last, and of repeated rows with one id and text exactly one stays. Empty tables give empty
results; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import apart, ascii_lower, stored, whole

FAN = 5  # a round merges up to 2**FAN runs
KEY = ["_digest", "_bytes", "_hash"]


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Row number, id, run and digest of every row, stored, as they depend on the partitioning."""
    norm = ascii_lower(F.col(text))
    rows = docs.select(F.col(doc_id).alias("_id"), norm.alias("_text")).select(
        F.monotonically_increasing_id().alias("_row"),
        "_id",
        F.spark_partition_id().alias("_run"),
        F.sha2("_text", 256).alias("_digest"),
        F.octet_length("_text").alias("_bytes"),
        F.xxhash64("_text").alias("_hash"),
    )
    return stored(rows)


def _smallest(keep: str) -> tuple[Column, Column]:
    """The order of identifiers as an aggregate, and the one that stays."""
    if keep == "largest":
        return F.max(F.struct("_id", (-F.col("_row")).alias("_row"))), -F.col("_best._row")
    if keep == "smallest":
        return F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_row")), F.col("_best._row")
    raise ValueError("keep is 'largest' or 'smallest'")


def groups(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per distinct text of ``digests``: its key, the row that stays and the group's size."""
    first, stays = _smallest(keep)
    run = rows.groupBy(*KEY, "_run").agg(first.alias("_best"), F.count(F.lit(1)).alias("_n"))
    merge = F.max("_best") if keep == "largest" else F.min("_best")
    highest = rows.agg(F.max("_run")).first()[0] or 0
    for _ in range(-(-int(highest).bit_length() // FAN)):
        run = run.withColumn("_run", F.shiftright("_run", FAN)).groupBy(*KEY, "_run").agg(merge.alias("_best"), F.sum("_n").alias("_n"))
    return run.select(*KEY, F.col("_best._id").alias("keep_id"), stays.alias("_keep_row"), F.col("_n").alias("group_size"))


def membership(docs: DataFrame, keep: str = "largest", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row: doc_id, keep_id, group_size, kept and text_sha256."""
    rows = digests(docs, text, doc_id)
    merged = stored(groups(rows, keep))
    # the way down: a key has one row per run here, and one run's rows in the join after
    pairs = rows.select(*KEY, "_run").distinct().join(merged, KEY)
    return rows.join(pairs, [*KEY, "_run"]).select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, keep: str = "largest", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all columns.

    Documents meet the merged runs on key and id, so copies of one text are spread by id.
    Only where the id that stays is repeated with the same text, one of these rows is taken.
    """
    rows = digests(docs, text, doc_id)
    stays = stored(groups(rows, keep).select(*KEY, F.col("keep_id").alias("_id")))
    counted = rows.groupBy(*KEY, "_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = stored(stays.join(counted.drop("_n"), [stays[c].eqNullSafe(counted[c]) for c in [*KEY, "_id"]], "left_semi"))
    norm = ascii_lower(F.col("_words"))
    keyed = apart(docs, text, doc_id).withColumns({"_digest": F.sha2(norm, 256), "_bytes": F.octet_length(norm), "_hash": F.xxhash64(norm)})

    def meets(chosen: DataFrame, how: str, left: DataFrame = keyed) -> DataFrame:
        on = [left[c] == chosen[c] for c in KEY] + [left["_own"].eqNullSafe(chosen["_id"])]
        return left.join(chosen, on, how)

    kept = meets(stays, "left_semi")
    if not repeated.isEmpty():
        kept = meets(repeated, "left_anti", kept).unionByName(meets(repeated, "left_semi").dropDuplicates([*KEY, "_own"]))
    return whole(kept, docs.columns, text)
