"""User-song matrix, ids, negative samples and splits for implicit feedback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from playtide.functions.columns import hash_id, stable_hash, stable_uniform
from playtide.operators.listening import plays
from playtide.operators.scale import cut_lineage, global_positions


def interaction_matrix(df: DataFrame, min_plays: int = 2) -> DataFrame:
    """Plays per (userId, song, artist) of active users and songs.

    Both activity limits look at the totals before any filtering. The counts are
    stored once, and so are the inactive users and songs, which have fewer than
    ``min_plays`` plays each: while they are few, they are broadcast on their stored
    size and the matrix is filtered where it lies; beyond that adaptive execution
    splits hot keys of the anti-joins.
    """
    matrix = cut_lineage(
        plays(df, "strict").groupBy("userId", "song", "artist").agg(F.count(F.lit(1)).alias("play_count"))
    )

    def inactive(key: str) -> DataFrame:
        totals = matrix.groupBy(key).agg(F.sum("play_count").alias("_plays"))
        return cut_lineage(totals.filter(F.col("_plays") < min_plays).select(key))

    kept = matrix.join(inactive("userId"), "userId", "left_anti").join(inactive("song"), "song", "left_anti")
    return kept.select("userId", "song", "artist", "play_count")


def matrix_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """A10: users, songs, interactions, sparsity."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    counted = df.agg(
        distinct("userId").alias("users"),
        distinct("song").alias("songs"),
        F.count(F.lit(1)).alias("interactions"),
    )
    cells = F.col("users").cast("double") * F.col("songs")
    return counted.withColumn("sparsity", F.when(cells > 0, 1 - F.col("interactions") / cells))


def hash_ids(df: DataFrame) -> DataFrame:
    """M1: indexes by hashing. Names may share an index; ``dense_ids`` never does that."""
    return df.withColumns({"user_idx": hash_id(F.col("userId")), "song_idx": hash_id(F.col("song"))})


def id_mapping(df: DataFrame, idx: str, name: str) -> DataFrame:
    """M2: one name per index, the smallest when several share it."""
    return df.groupBy(idx).agg(F.min(name).alias(name))


def dense_ids(df: DataFrame, col: str, idx: str) -> DataFrame:
    """Consecutive ids 0..n-1 in sorted order of the distinct values."""
    names = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return global_positions(names, [col], idx).select(col, F.col(idx).cast("int").alias(idx))


def encode_interactions(matrix: DataFrame, users: DataFrame, songs: DataFrame) -> DataFrame:
    """Add both indexes and the implicit label 1.0."""
    return matrix.join(users, "userId").join(songs, "song").select(
        "userId", "song", "artist", "user_idx", "song_idx", "play_count", F.lit(1.0).alias("label")
    )


def negative_samples(pos: DataFrame, n_songs: int, ratio: int = 4, seed: int = 42) -> DataFrame:
    """``ratio`` unseen songs per positive, uniform and with replacement.

    A draw is a rank among the songs the user does not know, taken from a hash,
    so every draw is a hit: a user gets all wanted negatives unless no song is
    unseen. Ranks become songs in one pass over each user's known songs in
    order: a known song with index s and i known songs before it starts a run
    whose members are i + 1 above their ranks. One shuffle by user; a user has
    at most ``n_songs * (ratio + 1)`` rows.
    """
    own = W.partitionBy("user_idx")
    seen = pos.select("user_idx", "song_idx").distinct()
    counted = seen.select(
        "user_idx",
        "song_idx",
        F.count(F.lit(1)).over(own).alias("_known"),
        (F.row_number().over(own.orderBy("song_idx")) - 1).alias("_before"),
    )
    unseen = F.lit(n_songs).cast("long") - F.col("_known")
    start = F.struct((F.col("song_idx") - F.col("_before")).cast("long").alias("rank"), (F.col("_before") + 1).alias("shift"))
    draws = F.transform(
        F.sequence(F.lit(1), F.lit(ratio)),
        lambda d: F.struct(
            F.pmod(stable_hash(seed, "user_idx", "song_idx", d), unseen).alias("rank"), F.lit(None).cast("int").alias("shift")
        ),
    )
    rows = counted.select("user_idx", F.explode(F.when(unseen > 0, F.concat(F.array(start), draws))).alias("_r"))
    in_order = own.orderBy("rank", F.col("shift").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    placed = rows.select("user_idx", "_r.*").withColumn("_shift", F.coalesce(F.max("shift").over(in_order), F.lit(0)))
    return placed.filter("shift IS NULL").select(
        "user_idx",
        (F.col("rank") + F.col("_shift")).cast("int").alias("song_idx"),
        F.lit(0).cast("long").alias("play_count"),
        F.lit(0.0).alias("label"),
    )


def training_set(pos: DataFrame, neg: DataFrame, shuffle: bool = False, seed: int = 42) -> DataFrame:
    """Positives and negatives in one table, in a stable random order on request."""
    columns = ["user_idx", "song_idx", "play_count", "label"]
    rows = pos.select(*columns).unionByName(neg.select(*columns))
    return rows.orderBy(stable_hash(seed, "user_idx", "song_idx", "label")) if shuffle else rows


def _assign(position: Column, fracs: dict[str, float]) -> Column:
    """Name of the part whose share of [0, 1) holds ``position``."""
    names, upper, chosen = list(fracs), 0.0, None
    for name in names[:-1]:
        upper += fracs[name]
        limit = F.lit(round(upper, 12))
        chosen = F.when(position < limit, name) if chosen is None else chosen.when(position < limit, name)
    return F.lit(names[-1]) if chosen is None else chosen.otherwise(names[-1])


def hash_split(df: DataFrame, keys: Sequence[str], fracs: dict[str, float], seed: int = 42) -> DataFrame:
    """Random split by a hash of ``keys``; no shuffle, same result on every run."""
    return df.withColumn("split", _assign(stable_uniform(seed, *keys), fracs))


def stratified_split(
    df: DataFrame,
    fracs: dict[str, float],
    by: str,
    keys: Sequence[str],
    seed: int = 42,
    exact: bool = False,
) -> DataFrame:
    """Split that keeps the shares of ``by`` in each part.

    The default hashes each row, which holds the shares up to chance and moves
    no data. ``exact`` ranks the rows of each stratum by that hash and cuts at
    the exact share; the ranks come from a range sort, not from one task per
    stratum.
    """
    if not exact:
        return hash_split(df, [by, *keys], fracs, seed)
    ordered = df.withColumn("_hash", stable_hash(seed, by, *keys))
    placed = global_positions(ordered, [by, "_hash", *keys], "_position")
    strata = placed.groupBy(by).agg(F.count(F.lit(1)).alias("_size"), F.min("_position").alias("_start"))
    share = (F.col("_position") - F.col("_start")) / F.col("_size")
    return (
        placed.join(strata, by)
        .withColumn("split", _assign(share, fracs))
        .drop("_hash", "_position", "_size", "_start")
    )


def class_balance(df: DataFrame, by: Sequence[str] = ("split", "label")) -> DataFrame:
    """Rows per split and label."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
