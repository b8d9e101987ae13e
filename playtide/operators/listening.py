"""Plays, rankings, KPIs and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playtide.operators.quality import top_n
from playtide.schema import PLAY_PAGE


def plays(df: DataFrame, mode: str = "ranking") -> DataFrame:
    """P10: listening events.

    ``ranking`` needs song and artist, ``rating`` needs user and song,
    ``strict`` needs the play page and all three.
    """
    if mode == "ranking":
        return df.filter(F.col("song").isNotNull() & F.col("artist").isNotNull())
    if mode == "rating":
        return df.filter(F.col("userId").isNotNull() & F.col("song").isNotNull())
    if mode == "strict":
        return (
            df.filter(F.col("page") == PLAY_PAGE)
            .select("userId", "song", "artist")
            .na.drop(subset=["userId", "song", "artist"])
        )
    raise ValueError(f"unknown mode {mode!r}")


def song_rankings(df: DataFrame) -> DataFrame:
    """Plays per song, most played first."""
    return (
        plays(df, "ranking")
        .groupBy("artist", "song")
        .agg(F.count(F.lit(1)).alias("play_count"))
        .orderBy(F.desc("play_count"), "artist", "song")
    )


def play_counts(df: DataFrame) -> DataFrame:
    """A2: plays per user and song, the implicit rating."""
    return plays(df, "rating").groupBy("userId", "song").agg(F.count(F.lit(1)).alias("play_count"))


def listening_kpis(df: DataFrame) -> DataFrame:
    """Streams, users, paid share in percent, songs."""
    paid = F.count_if(F.col("level") == "paid")
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("streams"),
        F.count_distinct("userId").alias("users"),
        F.when(rows > 0, paid * 100.0 / rows).alias("paid_pct"),
        F.count_distinct("song").alias("songs"),
    )


def kpi_columns() -> list[Column]:
    """Aggregates that can be united later: two counts and two distinct-count sketches (1.6 % error)."""
    sketches = [F.hll_sketch_agg(c, 12).alias(f"{c}_sketch") for c in ("userId", "song")]
    return [F.count(F.lit(1)).alias("streams"), F.count_if(F.col("level") == "paid").alias("paid"), *sketches]


def kpi_sketches(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """(bucket, streams, paid, userId_sketch, song_sketch), to be stored and united."""
    return df.groupBy(F.window("event_time", width).alias("w")).agg(*kpi_columns()).select(F.col("w.start").alias("bucket"), "streams", "paid", "userId_sketch", "song_sketch")


def united_kpis(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Streams, users, paid share and songs of stored buckets, or of each ``by``; events are not read again."""
    distinct = lambda c: F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch"))
    return sketches.groupBy(*by).agg(
        F.sum("streams").alias("streams"),
        distinct("userId").alias("users"),
        F.try_divide(F.sum("paid") * 100.0, F.sum("streams")).alias("paid_pct"),
        distinct("song").alias("songs"),
    )


def trending(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most played songs."""
    counts = plays(df, "ranking").groupBy("song", "artist").agg(F.count(F.lit(1)).alias("plays"))
    return top_n(counts, n, [F.desc("plays"), "song", "artist"])


def velocity(df: DataFrame, width: str = "10 seconds", last: int = 30) -> DataFrame:
    """Events per time bucket, the ``last`` buckets in time order."""
    buckets = df.groupBy(F.window("event_time", width).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    starts = buckets.select(F.col("w.start").alias("bucket"), "events")
    return top_n(starts, last, [F.desc("bucket")]).orderBy("bucket")


def top_artists(rankings: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` artists with most plays, from the song ranking."""
    totals = rankings.groupBy("artist").agg(F.sum("play_count").alias("play_count"))
    return top_n(totals, n, [F.desc("play_count"), "artist"])


def latest_events(df: DataFrame, n: int = 50) -> DataFrame:
    """T4: the newest ``n`` events."""
    return top_n(df, n, [F.desc("event_time"), F.desc("itemInSession"), "userId", "page"])
