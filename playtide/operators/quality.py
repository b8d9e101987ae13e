"""Null profile, label comparison and other checks of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, total) in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"null_{i}").alias("nulls"))
                for i, c in enumerate(df.columns)
            ]
        )
    )
    return counts.select(rows.alias("r"), "total").select("r.column", "r.nulls", "total")


def layer_counts(df: DataFrame, **distinct: str) -> DataFrame:
    """Row count and one distinct count per ``alias=column``."""
    return df.agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_distinct(F.col(c)).alias(alias) for alias, c in distinct.items()],
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, nulls left out."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), col)
    )


def histogram(df: DataFrame, col: str, bins: int = 20, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Equal-width bins over [lo, hi], empty ones included; ``hi`` is in the last."""
    bounded = df.filter(F.col(col).between(lo, hi))
    bucket = F.least(F.floor((F.col(col) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = bounded.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins)).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First ``n`` rows by an explicit order; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


def label_comparison(df: DataFrame) -> DataFrame:
    """Users counted under the legacy and the strict churn label."""
    old, new = F.sum("churn_old").cast("long"), F.sum("churn_new").cast("long")
    users = F.count(F.lit(1))
    return df.agg(
        users.alias("users"),
        old.alias("churn_old"),
        new.alias("churn_new"),
        (old * 100.0 / users).alias("churn_old_pct"),
        (new * 100.0 / users).alias("churn_new_pct"),
        (old - new).alias("difference"),
    )


def label_distribution(df: DataFrame) -> DataFrame:
    """Users per (strict label, current level)."""
    return df.groupBy("churn_new", "current_level").agg(F.count(F.lit(1)).alias("count"))


def label_disagreements(df: DataFrame, n: int | None = None) -> DataFrame:
    """Users whose label changed, and those back on a paid level after a downgrade."""
    changed = (F.col("churn_old") == 1) & (F.col("churn_new") == 0)
    returned = (F.col("downgrade_count") > 0) & (F.col("current_level") == "paid")
    found = df.filter(changed | returned).select(
        "userId",
        "current_level",
        "downgrade_count",
        "cancel_count",
        "upgrade_count",
        "churn_old",
        "churn_new",
        F.when(changed, "label_changed").otherwise("returned").alias("reason"),
    )
    return found if n is None else found.orderBy("reason", "userId").limit(n)


def layer_rates(tables: dict[str, DataFrame]) -> DataFrame:
    """True rows, newest event, events per minute and lag behind the newest layer, one row per layer."""
    out = None
    for name, df in tables.items():
        one = df.agg(
            F.count(F.lit(1)).alias("rows"), F.min("ts").alias("oldest_ms"), F.max("ts").alias("newest_ms")
        ).withColumn("layer", F.lit(name))
        out = one if out is None else out.unionByName(one)
    minutes = (F.col("newest_ms") - F.col("oldest_ms")) / 60_000
    # One row per layer.
    newest = F.max("newest_ms").over(W.partitionBy())
    return out.select(
        "layer",
        "rows",
        "newest_ms",
        F.round(F.try_divide(F.col("rows"), minutes), 6).alias("events_per_minute"),
        (newest - F.col("newest_ms")).alias("lag_ms"),
    )
