"""The keys of stored events by day, so that an increment reads the keys of its own days only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playtide.operators.clean import EVENT_KEY
from playtide.sources.layers import append_layer, read_layer

DAY_MS = 86_400_000
NO_DAY = -1  # of rows without a time


def _day(col: str) -> Column:
    """Days since 1970 of epoch milliseconds."""
    return F.coalesce(F.floor(F.col(col) / F.lit(DAY_MS)).cast("int"), F.lit(NO_DAY))


def add_keys(events: DataFrame, path: str, keys: Sequence[str] = EVENT_KEY, col: str = "ts") -> None:
    """Append the distinct keys of newly stored events to the index, partitioned by day.

    The folder ``marks`` gets one row per day and call with the newest time stored.
    """
    held = events.select(*keys).distinct().withColumn("_day", _day(col))
    append_layer(held, f"{path}/keys", "_day", rebalance=True)
    marks = events.groupBy(_day(col).alias("_day")).agg(F.max(col).alias("newest"), F.count(F.lit(1)).alias("rows"))
    marks.coalesce(1).write.mode("append").parquet(f"{path}/marks")  # a row per day


def high_water(spark: SparkSession, path: str) -> int | None:
    """Time of the newest stored event; None before the first one."""
    marks = read_layer(spark, f"{path}/marks")
    return None if marks is None else marks.agg(F.max("newest")).first()[0]


def unseen_rows(raw: DataFrame, path: str, keys: Sequence[str] = EVENT_KEY, col: str = "ts") -> DataFrame:
    """Rows of ``raw`` whose key, nulls included, is not in the index; late and tied ones are taken.

    Rows newer than all stored ones need no look. The others meet the keys of their days,
    which are partitions of the index; no other day is read, nor any event.
    """
    spark = raw.sparkSession
    newest, index = high_water(spark, path), read_layer(spark, f"{path}/keys")
    if index is None:
        return raw
    dated = raw.withColumn("_day", _day(col))
    newer = F.col(col) > F.lit(newest) if newest is not None else F.lit(False)
    newer = F.coalesce(newer, F.lit(False))
    old = dated.filter(~newer)
    days = [r[0] for r in old.select("_day").distinct().collect()]  # a row per day of the increment
    held = index.filter(F.col("_day").isin(days)).select(F.col("_day").alias("_held_day"), *[F.col(k).alias(f"_held_{k}") for k in keys])
    same = F.col("_day") == F.col("_held_day")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_held_{k}"))
    fresh = old.join(held, same, "left_anti")
    return dated.filter(newer).unionByName(fresh).select(raw.columns)
