"""Per-user behaviour features and churn labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playtide.functions.columns import page_count, ratio

DAY_MICROS = 86_400_000_000


def _counts() -> list[Column]:
    return [
        page_count("NextSong").alias("total_songs"),
        page_count("Thumbs Down").alias("thumbs_down"),
        page_count("Thumbs Up").alias("thumbs_up"),
        page_count("Settings").alias("settings_visits"),
        page_count("Help").alias("help_visits"),
        page_count("Downgrade").alias("downgrade_count"),
        page_count("Cancellation Confirmation").alias("cancel_count"),
        F.count("sessionId").alias("total_sessions"),
        F.min("event_time").alias("first_event"),
    ]


def _latest_time(df: DataFrame) -> Column:
    """A5: newest event time as a scalar subquery over that one column."""
    return df.agg(F.max("event_time")).scalar()


def _add_ratios(df: DataFrame) -> DataFrame:
    """A4."""
    return df.withColumns(
        {
            "dislike_ratio": ratio(F.col("thumbs_down"), F.col("total_songs")),
            "avg_sessions_per_day": ratio(F.col("total_sessions"), F.col("days_active")),
        }
    )


def _calendar_days(df: DataFrame, latest: Column) -> DataFrame:
    days = F.datediff(F.to_date(latest), F.to_date("first_event")) + 1
    return df.withColumn("days_active", days).drop("first_event")


def user_features_v1(df: DataFrame) -> DataFrame:
    """A3: features per (userId, level, gender).

    A user who changed level has several rows, and ``total_sessions`` counts
    events that have a session: both are part of this published definition.
    """
    users = df.groupBy("userId", "level", "gender").agg(*_counts())
    return _add_ratios(_calendar_days(users, _latest_time(df)))


def user_features_v2(df: DataFrame) -> DataFrame:
    """One row per user with the level and gender of the newest event.

    Events are first folded per (user, level, gender) with fixed-width buffers,
    which hash-aggregates before the shuffle; the newest level is then picked
    from those few rows. On equal times the greater (level, gender) wins.
    """
    extra = [
        page_count("Error").alias("error_visits"),
        page_count("Add Friend", "Add to Playlist").alias("social_actions"),
        page_count("Upgrade").alias("upgrade_count"),
        F.max("event_time").alias("last_event"),
    ]
    parts = df.groupBy("userId", "level", "gender").agg(*_counts(), *extra)
    summed = [c for c in parts.columns if c.endswith(("_count", "_visits", "_actions"))]
    summed += ["total_songs", "thumbs_down", "thumbs_up", "total_sessions"]
    newest = F.max(F.struct("last_event", "level", "gender"))
    users = parts.groupBy("userId").agg(
        *[F.sum(c).alias(c) for c in summed],
        F.min("first_event").alias("first_event"),
        newest.alias("newest"),
    )
    users = users.withColumns(
        {"current_level": F.col("newest.level"), "gender": F.col("newest.gender")}
    ).drop("newest")
    featured = _add_ratios(_calendar_days(users, _latest_time(df)))
    return featured.withColumns(
        {
            "like_dislike_ratio": ratio(
                F.col("thumbs_up"), F.col("thumbs_down"), F.col("thumbs_up") + 1.0
            ),
            "error_rate": ratio(F.col("error_visits"), F.col("total_sessions")),
        }
    )


def user_features_monitor(df: DataFrame) -> DataFrame:
    """Drift features. Sessions are distinct and days are elapsed whole days, at least 1."""
    known = df.filter(F.col("userId").isNotNull() & F.col("event_time").isNotNull())
    users = known.groupBy("userId").agg(
        page_count("NextSong").alias("total_songs"),
        page_count("Thumbs Down").alias("thumbs_down"),
        page_count("Thumbs Up").alias("thumbs_up"),
        page_count("Settings").alias("settings_visits"),
        page_count("Help").alias("help_visits"),
        F.count_distinct("sessionId").alias("total_sessions"),
        F.min("event_time").alias("first_event"),
    )
    elapsed = F.unix_micros(_latest_time(known)) - F.unix_micros("first_event")
    days = F.greatest(F.lit(1), F.floor(elapsed / F.lit(DAY_MICROS))).cast("int")
    return _add_ratios(users.withColumn("days_active", days).drop("first_event"))


def churn_label(df: DataFrame, version: str = "v1") -> DataFrame:
    """M6, M7.

    ``v1``: any cancel or downgrade. ``v3``: the same and currently on the free
    level. ``legacy``: any cancel, or currently on the free level. The last two
    fill ``churn_new`` and ``churn_old``; ``compare`` adds both.
    """
    left = (F.col("cancel_count") > 0) | (F.col("downgrade_count") > 0)
    if version == "v1":
        return df.withColumn("churn", F.when(left, 1).otherwise(0))
    free = F.col("current_level") == "free"
    strict = F.when(free & left, 1).otherwise(0)
    legacy = F.when((F.col("cancel_count") > 0) | free, 1).otherwise(0)
    if version == "v3":
        return df.withColumn("churn_new", strict)
    if version == "legacy":
        return df.withColumn("churn_old", legacy)
    if version == "compare":
        return df.withColumns({"churn_new": strict, "churn_old": legacy})
    raise ValueError(f"unknown label version {version!r}")
