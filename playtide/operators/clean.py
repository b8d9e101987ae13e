"""Bronze to silver: required fields, duplicates, derived columns, increments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from playtide.functions.columns import BROWSER_PATTERN, OS_PATTERN, epoch_ms_to_ts
from playtide.schema import EVENT_KEY


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """First row of every key in ``order``.

    Each task drops all but its own first row per key before the shuffle
    (window group limit), so a hot key sends one row per task.
    """
    first = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def dedupe_events(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: Sequence[str] = ("itemInSession", "page", "song"),
) -> DataFrame:
    """One row per key; the survivor is the first by ``order``, not an arbitrary one."""
    return latest_per_key(df, keys, order)


def require_fields(df: DataFrame, drop_blank_users: bool = True) -> DataFrame:
    """P5: keep rows with a user and a time. Logged-out events carry a blank user."""
    kept = df.filter(F.col("userId").isNotNull() & F.col("ts").isNotNull())
    return kept.filter(F.col("userId") != "") if drop_blank_users else kept


def split_location(df: DataFrame) -> DataFrame:
    """P7: "city, state" into two columns; a missing part is null."""
    parts = "get(split(location, ', '), {})"
    return df.withColumns({"city": F.expr(parts.format(0)), "state": F.expr(parts.format(1))})


def parse_user_agent(df: DataFrame, blank_is_unknown: bool = True) -> DataFrame:
    """Browser and operating system, "Unknown" when none is named.

    ``blank_is_unknown=False`` keeps the empty text of a failed match and uses
    "Unknown" for a missing user agent only.
    """


    def named(pattern: str) -> str:
        match = f"regexp_extract(userAgent, '{pattern}', 1)"
        if blank_is_unknown:
            match = f"nullif({match}, '')"
        return f"coalesce({match}, 'Unknown')"

    return df.withColumns({"browser": F.expr(named(BROWSER_PATTERN)), "os": F.expr(named(OS_PATTERN))})


def add_times(df: DataFrame, truncate_seconds: bool = False) -> DataFrame:
    """Event and registration timestamps from their epoch milliseconds."""
    return df.withColumns(
        {
            "event_time": epoch_ms_to_ts(F.col("ts"), truncate_seconds),
            "registration_time": epoch_ms_to_ts(F.col("registration"), truncate_seconds),
        }
    )


def enrich_events(
    df: DataFrame, truncate_seconds: bool = False, blank_is_unknown: bool = True
) -> DataFrame:
    """P3, P7-P9 in one projection."""
    return parse_user_agent(split_location(add_times(df, truncate_seconds)), blank_is_unknown)


def clean_events(
    df: DataFrame,
    drop_blank_users: bool = True,
    truncate_seconds: bool = False,
    blank_is_unknown: bool = True,
) -> DataFrame:
    """The silver transformation."""
    kept = dedupe_events(require_fields(df, drop_blank_users))
    return enrich_events(kept, truncate_seconds, blank_is_unknown)


def _not_stored(raw: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``raw`` whose key, nulls included, is not in ``silver``."""
    stored = silver.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return raw.join(stored, same, "left_anti")


def incremental_filter(
    raw: DataFrame,
    silver: DataFrame | None,
    col: str = "ts",
    lateness: int | None = None,
    keys: Sequence[str] = EVENT_KEY,
    newest: int | None = None,
) -> DataFrame:
    """Rows of ``raw`` that silver does not have yet, late and tied ones included.

    Rows whose key is stored are left out by an anti-join on the key columns.
    ``lateness`` bounds how far before the newest stored row a late row may be;
    both sides then read only that range, and ``late_rows`` gives what it leaves
    out. ``newest`` saves looking the newest row up. Repeated rows stay;
    ``clean_events`` drops them.
    """
    if silver is None:
        return raw
    if lateness is None:
        return _not_stored(raw, silver, keys)
    if newest is None:
        newest = silver.agg(F.max(col)).first()[0]
    if newest is None:
        return raw
    recent = F.col(col) > newest - lateness
    return _not_stored(raw.filter(recent), silver.filter(recent), keys)


def late_rows(
    raw: DataFrame, silver: DataFrame, lateness: int, col: str = "ts", keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """Unseen rows that ``incremental_filter`` with this ``lateness`` leaves out."""
    newest = silver.agg(F.max(col)).scalar()
    old = F.col(col) <= newest - lateness
    return _not_stored(raw.filter(old), silver.filter(F.col(col) <= newest - lateness), keys)


def increment_report(
    raw: DataFrame, silver: DataFrame, lateness: int, col: str = "ts", keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """One row with the rows taken, too late, and known already."""
    taken = incremental_filter(raw, silver, col, lateness, keys).agg(F.count(F.lit(1)).alias("taken"))
    late = late_rows(raw, silver, lateness, col, keys).agg(F.count(F.lit(1)).alias("too_late"))
    total = raw.agg(F.count(F.lit(1)).alias("total"))
    # Three tables of one row each.
    return total.select(
        "total",
        F.lit(taken.scalar()).alias("taken"),
        F.lit(late.scalar()).alias("too_late"),
        (F.col("total") - taken.scalar() - late.scalar()).alias("known"),
    )
