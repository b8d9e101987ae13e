"""Two-sample Kolmogorov-Smirnov drift of user features, its summary and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, functions as F

from playtide.operators.scale import running_totals, stored_ranges
from playtide.schema import MONITOR_FEATURES

SERIES_TERMS = 100
EXACT_PAIRS = 65_536  # product of both sizes up to which the p-value is exact


def _long_form(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """One row per (feature, value) of one side."""
    values = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    return (
        values.unpivot([], list(features), "feature", "value")
        .filter(F.col("value").isNotNull())
        .withColumn("side", F.lit(side))
    )


def kolmogorov_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic p-value of the two-sample statistic.

    The alternating series needs more terms than are summed only where the
    p-value is 1 to beyond double precision.
    """
    size = F.sqrt(F.try_divide(n1.cast("double") * n2, n1.cast("double") + n2))
    scaled = statistic * size
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    p_value = F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return F.when(statistic.isNotNull(), p_value)


def exact_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Exact p-value of the two-sample statistic: the share of lattice paths that reach it.

    A path from (0, 0) to (n1, n2) is an order of both samples, and the statistic is
    its greatest distance from the diagonal. Diagonal by diagonal, the array holds for
    each i the probability that a random path through (i, s - i) has stayed nearer.
    """
    reach = F.round(statistic * n1 * n2).cast("long")
    places = F.sequence(F.lit(0).cast("long"), n1.cast("long"))

    def step(nearer: Column, s: Column) -> Column:
        def at(i: Column) -> Column:
            j = s - i
            inside = j.between(0, n2) & (F.abs(i * n2 - j * n1) < reach)
            left = F.coalesce(F.get(nearer, i.cast("int") - 1), F.lit(0.0))
            return F.when(inside, (i * left + j * F.get(nearer, i.cast("int"))) / s).otherwise(0.0)

        return F.transform(places, at)

    start = F.transform(places, lambda i: F.when(i == 0, 1.0).otherwise(0.0))
    last = F.aggregate(F.sequence(F.lit(1).cast("long"), n1 + n2), start, step)
    return F.when(reach <= 0, 1.0).otherwise(1.0 - F.get(last, n1.cast("int")))


def two_sample_p(statistic: Column, n1: Column, n2: Column, exact_pairs: int = EXACT_PAIRS) -> Column:
    """Exact p-value of small samples, asymptotic beyond ``exact_pairs``."""
    small = statistic.isNotNull() & (n1 * n2 <= exact_pairs)
    return F.when(small, exact_p(statistic, n1, n2)).otherwise(kolmogorov_p(statistic, n1, n2))


def _weighted_stats(counts: DataFrame) -> DataFrame:
    """Rows, mean and sample deviation of each side from (feature, value, ref, cur) counts."""
    sides = ("ref", "cur")
    means = counts.groupBy("feature").agg(
        *[F.sum(s).alias(f"n_{s}") for s in sides],
        *[(F.sum(F.col("value") * F.col(s)) / F.nullif(F.sum(s), F.lit(0))).alias(f"{s}_mean") for s in sides],
    )
    # One row per feature.
    centred = counts.join(F.broadcast(means), "feature")

    def squares(side: str) -> Column:
        gap = F.col("value") - F.col(f"{side}_mean")
        return F.sum(gap * gap * F.col(side)).alias(f"_squares_{side}")

    spread = centred.groupBy("feature", *[c for c in means.columns if c != "feature"]).agg(*map(squares, sides))
    deviations = {
        f"{s}_std": F.when(F.col(f"n_{s}") > 1, F.sqrt(F.col(f"_squares_{s}") / (F.col(f"n_{s}") - 1))) for s in sides
    }
    return spread.withColumns(deviations).drop(*[f"_squares_{s}" for s in sides])


def ks_drift(
    baseline: DataFrame,
    current: DataFrame,
    features: Sequence[str] = MONITOR_FEATURES,
    alpha: float = 0.05,
    exact_pairs: int = EXACT_PAIRS,
) -> DataFrame:
    """Statistic, p-value, drift flag, means and deviations per feature.

    Values are first counted per (feature, value), on the map side too, and
    stored; everything else is computed from those counts. The empirical
    distributions are running sums, cut into ranges so that a feature with many
    distinct values spans many tasks. A feature without a value on one side has
    null for statistic, p-value and flag. The p-value is exact where the product of
    both sizes is at most ``exact_pairs``.
    """
    rows = _long_form(baseline, features, "ref").unionByName(_long_form(current, features, "cur"))
    counts = stored_ranges(
        rows.groupBy("feature", "value").agg(
            F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur")
        ),
        "feature",
        "value",
    )
    stats = _weighted_stats(counts)
    running = running_totals(counts, "feature", "value", ["ref", "cur"])
    # One row per feature.
    gaps = running.join(F.broadcast(stats.select("feature", "n_ref", "n_cur")), "feature").groupBy("feature").agg(
        F.max(F.abs(F.try_divide("running_ref", "n_ref") - F.try_divide("running_cur", "n_cur"))).alias(
            "ks_statistic"
        )
    )
    p_value = two_sample_p(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"), exact_pairs)
    return (
        gaps.join(F.broadcast(stats), "feature")
        .withColumn("p_value", p_value)
        .select(
            "feature",
            "ks_statistic",
            "p_value",
            (F.col("p_value") < alpha).alias("drift"),
            "ref_mean",
            "cur_mean",
            "ref_std",
            "cur_std",
            "n_ref",
            "n_cur",
        )
    )


def drift_summary(
    drift: DataFrame,
    on: Date | str,
    alpha: float = 0.05,
    alert_above: float = 0.3,
    metrics: dict[str, float | None] | None = None,
) -> DataFrame:
    """One row per run, with the model metrics being tracked."""
    tracked = metrics or {}
    counted = drift.agg(
        F.max("n_ref").alias("n_baseline_users"),
        F.max("n_cur").alias("n_current_users"),
        F.count_if("drift").cast("int").alias("n_drifted_cols"),
        F.count(F.lit(1)).cast("int").alias("n_total_cols"),
        F.count_if(F.col("drift").isNull()).cast("int").alias("n_untested_cols"),
        F.sort_array(F.collect_list(F.when(F.col("drift"), F.col("feature")))).alias("drifted_columns"),
    )
    score = F.try_divide("n_drifted_cols", "n_total_cols")
    third = F.floor(F.col("n_total_cols") / 3)
    return counted.select(
        F.lit(on).cast("date").alias("date"),
        F.lit(float(alpha)).alias("alpha"),
        "n_baseline_users",
        "n_current_users",
        (F.col("n_drifted_cols") > third).alias("dataset_drift"),
        score.alias("drift_score"),
        "n_drifted_cols",
        "n_total_cols",
        "n_untested_cols",
        "drifted_columns",
        (score > alert_above).alias("alert"),
        *[F.lit(v).cast("double").alias(name) for name, v in tracked.items()],
    )


def alerts(summary: DataFrame) -> DataFrame:
    """One row per run that raised an alert."""
    names = F.array_join(F.transform("drifted_columns", lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", ")
    # Fixed text of the alert.
    message = F.concat(
        F.lit("Drift score="), F.format_string("%.2f", "drift_score"), F.lit(" | Drifted: ["), names, F.lit("]")
    )
    return summary.filter("alert").select(
        "date", F.lit("DATA_DRIFT").alias("type"), F.lit("HIGH").alias("severity"), message.alias("message")
    )
