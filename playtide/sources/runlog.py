"""Run metrics and the history of drift summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from playtide.sources.layers import NOT_THERE_YET, append_layer, read_layer

METRICS = "experiment string, run_ts timestamp, metric string, value double"


def metric_rows(
    spark: SparkSession, experiment: str, metrics: dict[str, float | None], run_ts: datetime
) -> DataFrame:
    rows = [(experiment, run_ts, name, float(v)) for name, v in metrics.items() if v is not None]
    return spark.createDataFrame(rows, METRICS)


def log_metrics(rows: DataFrame, path: str) -> None:
    """Append the metrics of a run."""
    append_layer(rows, path, by=None)


def latest_metrics(rows: DataFrame) -> DataFrame:
    """Each metric of the newest run of its experiment; a task sends on only its newest run."""
    newest = W.partitionBy("experiment").orderBy(F.desc("run_ts"))
    ranked = rows.withColumn("_rank", F.rank().over(newest)).filter("_rank = 1")
    return ranked.select("experiment", "metric", "value", "run_ts")


def latest_metric(spark: SparkSession, path: str, experiment: str, metric: str) -> float | None:
    """A metric of the newest run, None when that run did not log it."""
    rows = read_layer(spark, path)
    if rows is None:
        return None
    wanted = latest_metrics(rows.filter(F.col("experiment") == experiment))
    found = wanted.filter(F.col("metric") == metric).agg(F.max("value")).first()
    return found[0]


SUMMARY = (
    "date date, alpha double, n_baseline_users long, n_current_users long, dataset_drift boolean, drift_score double, "
    "n_drifted_cols int, n_total_cols int, n_untested_cols int, drifted_columns array<string>, alert boolean, "
    "hr10 double, churn_auc double, day date"
)


def _history(spark: SparkSession, path: str, days: int, today, schema: str) -> DataFrame | None:
    """Rows of the last ``days`` day folders; the filter on the folder keeps the others unread."""
    try:
        rows = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() in NOT_THERE_YET:
            return None
        raise
    until = F.current_date() if today is None else F.lit(today).cast("date")
    return rows.filter((F.col("day") > F.date_sub(until, days)) & (F.col("day") <= until)).drop("day")


def drift_history(
    spark: SparkSession, path: str, days: int = 30, today=None, schema: str = SUMMARY
) -> DataFrame | None:
    """Summaries of the last ``days`` days in date order; missing days are fine."""
    rows = _history(spark, path, days, today, schema)
    return None if rows is None else rows.orderBy("date")


def latest_report(
    spark: SparkSession, path: str, days: int = 7, today=None, schema: str = SUMMARY
) -> DataFrame | None:
    """Newest summary within ``days`` days."""
    rows = _history(spark, path, days, today, schema)
    return None if rows is None else rows.orderBy(F.desc("date")).limit(1)
