"""Physical plans: what reaches the scan, what leaves a task, what stays in the JVM."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from conftest import SF
from playtide.operators import clean, features, listening, sessions
from playtide.sources import layers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow")


@pytest.mark.parametrize(
    "name",
    [
        "clean_events", "song_rankings", "user_features_v1", "user_features_v2", "user_features_monitor",
        "interaction_matrix", "negative_samples", "stratified_split_exact", "session_vectors", "ks_drift",
        "hit_rate_at_k", "decode_ids", "anomaly_scores", "lookup_recommendations", "recommendation_text", "training_set_orders",
    ],
)
def test_batch_queries_run_no_python_and_no_product(spark, name):
    plan = plan_of(spark_entry.queries()[name](spark, SF))
    assert not any(node in plan for node in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_increment_filter_reaches_the_scan(spark, silver, tmp_path):
    layers.append_layer(silver, str(tmp_path / "bronze"))
    raw = layers.read_layer(spark, str(tmp_path / "bronze"))
    plan = plan_of(clean.incremental_filter(raw, silver.limit(10), lateness=1000))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThan\(ts,", plan)


def test_ranking_reads_two_columns(spark, silver, tmp_path):
    layers.append_layer(silver, str(tmp_path / "silver"))
    plan = plan_of(listening.song_rankings(layers.read_layer(spark, str(tmp_path / "silver"))))
    assert re.search(r"ReadSchema: struct<artist:string,song:string>", plan)


@pytest.mark.parametrize("limit,build", [
    (1, lambda df: clean.dedupe_events(df)),
    (1, lambda df: clean.latest_per_key(df, ["userId"], [F.desc("event_time")])),
    (50, lambda df: sessions.session_sequences(df)),
])
def test_tasks_keep_only_the_first_rows_per_key(silver, limit, build):
    assert re.search(rf"WindowGroupLimit .*row_number\(\), {limit}, Partial", plan_of(build(silver)))


def test_newest_level_needs_no_sort_of_events(silver):
    plan = plan_of(features.user_features_v2(silver))
    # The only sorts are above the per-(user, level, gender) aggregate.
    below = plan[plan.index("partial_count"):] if "partial_count" in plan else plan
    assert "Sort [" not in below


def test_top_n_is_not_a_global_sort(silver):
    plan = plan_of(listening.trending(silver))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_one_task_windows_are_over_one_row_per_partition(spark):
    plan = plan_of(spark_entry.queries()["dense_ids"](spark, SF))
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_part" in part
