"""The jobs one after the other on layers, from bronze to monitoring."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF
from playtide.operators import clean, listening
from playtide.plans import jobs
from playtide.sources import adapters, layers, runlog


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw = adapters.read_raw_events(spark, SF)
    layers.append_layer(raw.filter("ts < 1705300000000"), f"{root}/bronze")
    assert jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")
    layers.append_layer(raw.filter("ts >= 1705300000000"), f"{root}/bronze")
    assert jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")  # nothing new
    return root


def test_nothing_to_do_without_input(spark, tmp_path):
    none = str(tmp_path / "none")
    assert jobs.bronze_to_silver(spark, none, none) is False
    assert jobs.write_rankings(spark, none, none) is False
    assert jobs.train_recommendations(spark, none, none) is None
    assert jobs.train_churn(spark, none, none) is None
    assert jobs.export_training_set(spark, none, none) is False
    assert jobs.score_sessions(spark, none, none) is False
    assert jobs.monitor(spark, none, none) is None


def test_increments_equal_one_load(spark, lake):
    columns = ["userId", "ts", "sessionId", "page", "browser"]
    whole = clean.clean_events(adapters.read_raw_events(spark, SF)).select(*columns)
    stored = spark.read.parquet(f"{lake}/silver").select(*columns)
    assert stored.count() == whole.count() and stored.exceptAll(whole).count() == 0


def test_rankings(spark, lake):
    assert jobs.write_rankings(spark, f"{lake}/silver", f"{lake}/rankings")
    expected = listening.song_rankings(adapters.read_silver_events(spark, SF)).collect()
    stored = layers.read_layer(spark, f"{lake}/rankings")
    assert sorted(stored.collect()) == sorted(expected)


def test_recommendations(spark, lake):
    result = jobs.train_recommendations(spark, f"{lake}/silver", f"{lake}/gold", metrics=f"{lake}/watch/run_metrics")
    assert 0 < result["rmse"] < 2 and 0 < result["hr10"] < 1
    assert runlog.latest_metric(spark, f"{lake}/watch/run_metrics", "recommend", "hr10") == result["hr10"]
    assert spark.read.parquet(f"{lake}/gold/recommendations").count() == 150
    assert spark.read.parquet(f"{lake}/gold/song_mapping").count() == 40
    user = spark.read.parquet(f"{lake}/gold/user_mapping").first()
    recs = spark.read.parquet(f"{lake}/gold/recommendations").filter(F.col("user_idx") == user["user_idx"]).first()["recommendations"]
    found = jobs.lookup_user(spark, f"{lake}/gold", user["userId"]).orderBy("rank").collect()
    assert [round(r.score, 5) for r in found] == [round(x.rating, 5) for x in recs]
    assert jobs.lookup_user(spark, f"{lake}/gold", "nobody").count() == 0 and jobs.lookup_user(spark, f"{lake}/none", "nobody") is None


def test_training_set(spark, lake):
    assert jobs.export_training_set(spark, f"{lake}/silver", f"{lake}/gold")
    rows = spark.read.parquet(f"{lake}/gold/training_set")
    sizes = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert set(sizes) == {"train", "val", "test"} and abs(sizes["train"] / rows.count() - 0.7) < 0.001
    assert spark.read.json(f"{lake}/gold/training_counts").first().asDict() == {"n_songs": 40, "n_users": 150}


def test_session_scores(spark, lake):
    assert jobs.score_sessions(spark, f"{lake}/silver", f"{lake}/gold")
    assert spark.read.parquet(f"{lake}/gold/anomaly_scores").count() == 1437


def test_churn_then_monitoring(spark, lake):
    result = jobs.train_churn(spark, f"{lake}/silver", f"{lake}/gold", f"{lake}/watch/run_metrics")
    assert 0 <= result["auc"] <= 1
    first = jobs.monitor(spark, f"{lake}/silver", f"{lake}/watch", date(2024, 1, 30)).first()
    assert first.n_drifted_cols == 0 and not first.alert
    assert first.churn_auc == pytest.approx(result["auc"]) and first.hr10 > 0
    busier = spark.read.parquet(f"{lake}/silver").withColumn("userId", F.concat("userId", F.lit("x")))
    more = busier.unionByName(busier.withColumn("sessionId", F.col("sessionId") + 1_000_000))
    layers.append_layer(more, f"{lake}/silver2")
    second = jobs.monitor(spark, f"{lake}/silver2", f"{lake}/watch", date(2024, 1, 31)).first()
    assert second.alert and "total_songs" in second.drifted_columns
    history = runlog.drift_history(spark, f"{lake}/watch/summary", today="2024-02-01").collect()
    assert [r.n_drifted_cols for r in history] == [0, second.n_drifted_cols]
    assert spark.read.json(f"{lake}/watch/alerts").first().type == "DATA_DRIFT"
    assert runlog.latest_metric(spark, f"{lake}/watch/run_metrics", "monitoring", "n_current_users") == 150
