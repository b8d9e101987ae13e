"""The scheduled jobs: each reads layers, composes operators and writes layers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide.operators import churn, clean, drift, features, interactions, listening, recommend, sessions
from playtide.operators.scale import cut_lineage
from playtide.sources import layers, runlog

SPLIT = {"train": 0.70, "val": 0.15, "test": 0.15}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, lateness: int | None = None) -> bool:
    """Clean what bronze has beyond silver and append it; False when bronze is not there yet."""
    raw = layers.read_layer(spark, bronze)
    if raw is None:
        return False
    fresh = clean.incremental_filter(raw, layers.read_layer(spark, silver), lateness=lateness)
    layers.append_layer(clean.clean_events(fresh), silver, rebalance=True)
    return True


def write_rankings(spark: SparkSession, silver: str, gold: str) -> bool:
    """Song ranking to gold."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return False
    layers.replace_layer(listening.song_rankings(events), gold)
    return True


def dense_matrix(events: DataFrame, min_plays: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Encoded interactions with their user and song ids, stored once for all readers."""
    matrix = interactions.interaction_matrix(events, min_plays)
    users = interactions.dense_ids(matrix, "userId", "user_idx")
    songs = interactions.dense_ids(matrix, "song", "song_idx")
    return cut_lineage(interactions.encode_interactions(matrix, users, songs)), users, songs


def dense_ratings(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Play counts with dense ids, the input of matrix factorisation."""
    counts = cut_lineage(listening.play_counts(events).withColumn("artist", F.lit(None).cast("string")))
    users = interactions.dense_ids(counts, "userId", "user_idx")
    songs = interactions.dense_ids(counts, "song", "song_idx")
    encoded = interactions.encode_interactions(counts, users, songs).drop("artist")
    return cut_lineage(encoded), users, songs


def train_recommendations(
    spark: SparkSession, silver: str, gold: str, k: int = 10, implicit: bool = False, metrics: str | None = None
) -> dict | None:
    """Factor model, its top ``k`` per user, its factors, both id maps and the model; returns RMSE and hit rate."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return None
    ratings, users, songs = dense_ratings(events)
    train, test = churn.holdout(ratings, key=["user_idx", "song_idx"])
    model = recommend.train_als(train, implicit=implicit)
    layers.replace_layer(recommend.recommend_all(model, k), f"{gold}/recommendations")
    layers.replace_layer(users, f"{gold}/user_mapping")
    layers.replace_layer(songs, f"{gold}/song_mapping")
    sides = (("user", model.userFactors, users, "user_idx", "userId"), ("song", model.itemFactors, songs, "song_idx", "song"))
    named = [f.join(m.select(F.col(i).alias("id"), F.col(n).alias("name")), "id").select(F.lit(kind).alias("kind"), "id", "name", "features") for kind, f, m, i, n in sides]
    layers.publish_layer(named[0].unionByName(named[1]), f"{gold}/factors")  # one table, so that readers see one training
    layers.save_model(model, f"{gold}/models/als")
    candidates = recommend.ranking_candidates(test, songs.count(), known=train)
    result = {
        "rmse": recommend.als_rmse(model, test),
        "hr10": recommend.als_hit_rate(model, candidates, 10).first()["hit_rate"],
    }
    if metrics:
        runlog.log_metrics(runlog.metric_rows(spark, "recommend", result, datetime.now()), metrics)
    return result


def lookup_user(spark: SparkSession, gold: str, user: str, k: int = 10) -> DataFrame | None:
    """One user's ``k`` best songs from the published factors of one training; None before the first one."""
    factors = layers.read_published(spark, f"{gold}/factors")
    if factors is None:
        return None
    users, songs = (factors.filter(F.col("kind") == kind).drop("kind") for kind in ("user", "song"))
    mapped = users.select(F.col("id").alias("user_idx"), F.col("name").alias("userId"))
    return recommend.lookup_factors(user, users, songs, mapped, songs.select(F.col("id").alias("song_idx"), F.col("name").alias("song")), k)


def train_churn(spark: SparkSession, silver: str, gold: str, metrics: str | None = None) -> dict | None:
    """Churn model, scores of all users and the model; returns the test metrics."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return None
    labelled = cut_lineage(features.churn_label(features.user_features_v1(events), "v1"))
    train, test = churn.holdout(labelled)
    model: PipelineModel = churn.churn_pipeline().fit(train)
    result = churn.evaluate_binary(model.transform(test))
    layers.replace_layer(churn.predict_churn(model, labelled), f"{gold}/churn_predictions")
    layers.save_model(model, f"{gold}/models/churn")
    if metrics:
        runlog.log_metrics(runlog.metric_rows(spark, "churn", result, datetime.now()), metrics)
    return result


def export_training_set(spark: SparkSession, silver: str, gold: str, ratio: int = 4, seed: int = 42) -> bool:
    """Implicit-feedback data: train, val and test parts, both id maps and the counts."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return False
    positives, users, songs = dense_matrix(events)
    n_songs = songs.count()
    negatives = interactions.negative_samples(positives, n_songs, ratio, seed)
    rows = interactions.training_set(positives, negatives)
    split = interactions.stratified_split(rows, SPLIT, "label", ["user_idx", "song_idx"], seed, exact=True)
    split.write.mode("overwrite").partitionBy("split").parquet(f"{gold}/training_set")
    layers.replace_layer(users, f"{gold}/training_users")
    layers.replace_layer(songs, f"{gold}/training_songs")
    counts = spark.createDataFrame([(users.count(), n_songs)], "n_users long, n_songs long")
    layers.write_json(counts, f"{gold}/training_counts")
    return True


def score_sessions(spark: SparkSession, silver: str, gold: str) -> bool:
    """Anomaly score of every session."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return False
    vectors = sessions.session_vectors(sessions.session_sequences(events))
    layers.replace_layer(sessions.anomaly_scores(vectors), f"{gold}/anomaly_scores")
    return True


def monitor(
    spark: SparkSession, silver: str, folder: str, on: date | None = None, alpha: float = 0.05
) -> DataFrame | None:
    """Drift of user features against the stored baseline; writes the day's report and metrics."""
    events = layers.read_layer(spark, silver)
    if events is None:
        return None
    day = on or date.today()
    current = cut_lineage(features.user_features_monitor(events))
    baseline = layers.load_or_create_baseline(spark, f"{folder}/baseline", current)
    found = cut_lineage(drift.ks_drift(baseline, current, alpha=alpha))
    metrics = {
        "hr10": runlog.latest_metric(spark, f"{folder}/run_metrics", "recommend", "hr10"),
        "churn_auc": runlog.latest_metric(spark, f"{folder}/run_metrics", "churn", "auc"),
    }
    summary = cut_lineage(drift.drift_summary(found, day, alpha, metrics=metrics))
    layers.write_json(summary.withColumn("day", F.col("date")), f"{folder}/summary", by="day")
    layers.write_json(found.withColumn("day", F.lit(day)), f"{folder}/features", by="day")
    layers.write_json(drift.alerts(summary).withColumn("day", F.col("date")), f"{folder}/alerts", by="day")
    first = summary.first()
    logged = {
        "drift_score": first["drift_score"],
        "n_drifted_columns": first["n_drifted_cols"],
        "n_current_users": first["n_current_users"],
        **metrics,
    }
    runlog.log_metrics(
        runlog.metric_rows(spark, "monitoring", logged, datetime.combine(day, datetime.min.time())),
        f"{folder}/run_metrics",
    )
    return summary
