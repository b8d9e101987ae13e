"""Registered queries: each takes (spark, folder of tables) and returns a DataFrame.

Every query runs over whole tables. Values are given plain types (epoch
milliseconds, text for times) so that another engine can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from playtide.functions.columns import risk_level
from playtide.operators import (
    churn,
    clean,
    drift,
    features,
    interactions,
    listening,
    quality,
    recommend,
    scale,
    sessions,
)
from playtide.plans import jobs
from playtide.sources import adapters, keyindex, layers, runlog
from playtide.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]

PARTS = {"train": 0.70, "val": 0.15, "test": 0.15}
HOLDOUT = {"train": 0.8, "test": 0.2}
PAIR = ["user_idx", "song_idx"]


def text_time(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _raw(spark, sf):
    return adapters.read_raw_events(spark, sf)


def _silver(spark, sf):
    return adapters.read_silver_events(spark, sf)


def _middle(df: DataFrame) -> Column:
    """Middle of the time range, as a scalar subquery."""
    return df.agg(F.floor((F.min("ts") + F.max("ts")) / 2)).scalar()


def parse_events(spark, sf):
    raw = _raw(spark, sf)
    payload = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    return ingest.parse_events(payload).select(
        "ts", "userId", "sessionId", "page", "level", "location", "gender", "artist", "song", "duration"
    )


def clean_events(spark, sf):
    raw = _raw(spark, sf)
    return clean.clean_events(raw).select(
        "ts", "userId", "sessionId", "page", "city", "state", "browser", "os", text_time("registration_time").alias("registered")
    )


def dedupe_events(spark, sf):
    """Each event delivered twice, the second time as another page."""
    raw = _raw(spark, sf).select("userId", "ts", "sessionId", "itemInSession", "page", "song")
    again = raw.withColumn("itemInSession", F.col("itemInSession") + 1).withColumn("page", F.lit("Home"))
    return clean.dedupe_events(raw.unionByName(again))


def split_location(spark, sf):
    return clean.split_location(_raw(spark, sf)).groupBy("location", "city", "state").agg(
        F.count(F.lit(1)).alias("events")
    )


def parse_user_agent(spark, sf):
    return clean.parse_user_agent(_raw(spark, sf)).groupBy("userAgent", "browser", "os").agg(
        F.count(F.lit(1)).alias("events")
    )


def parse_user_agent_blank(spark, sf):
    return clean.parse_user_agent(_raw(spark, sf), blank_is_unknown=False).groupBy(
        "userAgent", "browser", "os"
    ).agg(F.count(F.lit(1)).alias("events"))


def _stored_part(raw: DataFrame) -> DataFrame:
    """What silver holds: the first half of the log but for every seventh event, which arrives late."""
    return raw.filter((F.col("ts") <= _middle(raw)) & (F.col("itemInSession") % 7 != 0))


def incremental_filter(spark, sf):
    """The default takes late rows and rows as old as the newest stored one."""
    raw = _raw(spark, sf)
    return clean.incremental_filter(raw, _stored_part(raw)).select("userId", "ts", "sessionId", "page")


def incremental_filter_late(spark, sf):
    """Late rows up to three days before the newest stored one."""
    raw = _raw(spark, sf)
    fresh = clean.incremental_filter(raw, _stored_part(raw), lateness=3 * adapters.DAY_MS)
    return fresh.select("userId", "ts", "sessionId", "page")


def incremental_filter_indexed(spark, sf):
    """The same rows as the default, from the keys of the increment's days instead of all stored events."""
    raw = _raw(spark, sf)
    index = scale.new_folder(spark, "index")
    keyindex.add_keys(_stored_part(raw), index)
    return keyindex.unseen_rows(raw, index).select("userId", "ts", "sessionId", "page")


def increment_report(spark, sf):
    raw = _raw(spark, sf)
    return clean.increment_report(raw, _stored_part(raw), 3 * adapters.DAY_MS)


def _damaged(raw: DataFrame) -> DataFrame:
    """Payloads of which some are cut off and some have a time that is no number."""
    whole = F.to_json(F.struct(*raw.columns))
    cut = F.when(F.col("itemInSession") % 10 == 0, F.lit('{"ts": 17')).otherwise(whole)
    value = F.when(F.col("itemInSession") % 11 == 0, F.lit('{"ts": "soon"}')).otherwise(cut)
    return raw.select("itemInSession", value.alias("value"))


def parse_damaged_events(spark, sf):
    return ingest.parse_events(_damaged(_raw(spark, sf))).select("ts", "userId", "sessionId", "page", "itemInSession")


def rejected_events(spark, sf):
    return ingest.rejected_events(_damaged(_raw(spark, sf))).select("itemInSession")


def _unnamed(raw: DataFrame) -> DataFrame:
    """Events of which some have no user, a blank user or no time."""
    item = F.col("itemInSession")
    user = F.when(item % 9 == 0, F.lit(None)).when(item % 10 == 0, F.lit("")).otherwise(F.col("userId"))
    return raw.withColumns({"userId": user, "ts": F.when(item % 13 != 0, F.col("ts"))})


def require_fields(spark, sf):
    return clean.require_fields(_unnamed(_raw(spark, sf))).select("ts", "userId", "itemInSession")


def require_fields_blank(spark, sf):
    kept = clean.require_fields(_unnamed(_raw(spark, sf)), drop_blank_users=False)
    return kept.select("ts", "userId", "itemInSession")


def null_profile(spark, sf):
    return quality.null_profile(_raw(spark, sf))


def layer_counts(spark, sf):
    return quality.layer_counts(_raw(spark, sf), users="userId", sessions="sessionId")


def song_rankings(spark, sf):
    return listening.song_rankings(_silver(spark, sf))


def play_counts(spark, sf):
    return listening.play_counts(_silver(spark, sf))


def listening_kpis(spark, sf):
    return listening.listening_kpis(_silver(spark, sf).filter(F.col("page") == "NextSong"))


def value_counts_gender(spark, sf):
    return quality.value_counts(_silver(spark, sf), "gender")


def value_counts_level(spark, sf):
    return quality.value_counts(_silver(spark, sf), "level")


def trending(spark, sf):
    return listening.trending(_silver(spark, sf))


def velocity(spark, sf):
    return listening.velocity(_silver(spark, sf)).select(text_time("bucket").alias("bucket"), "events")


def top_artists(spark, sf):
    return listening.top_artists(listening.song_rankings(_silver(spark, sf)))


def top_artists_orders(spark, sf):
    return listening.top_artists(listening.song_rankings(adapters.order_plays(spark, sf)))


def top_songs_per_hour(spark, sf):
    """Ten most played songs of every hour."""
    silver = _silver(spark, sf).filter(F.col("song").isNotNull() & F.col("artist").isNotNull())
    trend = silver.groupBy(F.window("event_time", "1 hour").alias("w"), "song", "artist").agg(
        F.count(F.lit(1)).alias("plays")
    )
    best = live.top_per_bucket(trend.select(F.col("w.start").alias("bucket"), "song", "artist", "plays"))
    return best.withColumn("bucket", text_time("bucket"))


def top_songs_orders(spark, sf):
    return quality.top_n(
        listening.song_rankings(adapters.order_plays(spark, sf)), 100, [F.desc("play_count"), "artist", "song"]
    )


def latest_events(spark, sf):
    return listening.latest_events(_silver(spark, sf)).select("ts", "userId", "sessionId", "page", "itemInSession")


def user_features_v1(spark, sf):
    return features.user_features_v1(_silver(spark, sf))


def user_features_v2(spark, sf):
    return features.user_features_v2(_silver(spark, sf))


def user_features_monitor(spark, sf):
    return features.user_features_monitor(_silver(spark, sf))


def latest_per_key(spark, sf):
    silver = _silver(spark, sf)
    newest = clean.latest_per_key(silver, ["userId"], [F.desc("event_time"), F.desc("itemInSession")])
    return newest.select("userId", F.col("level").alias("current_level"), "gender")


def churn_label_v1(spark, sf):
    labelled = features.churn_label(features.user_features_v1(_silver(spark, sf)), "v1")
    return labelled.select("userId", "level", "downgrade_count", "cancel_count", "churn")


def _labelled(spark, sf):
    return features.churn_label(features.user_features_v2(_silver(spark, sf)), "compare")


def churn_label_v3(spark, sf):
    return _labelled(spark, sf).select("userId", "current_level", "churn_new", "churn_old")


def label_comparison(spark, sf):
    return quality.label_comparison(_labelled(spark, sf))


def label_distribution(spark, sf):
    return quality.label_distribution(_labelled(spark, sf))


def label_disagreements(spark, sf):
    return quality.label_disagreements(_labelled(spark, sf))


def interaction_matrix(spark, sf):
    return interactions.interaction_matrix(_silver(spark, sf))


def interaction_matrix_orders(spark, sf):
    return interactions.interaction_matrix(adapters.order_plays(spark, sf))


def interaction_matrix_active(spark, sf):
    """Only users and parts with thirty order lines or more."""
    return interactions.interaction_matrix(adapters.order_plays(spark, sf), min_plays=30)


def matrix_stats(spark, sf):
    return interactions.matrix_stats(interactions.interaction_matrix(adapters.order_plays(spark, sf)))


def dense_ids(spark, sf):
    return interactions.dense_ids(_raw(spark, sf), "userId", "user_idx")


def dense_ids_orders(spark, sf):
    return interactions.dense_ids(adapters.order_plays(spark, sf), "song", "song_idx")


def id_mapping(spark, sf):
    """Nation number as an index that many customer names share."""
    people = spark.read.parquet(f"{sf}/customer.parquet")
    return interactions.id_mapping(people.withColumn("idx", F.col("c_nationkey")), "idx", "c_name")


def hash_ids(spark, sf):
    return interactions.hash_ids(listening.play_counts(_silver(spark, sf)))


def encode_interactions(spark, sf):
    positives, _, _ = jobs.dense_matrix(_silver(spark, sf))
    return positives


def negative_samples(spark, sf):
    positives, _, songs = jobs.dense_matrix(_silver(spark, sf))
    return interactions.negative_samples(positives, songs.count())


def negative_samples_dense(spark, sf):
    """Brands as songs: customers who know nearly all of them still get every negative they want."""
    plays = adapters.order_plays(spark, sf).withColumn("song", F.col("artist"))
    positives, _, songs = jobs.dense_matrix(plays)
    found = interactions.negative_samples(positives, songs.count())
    return found.groupBy("user_idx").agg(F.count(F.lit(1)).alias("rows"), F.sum("song_idx").alias("song_idx_sum"))


def _training(spark, sf):
    positives, _, songs = jobs.dense_matrix(_silver(spark, sf))
    return interactions.training_set(positives, interactions.negative_samples(positives, songs.count()))


def training_set(spark, sf):
    return _training(spark, sf)


def training_set_orders(spark, sf):
    """Size of the training set of the order plays, per label and user-index bucket of 100."""
    positives, _, songs = jobs.dense_matrix(adapters.order_plays(spark, sf))
    rows = interactions.training_set(positives, interactions.negative_samples(positives, songs.count()))
    return rows.groupBy("label", F.floor(F.col("user_idx") / 100).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("song_idx").alias("song_idx_sum")
    )


def hash_split(spark, sf):
    return interactions.hash_split(
        listening.play_counts(_silver(spark, sf)), ["userId", "song"], HOLDOUT
    )


def stratified_split(spark, sf):
    return interactions.stratified_split(_training(spark, sf), PARTS, "label", PAIR)


def stratified_split_exact(spark, sf):
    return interactions.stratified_split(_training(spark, sf), PARTS, "label", PAIR, exact=True)


def class_balance(spark, sf):
    return interactions.class_balance(stratified_split_exact(spark, sf))


def _popularity(positives: DataFrame) -> DataFrame:
    return positives.groupBy("song_idx").agg(F.sum("play_count").alias("score"))


def hit_rate_at_k(spark, sf):
    """Hit rate of ranking by popularity, with the validation part's positives held out."""
    positives, _, songs = jobs.dense_matrix(_silver(spark, sf))
    split = interactions.hash_split(positives, PAIR, HOLDOUT)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    return recommend.hit_rate_at_k(_popularity(train), test, songs.count(), known=train)


def hit_rate_orders(spark, sf):
    """Hit rate by popularity of 500 of the customers, with 99 unseen parts each."""
    positives, _, songs = jobs.dense_matrix(adapters.order_plays(spark, sf))
    split = interactions.hash_split(positives, PAIR, HOLDOUT)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    return recommend.hit_rate_at_k(_popularity(train), test, songs.count(), known=train)


def ranking_candidates_orders(spark, sf):
    positives, _, songs = jobs.dense_matrix(adapters.order_plays(spark, sf))
    return recommend.ranking_candidates(positives, songs.count())


def ranking_candidates(spark, sf):
    positives, _, songs = jobs.dense_matrix(_silver(spark, sf))
    return recommend.ranking_candidates(positives, songs.count())


def own_plays_top_k(spark, sf):
    """Ten best songs of every user by the user's own plays, decoded to names."""
    positives, users, songs = jobs.dense_matrix(_silver(spark, sf))
    best = recommend.top_k_scores(positives.select(*PAIR, F.col("play_count").alias("score")), 10)
    named = recommend.decode_ids(best, songs, "song_idx", "song")
    return recommend.decode_ids(named, users, "user_idx", "userId", "user_").select(
        "userId", "rank", "song", "score"
    )


def decode_ids(spark, sf):
    """Line items' suppliers decoded with the names of parts; numbers without a part get a placeholder."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") + F.col("l_suppkey")).alias("song_idx")
    )
    parts = spark.read.parquet(f"{sf}/part.parquet")
    return recommend.decode_ids(lines, parts.select(F.col("p_partkey").alias("song_idx"), F.col("p_name").alias("song")), "song_idx", "song")


def encode_names(spark, sf):
    plays = adapters.order_plays(spark, sf)
    songs = interactions.dense_ids(plays, "song", "song_idx")
    counts = listening.play_counts(plays)
    return recommend.encode_names(counts, songs, "song", "song_idx")


def session_sequences(spark, sf):
    found = sessions.session_sequences(_silver(spark, sf))
    return found.withColumn("page_seq", F.concat_ws(",", F.transform("page_seq", lambda c: c.cast("string"))))


def session_sequences_users(spark, sf):
    """One session per user, so that sequences are cut at 50."""
    silver = _silver(spark, sf).withColumn("sessionId", F.lit(0).cast("long"))
    found = sessions.session_sequences(silver)
    return found.withColumn("page_seq", F.concat_ws(",", F.transform("page_seq", lambda c: c.cast("string"))))


def _vectors(spark, sf):
    return sessions.session_vectors(sessions.session_sequences(_silver(spark, sf)))


def session_vectors(spark, sf):
    return _vectors(spark, sf).select(
        "userId",
        "sessionId",
        "session_length",
        F.size("x").alias("size"),
        F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 6).alias("total"),
        F.col("x")[0].alias("first"),
        F.col("x")[49].alias("last"),
    )


def session_stats(spark, sf):
    return sessions.session_stats(sessions.session_sequences(_silver(spark, sf)))


def _user_vectors(spark, sf):
    """One session per user, up to 50 events long."""
    silver = _silver(spark, sf).withColumn("sessionId", F.lit(0).cast("long"))
    return sessions.session_vectors(sessions.session_sequences(silver))


def anomaly_scores(spark, sf):
    return sessions.anomaly_scores(_user_vectors(spark, sf))


def score_columns(spark, sf):
    """Flag and score of an error without a model: how far a session's length is from the mean."""
    found = sessions.session_sequences(_silver(spark, sf)).select("userId", "sessionId", "session_length")
    mean = found.agg(F.avg("session_length")).scalar()
    rated = scale.cut_lineage(found.withColumn("recon_error", F.abs(F.col("session_length") - mean)))
    threshold = scale.exact_percentile(rated, "recon_error", 0.95)
    scored = rated.withColumns(sessions.score_columns(F.col("recon_error"), F.lit(threshold)))
    rounded = [F.round(c, 9).alias(c) for c in ("recon_error", "anomaly_score")]
    return scored.select("userId", "sessionId", "is_anomaly", *rounded)


def lookup_anomaly(spark, sf):
    """Scores of the newest session."""
    newest = _silver(spark, sf).agg(F.max("sessionId")).first()[0]
    return sessions.lookup_anomaly(newest, score_columns(spark, sf))


def anomaly_share(spark, sf):
    return sessions.anomaly_share(anomaly_scores(spark, sf))


def exact_percentile(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    found = scale.exact_percentile(events, "value", 0.95)
    return events.agg(F.count(F.lit(1)).alias("rows")).withColumn("p95", F.round(F.lit(found), 6))


def _drift(spark, sf, alpha=0.05):
    """First half of the log as baseline, all of it as current."""
    silver = _silver(spark, sf)
    baseline = features.user_features_monitor(silver.filter(F.col("ts") <= _middle(silver)))
    return drift.ks_drift(baseline, features.user_features_monitor(silver), alpha=alpha, exact_pairs=0)


def ks_drift(spark, sf):
    found = _drift(spark, sf)
    rounded = [F.round(c, 9).alias(c) for c in ("ks_statistic", "p_value", "ref_mean", "cur_mean", "ref_std", "cur_std")]
    return found.select("feature", "drift", "n_ref", "n_cur", *rounded)


def ks_drift_missing(spark, sf):
    """One feature has no value on the current side."""
    silver = _silver(spark, sf)
    baseline = features.user_features_monitor(silver.filter(F.col("ts") <= _middle(silver)))
    current = features.user_features_monitor(silver).withColumn("thumbs_up", F.lit(None).cast("long"))
    found = drift.ks_drift(baseline, current, exact_pairs=0)
    rounded = [F.round(c, 9).alias(c) for c in ("ks_statistic", "p_value", "cur_mean")]
    return found.select("feature", "drift", "n_ref", "n_cur", *rounded)


def ks_drift_days(spark, sf):
    """Plays and users of each day, the earlier days against the later ones: small samples, exact p-values."""
    silver = _silver(spark, sf)
    days = silver.groupBy(F.floor(F.col("ts") / adapters.DAY_MS).alias("day")).agg(
        F.count(F.lit(1)).alias("streams"), F.count_distinct("userId").alias("users")
    )
    days = scale.cut_lineage(days.crossJoin(days.agg(F.avg("day").alias("middle"))))  # one row
    earlier, later = days.filter("day <= middle"), days.filter("day > middle")
    found = drift.ks_drift(earlier, later, ["streams", "users"])
    rounded = [F.round(c, 9).alias(c) for c in ("ks_statistic", "p_value")]
    return found.select("feature", "drift", "n_ref", "n_cur", *rounded)


def _summary(spark, sf):
    return drift.drift_summary(_drift(spark, sf), "2024-01-31")


def drift_summary(spark, sf):
    return _summary(spark, sf).select(
        "n_baseline_users",
        "n_current_users",
        "dataset_drift",
        "drift_score",
        "n_drifted_cols",
        "n_total_cols",
        F.array_join("drifted_columns", ",").alias("drifted_columns"),
        "alert",
    )


def alerts(spark, sf):
    return drift.alerts(_summary(spark, sf)).select("type", "severity", "message")


def _share_scores(spark, sf):
    """A probability per user without a model: the share of the user's events that are no plays."""
    users = features.churn_label(features.user_features_v1(_silver(spark, sf)), "v1")
    prob = 1 - F.col("total_songs") / F.greatest(F.col("total_sessions"), F.lit(1))
    return users.withColumns({"churn_prob": prob, "prediction": F.when(prob > 0.8, 1.0).otherwise(0.0)})


def risk_tiers(spark, sf):
    scored = _share_scores(spark, sf)
    return scored.select(
        "userId",
        "level",
        "churn_prob",
        risk_level(F.col("churn_prob")).alias("risk_api"),
        risk_level(F.col("churn_prob"), inclusive=True).alias("risk_dashboard"),
    )


def churn_kpis(spark, sf):
    return churn.churn_kpis(_share_scores(spark, sf)).withColumn("avg_prob", F.round("avg_prob", 9))


def histogram(spark, sf):
    return churn.churn_histogram(_share_scores(spark, sf)).select("bin", F.round("bin_start", 6).alias("bin_start"), "count")


def confusion_matrix(spark, sf):
    return churn.confusion_matrix(_share_scores(spark, sf))


def top_at_risk(spark, sf):
    # Users with one row per level: the level is part of the key.
    scored = _share_scores(spark, sf).withColumn("userId", F.concat_ws("/", "userId", "level"))
    return churn.top_at_risk(scored)


def stable_sample_customers(spark, sf):
    people = spark.read.parquet(f"{sf}/customer.parquet")
    return churn.stable_sample(people, ["c_custkey"], 500).select("c_custkey", "c_name")


def lookup_churn(spark, sf):
    """The first user of the list, by the score without a model."""
    scored = _share_scores(spark, sf).withColumn("userId", F.concat_ws("/", "userId", "level"))
    return churn.lookup_churn(scored.agg(F.min("userId")).first()[0], scored)


def validation_verdict(spark, sf):
    """Order priorities as runs, the share of orders above the mean price as their AUC."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    mean = orders.agg(F.avg("o_totalprice")).scalar()
    runs = orders.groupBy("o_orderpriority").agg(F.avg((F.col("o_totalprice") > mean).cast("double")).alias("auc"))
    found = churn.validation_verdict(runs)
    return found.select("verdict", *[F.round(c, 9).alias(c) for c in ("mean_auc", "std_auc", "min_auc", "max_auc")])


def stable_sample(spark, sf):
    return churn.stable_sample(_share_scores(spark, sf), ["userId", "level"], 500).select(
        "userId", "level", "total_songs", "churn_prob"
    )


def _als(spark, sf, implicit=False):
    ratings, users, songs = jobs.dense_ratings(_silver(spark, sf))
    train, test = churn.holdout(ratings, key=PAIR)
    return recommend.train_als(train, implicit=implicit), train, test, users, songs


def als_recommendations(spark, sf):
    model, _, _, users, songs = _als(spark, sf)
    ranked = recommend.rank_recommendations(recommend.recommend_all(model, 10))
    named = recommend.decode_ids(scale.cut_lineage(ranked), songs, "song_idx", "song")
    return recommend.decode_ids(named, users, "user_idx", "userId", "user_").select(
        "userId", "rank", "song", "score"
    )


def als_recommendations_hashed(spark, sf):
    """Factor model on hashed ids, as published; the lists stay nested."""
    ratings = interactions.hash_ids(listening.play_counts(_silver(spark, sf)))
    merged = scale.cut_lineage(ratings.groupBy(*PAIR).agg(F.sum("play_count").alias("play_count")))
    return recommend.recommend_all(recommend.train_als(merged), 10)


def als_rmse(spark, sf):
    model, _, test, _, _ = _als(spark, sf)
    value = recommend.als_rmse(model, test)
    return test.agg(F.count(F.lit(1)).alias("n_test")).withColumn("rmse", F.lit(value))


def als_hit_rate(spark, sf):
    model, train, test, _, songs = _als(spark, sf, implicit=True)
    candidates = recommend.ranking_candidates(test, songs.count(), known=train)
    return recommend.als_hit_rate(model, candidates)


def _own_lists(positives: DataFrame) -> DataFrame:
    """Each user's ten best songs by own plays, nested like a factor model's."""
    best = recommend.top_k_scores(positives.select(*PAIR, F.col("play_count").alias("score")), 10)
    entry = F.struct("rank", "song_idx", F.col("score").cast("float").alias("rating"))
    nested = best.groupBy("user_idx").agg(F.sort_array(F.collect_list(entry)).alias("recommendations"))
    return nested.withColumn("recommendations", F.transform("recommendations", lambda r: F.struct(r["song_idx"].alias("song_idx"), r["rating"].alias("rating"))))


def recommendation_text(spark, sf):
    """The lists of the first twenty users as text."""
    positives, users, songs = jobs.dense_matrix(_silver(spark, sf))
    return recommend.recommendation_text(_own_lists(positives), users, songs, 20)


def lookup_recommendations(spark, sf):
    """The list of the user with the most plays."""
    positives, users, songs = jobs.dense_matrix(_silver(spark, sf))
    busiest = positives.groupBy("userId").agg(F.sum("play_count").alias("n")).orderBy(F.desc("n"), "userId").first()["userId"]
    own = positives.filter(F.col("userId") == busiest)
    return recommend.lookup_recommendations(busiest, _own_lists(own), users, songs, 10)


def _busiest(plays: DataFrame) -> str:
    return plays.groupBy("userId").agg(F.sum("play_count").alias("n")).orderBy(F.desc("n"), "userId").first()["userId"]


def als_lookup(spark, sf):
    """Factor model: only the looked-up user is scored, on the written factors."""
    model, train, _, users, songs = _als(spark, sf)
    stored = [scale.cut_lineage(f) for f in (model.userFactors, model.itemFactors)]
    return recommend.lookup_factors(_busiest(train), *stored, users, songs, 10)


def factor_recommendations(spark, sf):
    """Ten songs for every buyer, from factors that need no fit."""
    positives, users, songs = jobs.dense_matrix(adapters.order_plays(spark, sf))
    ranked = recommend.rank_recommendations(recommend.top_items(*recommend.co_listening_factors(positives), 10))
    return ranked.select("user_idx", "rank", "song_idx", F.col("score").cast("double").alias("score"))


def factor_lookup(spark, sf):
    """The list of the buyer with the most plays, from stored factors."""
    positives, users, songs = jobs.dense_matrix(adapters.order_plays(spark, sf))
    return recommend.lookup_factors(_busiest(positives), *recommend.co_listening_factors(positives), users, songs, 10)


def factor_rmse(spark, sf):
    """Error of the factors of the training pairs on the held-out ones."""
    positives, _, _ = jobs.dense_matrix(adapters.order_plays(spark, sf))
    train, test = churn.holdout(positives, key=PAIR)
    found = recommend.factor_rmse(test, *recommend.co_listening_factors(train))
    return found.select("pairs", F.round("rmse", 6).alias("rmse"))


def factor_hit_rate(spark, sf):
    """Share of users whose held-out song is among the ten best candidates by the factors of the training pairs."""
    positives, _, songs = jobs.dense_matrix(_silver(spark, sf))
    train, test = churn.holdout(positives, key=PAIR)
    candidates = recommend.ranking_candidates(test, songs.count(), known=train)
    return recommend.hit_rate(recommend.factor_scores(candidates, *recommend.co_listening_factors(train)))


def evaluate_scores(spark, sf):
    """Popularity as a score of held-out pairs against sampled negatives."""
    rows = interactions.stratified_split(_training(spark, sf), PARTS, "label", PAIR)
    known = rows.filter("split = 'train' and label = 1.0")
    scores = _popularity(known)
    top = scores.agg(F.max("score")).scalar()
    scored = (
        rows.filter("split = 'test'")
        .join(scores, "song_idx", "left")
        .withColumn("score", F.coalesce(F.col("score") / top, F.lit(0.0)))
    )
    found = recommend.evaluate_scores(scored)
    return found.select(F.round("accuracy", 9).alias("accuracy"), F.round("auc", 9).alias("auc"))


def evaluate_scores_lines(spark, sf):
    """Line prices as a score of returned lines: tens of thousands of distinct scores."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    scored = lines.select((F.col("l_returnflag") == "R").cast("double").alias("label"), F.col("l_extendedprice").cast("double").alias("score"))
    found = recommend.evaluate_scores(scored, limit=40_000.0)
    return found.select(F.round("accuracy", 9).alias("accuracy"), F.round("auc", 9).alias("auc"))


def _churn_table(spark, sf):
    return scale.cut_lineage(features.churn_label(features.user_features_v1(_silver(spark, sf)), "v1"))


def churn_predictions(spark, sf):
    labelled = _churn_table(spark, sf)
    train, _ = churn.holdout(labelled)
    return churn.predict_churn(churn.churn_pipeline().fit(train), labelled)


def churn_evaluation(spark, sf):
    labelled = _churn_table(spark, sf)
    train, test = churn.holdout(labelled)
    result = churn.evaluate_binary(churn.churn_pipeline().fit(train).transform(test))
    return test.agg(F.count(F.lit(1)).alias("n_test")).withColumns({m: F.lit(v) for m, v in result.items()})


def feature_importance(spark, sf):
    train, _ = churn.holdout(_churn_table(spark, sf))
    return churn.feature_importance(churn.churn_pipeline().fit(train))


def _validation_table(spark, sf):
    return _labelled(spark, sf).withColumnRenamed("churn_new", "churn")


def multi_seed_validation(spark, sf):
    return churn.multi_seed_validation(_validation_table(spark, sf))


def compare_feature_sets(spark, sf):
    return churn.compare_feature_sets(_validation_table(spark, sf))


def layer_stats(spark, sf):
    """Rows, newest event and events per minute of the raw events and of their first half."""
    raw = _raw(spark, sf)
    tables = {"all": raw, "half": raw.filter(F.col("ts") <= _middle(raw))}
    return quality.layer_rates(tables)


def layer_round_trip(spark, sf):
    """Two increments appended to a layer by page and read back as one."""
    raw, out = _raw(spark, sf), scale.new_folder(spark, "layer")
    layers.append_layer(raw.filter(F.col("ts") <= _middle(raw)), out)
    layers.append_layer(raw.filter(F.col("ts") > _middle(raw)), out)
    return layers.read_layer(spark, out).groupBy("page").agg(F.count(F.lit(1)).alias("events"), F.sum("itemInSession").alias("items"))


def latest_metrics(spark, sf):
    """Daily order totals as logged metrics; the newest day per priority."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    rows = orders.groupBy(
        F.col("o_orderpriority").alias("experiment"), F.to_date("o_orderdate").cast("timestamp").alias("run_ts")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))
    newest = runlog.latest_metrics(rows.withColumn("metric", F.lit("orders")))
    return newest.select("experiment", "metric", "value", text_time("run_ts").alias("run_ts"))


def _finish(query) -> None:
    query.awaitTermination()


def _stream_to_files(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and read its Parquet output back."""
    out = scale.new_folder(spark, name)
    _finish(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _live_silver(spark, sf):
    return clean.enrich_events(adapters.stream_raw_events(spark, sf))


def stream_ingest(spark, sf):
    """Payload text of the events as a stream, written to bronze and read back."""
    raw = adapters.stream_raw_events(spark, sf)
    payload = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    out = scale.new_folder(spark, "bronze")
    _finish(ingest.ingest(payload, f"{out}/rows", f"{out}/checkpoint", every=None))
    return spark.read.parquet(f"{out}/rows").select("ts", "userId", "sessionId", "page", "song")


def stream_silver(spark, sf):
    rows = _stream_to_files(spark, live.stream_silver(adapters.stream_raw_events(spark, sf)), "silver")
    return rows.select("ts", "userId", "sessionId", "page", "city", "browser")


def stream_velocity(spark, sf):
    rows = _stream_to_files(spark, live.stream_velocity(_live_silver(spark, sf)), "velocity")
    return rows.select(text_time("bucket").alias("bucket"), "events")


def stream_trending(spark, sf):
    rows = _stream_to_files(spark, live.stream_trending(_live_silver(spark, sf)), "trending")
    return rows.select(text_time("bucket").alias("bucket"), "song", "artist", "plays")


def stream_kpis(spark, sf):
    rows = _stream_to_files(spark, live.stream_kpis(_live_silver(spark, sf)), "kpis")
    # Users and songs are sketches.
    return rows.select(text_time("bucket").alias("bucket"), "streams", F.round("paid_pct", 9).alias("paid_pct"))


def stream_top_songs(spark, sf):
    """Top ten of every closed hour, written per micro-batch."""
    out = scale.new_folder(spark, "top")
    _finish(live.write_top(live.stream_trending(_live_silver(spark, sf)), f"{out}/rows", f"{out}/checkpoint", every=None))
    rows = spark.read.schema("bucket timestamp, song string, artist string, plays long").parquet(f"{out}/rows/epoch=*")
    return rows.withColumn("bucket", text_time("bucket"))


def stream_closed_sessions(spark, sf):
    rows = _stream_to_files(spark, live.closed_sessions(_live_silver(spark, sf)), "closed")
    return rows.select(
        "userId", text_time("started").alias("started"), text_time("ended").alias("ended"), "session_length"
    )


def _longest(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Each session's row with most events, over the updates of all epochs."""
    rows = spark.read.schema(schema).parquet(f"{out}/updates/epoch=*")
    return clean.latest_per_key(rows, ["userId", "sessionId"], [F.desc("session_length")])


ROWS_PER_FILE = 200_000


def _in_files(spark: SparkSession, sf: str, out: str, delay: Column | None = None) -> DataFrame:
    """The events as a stream of six parts in time order, one per micro-batch, each of as many files as the rows need; ``delay`` moves a row to a later file."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    sixth = F.ntile(6).over(W.orderBy("hour"))
    hours = events.select(F.date_trunc("hour", "ts").alias("hour")).distinct().withColumn("part", sixth)  # few rows
    parts = events.withColumn("hour", F.date_trunc("hour", "ts")).join(hours, "hour").drop("hour")
    if delay is not None:
        parts = parts.withColumn("part", F.least(F.lit(6), F.col("part") + delay))
    parts.write.partitionBy("part").parquet(f"{out}/dealt")  # the events are read and joined once
    files = max(1, -(-events.count() // (6 * ROWS_PER_FILE)))
    for part in range(1, 7):  # a file source goes by the age of files
        dealt = spark.read.schema(events.schema).parquet(f"{out}/dealt/part={part}")
        dealt.repartition(files, F.xxhash64("event_id")).write.parquet(f"{out}/part={part}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{out}/part=*")
    return clean.enrich_events(adapters.listening_events(stream))


def stream_session_sequences(spark, sf):
    out = scale.new_folder(spark, "sequences")
    silver = _in_files(spark, sf, f"{out}/events")
    _finish(live.stream_session_sequences(silver, out, f"{out}/checkpoint", every=None))
    rows = _longest(spark, out, live.SEQUENCES)
    return rows.withColumn("page_seq", F.concat_ws(",", F.transform("page_seq", lambda c: c.cast("string"))))


PART_REST_MS = 6 * 3_600_000


def stream_session_parts(spark, sf):
    """Sessions that end after six hours without an event; the state of ended ones is gone."""
    out = scale.new_folder(spark, "parts")
    silver = _in_files(spark, sf, f"{out}/events")
    _finish(live.stream_session_parts(silver, out, f"{out}/checkpoint", PART_REST_MS, every=None))
    rows = spark.read.schema(live.PARTS).parquet(f"{out}/updates/epoch=*")
    parts = clean.latest_per_key(rows, ["userId", "sessionId", "started"], [F.desc("session_length")])
    return parts.withColumn("page_seq", F.concat_ws(",", F.transform("page_seq", lambda c: c.cast("string"))))


def late_rows(spark, sf):
    """Every twentieth event comes two micro-batches late: the rows that each batch finds behind the watermark."""
    out = scale.new_folder(spark, "late")
    raw = _in_files(spark, sf, f"{out}/events", F.when(F.col("event_id") % 20 == 0, 2).otherwise(0))
    query = live.stream_silver(raw).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
    query = query.trigger(availableNow=True).start()
    _finish(query)
    found = [(batch, n) for batch, n in live.late_rows(query).items() if n]
    return spark.createDataFrame(found, "batch int, late long")


def _close(estimate: str, exact: str) -> Column:
    """Within three standard errors of the distinct-count sketch."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), 0.05 * F.col(exact))


def stream_kpi_sketches(spark, sf):
    """Closed hours of the stream, stored as sketches and united by day; users and songs against exact counts."""
    hours = _stream_to_files(spark, live.stream_kpi_sketches(_live_silver(spark, sf)), "sketches")
    days = listening.united_kpis(hours, F.to_date("bucket").alias("day"))
    rows = _silver(spark, sf).withColumn("bucket", F.date_trunc("hour", "event_time")).join(hours.select("bucket"), "bucket", "left_semi")
    exact = rows.groupBy(F.to_date("bucket").alias("day")).agg(F.count_distinct("userId").alias("_users"), F.count_distinct("song").alias("_songs"))
    return days.join(exact, "day").select(
        F.col("day").cast("string").alias("day"),
        "streams",
        F.round("paid_pct", 9).alias("paid_pct"),
        _close("users", "_users").alias("users_close"),
        _close("songs", "_songs").alias("songs_close"),
    )


def sketched_percentile(spark, sf):
    """P95 of each month from sketches of its days: whether its exact rank is within a percent."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    month = F.date_format("day", "yyyy-MM").alias("month")
    days = scale.cut_lineage(scale.daily_sketches(events, "ts", "value"))
    found = scale.merged_percentile(days.select(month, "sketch"), 0.95, "month")
    rows = events.filter("value IS NOT NULL").select(F.date_format("ts", "yyyy-MM").alias("month"), "value")
    shares = rows.join(F.broadcast(found), "month").groupBy("month", "rows").agg(  # one row a month
        F.avg((F.col("value") <= F.col("percentile")).cast("double")).alias("upper"),
        F.avg((F.col("value") < F.col("percentile")).cast("double")).alias("lower"),
    )
    return shares.select("month", "rows", ((F.col("lower") <= 0.96) & (F.col("upper") >= 0.94)).alias("close"))


def published_layer(spark, sf):
    """A table published twice: what a reader between the two and one after them see."""
    raw, out = _raw(spark, sf), scale.new_folder(spark, "gold")
    layers.publish_layer(raw.filter(F.col("ts") <= _middle(raw)), out)
    before = layers.read_published(spark, out)
    version = layers.publish_layer(raw, out)
    after = layers.read_published(spark, out)
    seen = [df.select(F.lit(v).alias("version"), "ts") for v, df in ((version - 1, before), (version, after))]
    return seen[0].unionByName(seen[1]).groupBy("version").agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("newest_ms"))


def unreadable_files(spark, sf):
    """Events in a layer with one file that is no Parquet file: events read, files left out."""
    raw, out = _raw(spark, sf), scale.new_folder(spark, "layer")
    layers.append_layer(raw, out)
    spark.range(1).select(F.lit("no parquet").alias("value")).write.mode("append").text(f"{out}/page=NextSong")
    rows = layers.read_layer(spark, out, skip_corrupt=True).agg(F.count(F.lit(1)).alias("events"))
    return rows.crossJoin(layers.unreadable_files(spark, out).agg(F.count(F.lit(1)).alias("left_out")))  # one row each


def gap_sessions(spark, sf):
    """Sessions of each user by gaps of half an hour."""
    return sessions.gap_sessions(_silver(spark, sf))


def stream_session_scores(spark, sf):
    """Sessions in progress scored with a model fitted on the batch sessions."""
    vectors = scale.cut_lineage(_vectors(spark, sf))
    model = sessions.fit_threshold(vectors, sessions.fit_session_model(vectors, sessions.COMPONENTS))
    out = scale.new_folder(spark, "scores")
    silver = _in_files(spark, sf, f"{out}/events")
    _finish(live.stream_session_scores(silver, model, out, f"{out}/checkpoint", every=None))
    return _longest(
        spark,
        out,
        "sessionId long, userId string, session_length long, recon_error double, is_anomaly int, anomaly_score double",
    )


@cache
def registry() -> dict[str, Query]:
    """Query name to function."""
    names = """
        parse_events clean_events dedupe_events split_location parse_user_agent parse_user_agent_blank
        incremental_filter incremental_filter_late incremental_filter_indexed increment_report parse_damaged_events rejected_events
        require_fields require_fields_blank null_profile layer_counts
        song_rankings play_counts listening_kpis value_counts_gender value_counts_level trending velocity
        top_artists top_artists_orders top_songs_per_hour top_songs_orders latest_events
        user_features_v1 user_features_v2 user_features_monitor latest_per_key
        churn_label_v1 churn_label_v3 label_comparison label_distribution label_disagreements
        interaction_matrix interaction_matrix_orders interaction_matrix_active matrix_stats dense_ids dense_ids_orders id_mapping hash_ids
        encode_interactions negative_samples negative_samples_dense training_set training_set_orders hash_split stratified_split
        stratified_split_exact class_balance hit_rate_at_k hit_rate_orders ranking_candidates
        ranking_candidates_orders own_plays_top_k decode_ids
        encode_names
        session_sequences session_sequences_users session_vectors session_stats anomaly_scores anomaly_share score_columns
        lookup_anomaly
        exact_percentile
        ks_drift ks_drift_missing ks_drift_days drift_summary alerts
        risk_tiers churn_kpis histogram confusion_matrix top_at_risk stable_sample
        stable_sample_customers lookup_churn validation_verdict
        als_recommendations als_recommendations_hashed als_rmse als_hit_rate recommendation_text
        lookup_recommendations als_lookup factor_recommendations factor_lookup factor_rmse factor_hit_rate
        evaluate_scores evaluate_scores_lines
        churn_predictions churn_evaluation feature_importance multi_seed_validation compare_feature_sets
        layer_stats layer_round_trip latest_metrics
        stream_ingest stream_silver stream_velocity stream_trending stream_kpis stream_top_songs stream_closed_sessions
        stream_session_sequences stream_session_scores stream_session_parts gap_sessions
        late_rows stream_kpi_sketches sketched_percentile published_layer unreadable_files
    """
    return {name: globals()[name] for name in names.split()}
