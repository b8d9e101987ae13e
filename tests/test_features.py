from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playtide.functions.columns import risk_level
from playtide.operators import clean, features, quality


@pytest.fixture(scope="module")
def users(events):
    day = 86_400_000
    rows = [
        {"userId": "a", "ts": 0, "page": "Thumbs Down", "level": "paid"},
        {"userId": "a", "ts": day, "page": "NextSong", "level": "paid", "song": "s", "artist": "x"},
        {"userId": "a", "ts": 2 * day, "page": "Downgrade", "level": "free"},
        {"userId": "b", "ts": 2 * day + 5, "page": "Thumbs Up", "level": "free"},
        {"userId": "c", "ts": 0, "page": "Downgrade", "level": "free"},
        {"userId": "c", "ts": 9 * day, "page": "Upgrade", "level": "paid"},
        {"userId": "d", "ts": 7, "page": "Error", "level": "free"},
        {"userId": "d", "ts": 7, "page": "Add Friend", "level": "paid"},
    ]
    return clean.add_times(events(*[{"sessionId": 1, "gender": "F", **r} for r in rows]))


def test_v1_splits_a_user_by_level(users):
    rows = {(r.userId, r.level): r for r in features.user_features_v1(users).collect()}
    assert len(rows) == 7  # a, c and d changed level
    paid = rows["a", "paid"]
    assert (paid.total_songs, paid.thumbs_down, paid.total_sessions) == (1, 1, 2)
    assert paid.days_active == 10 and paid.dislike_ratio == 1.0 and paid.avg_sessions_per_day == 0.2
    assert rows["b", "free"].dislike_ratio == 0.0


def test_v2_has_one_row_per_user_with_the_newest_level(users):
    rows = {r.userId: r for r in features.user_features_v2(users).collect()}
    assert {u: r.current_level for u, r in rows.items()} == {"a": "free", "b": "free", "c": "paid", "d": "paid"}
    assert rows["b"].like_dislike_ratio == 2.0  # no thumbs down: ups + 1
    assert rows["a"].like_dislike_ratio == 0.0
    assert rows["d"].error_rate == 0.5 and rows["d"].social_actions == 1
    assert rows["c"].upgrade_count == 1


def test_labels(users):
    v2 = features.churn_label(features.user_features_v2(users), "compare")
    rows = {r.userId: (r.churn_new, r.churn_old) for r in v2.collect()}
    assert rows == {"a": (1, 1), "b": (0, 1), "c": (0, 0), "d": (0, 0)}
    v1 = features.churn_label(features.user_features_v1(users), "v1")
    assert {(r.userId, r.level) for r in v1.filter("churn = 1").collect()} == {("a", "free"), ("c", "free")}
    assert {r.userId: r.reason for r in quality.label_disagreements(v2).collect()} == {
        "b": "label_changed",
        "c": "returned",
    }
    assert quality.label_disagreements(v2, 1).count() == 1
    with pytest.raises(ValueError):
        features.churn_label(v2, "v9")


def test_monitor_counts_sessions_once_and_whole_days(users):
    rows = {r.userId: r for r in features.user_features_monitor(users).collect()}
    assert rows["a"].total_sessions == 1 and rows["a"].days_active == 9
    assert rows["b"].days_active == 6
    assert features.user_features_monitor(users.filter("userId = 'b'")).first().days_active == 1


def test_latest_per_key_breaks_ties(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([("u", at, 1, "free"), ("u", at, 2, "paid")], "userId string, t timestamp, i int, l string")
    assert clean.latest_per_key(df, ["userId"], [F.desc("t"), F.desc("i")]).first().l == "paid"


def test_risk_tiers_at_the_limits(spark):
    df = spark.createDataFrame([(0.7,), (0.4,), (0.71,), (0.1,)], "p double")
    strict = [r[0] for r in df.select(risk_level(F.col("p"))).collect()]
    inclusive = [r[0] for r in df.select(risk_level(F.col("p"), inclusive=True)).collect()]
    assert strict == ["medium", "low", "high", "low"]
    assert inclusive == ["high", "medium", "high", "low"]
