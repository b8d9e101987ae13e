import random

import pytest

from playtide.operators import churn
from playtide.schema import CHURN_FEATURES


@pytest.fixture(scope="module")
def users(spark):
    """Users who leave when they dislike much."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        values = [rng.random() for _ in CHURN_FEATURES]
        rows.append((f"u{i}", rng.choice("MF"), int(values[1] > 0.6), 0, *values))
    names = ", ".join(f"{f} double" for f in CHURN_FEATURES)
    return spark.createDataFrame(rows, f"userId string, gender string, churn int, cancel_count long, {names}")


@pytest.fixture(scope="module")
def fitted(users):
    train, test = churn.holdout(users)
    return churn.churn_pipeline().fit(train), train, test


def test_holdout_is_stable_and_disjoint(users):
    train, test = churn.holdout(users, seed=1)
    names = {r.userId for r in train.collect()}
    assert names == {r.userId for r in churn.holdout(users.repartition(9), seed=1)[0].collect()}
    assert names.isdisjoint(r.userId for r in test.collect()) and train.count() + test.count() == 300


def test_model_finds_the_signal(fitted, users):
    model, _, test = fitted
    result = churn.evaluate_binary(model.transform(test))
    assert result["auc"] > 0.95 and 0 <= result["f1"] <= 1 and 0 <= result["accuracy"] <= 1
    weights = churn.feature_importance(model).collect()
    assert weights[0].feature == "thumbs_down" and len(weights) == 10
    assert sum(r.importance for r in weights) == pytest.approx(1.0)
    pred = churn.predict_churn(model, users)
    assert pred.count() == 300 and pred.filter("churn_prob between 0 and 1").count() == 300
    unseen = users.limit(5).replace(["M", "F"], ["X", "X"], "gender")
    assert churn.predict_churn(model, unseen).count() == 5


def test_area_equals_counting_pairs(spark):
    """Ties, scores in several ranges, rows without a score, one class only."""
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.choice([None, *(i / 8 for i in range(40))])) for _ in range(700)]
    df = spark.createDataFrame(rows, "churn int, score double").repartition(6)
    known = [(c, s) for c, s in rows if s is not None]
    pos, neg = ([s for c, s in known if c == k] for k in (1, 0))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert churn.area_under_roc(df) == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    assert churn.area_under_roc(df.filter("churn = 1")) == churn.area_under_roc(df.limit(0)) == 0.5


def test_multi_seed_and_verdict(spark, users):
    runs = churn.multi_seed_validation(users, seeds=(1, 7), iterations=2)
    rows = {r.seed: r for r in runs.collect()}
    assert set(rows) == {1, 7} and all(r.n_train + r.n_test == 300 and 0 <= r.auc <= 1 for r in rows.values())
    again = {r.seed: r.auc for r in churn.multi_seed_validation(users, seeds=(1, 7), iterations=2).collect()}
    assert again == {s: r.auc for s, r in rows.items()}
    for aucs, verdict in (
        ((0.5, 0.9), "reject: unstable"),
        ((0.50, 0.51), "reject: no signal"),
        ((0.7, 0.72), "accept"),
    ):
        table = spark.createDataFrame([(a,) for a in aucs], "auc double")
        assert churn.validation_verdict(table).first().verdict == verdict


def test_views_of_predictions(spark):
    probs = [0.7, 0.4, 0.39, 0.95, 0.69]
    rows = [(f"u{i}", int(p > 0.5), p, float(p > 0.5), 10, i) for i, p in enumerate(probs)]
    pred = spark.createDataFrame(
        rows, "userId string, churn int, churn_prob double, prediction double, total_songs long, cancel_count long"
    )
    kpis = churn.churn_kpis(pred).first()
    assert (kpis.users, kpis.high_risk, kpis.medium_risk) == (5, 2, 2)
    top = churn.top_at_risk(pred, 2).collect()
    assert [(r.userId, r.risk) for r in top] == [("u3", "95.0%"), ("u0", "70.0%")]
    assert sum(r["count"] for r in churn.churn_histogram(pred).collect()) == 5
    assert {(r.churn, r.prediction): r["count"] for r in churn.confusion_matrix(pred).collect()} == {(1, 1.0): 3, (0, 0.0): 2}
    row = churn.lookup_churn("u0", pred).first()
    assert row.is_churn and row.risk_level == "medium"
    assert churn.lookup_churn("nobody", pred).count() == 0
    sample = churn.stable_sample(pred, ["userId"], 3)
    assert sample.count() == 3 and sorted(sample.collect()) == sorted(churn.stable_sample(pred.repartition(4), ["userId"], 3).collect())
