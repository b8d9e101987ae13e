import math
import re
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.operators import drift
from playtide.sources import layers, runlog


def brute_ks(a, b):
    values = np.unique(np.concatenate([a, b]))
    gaps = [abs((a <= v).mean() - (b <= v).mean()) for v in values]
    d = max(gaps)
    lam = d * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    return d, 1.0 if lam < 0.2 else min(1.0, max(0.0, p))


@pytest.fixture(autouse=True)
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(6)
    a = np.column_stack([rng.normal(size=700), rng.integers(0, 5, 700)])
    b = np.column_stack([rng.normal(0.3, 1, size=500), rng.integers(0, 5, 500)])
    build = lambda m: spark.createDataFrame([(float(x), float(y)) for x, y in m], "f double, g double")
    return a, b, build(a).repartition(5), build(b).repartition(3)


def test_ks_equals_brute_force_and_is_symmetric(samples):
    a, b, left, right = samples
    rows = {r.feature: r for r in drift.ks_drift(left, right, ["f", "g"]).collect()}
    back = {r.feature: r for r in drift.ks_drift(right, left, ["f", "g"]).collect()}
    for i, name in enumerate(["f", "g"]):
        d, p = brute_ks(a[:, i], b[:, i])
        assert rows[name].ks_statistic == pytest.approx(d, abs=1e-12)
        assert rows[name].p_value == pytest.approx(p, abs=1e-9)
        assert back[name].ks_statistic == pytest.approx(d, abs=1e-12)
        assert rows[name].ref_mean == pytest.approx(a[:, i].mean())
        assert rows[name].cur_std == pytest.approx(b[:, i].std(ddof=1))
    assert rows["f"].drift and not rows["g"].drift


def test_equal_sets_have_no_drift(samples):
    _, _, left, _ = samples
    for row in drift.ks_drift(left, left, ["f", "g"]).collect():
        assert row.ks_statistic == 0.0 and row.p_value == 1.0 and not row.drift


@pytest.mark.parametrize("drifted,dataset,alert", [(2, False, False), (3, False, True), (4, True, True), (9, True, True)])
def test_summary_limits(spark, drifted, dataset, alert):
    names = [f"f{i}" for i in range(9)]
    rows = [(n, i < drifted, 10, 20) for i, n in enumerate(names)]
    table = spark.createDataFrame(rows, "feature string, drift boolean, n_ref long, n_cur long")
    summary = drift.drift_summary(table, "2024-01-05", metrics={"hr10": 0.4, "churn_auc": None})
    row = summary.first()
    assert (row.dataset_drift, row.alert, row.drifted_columns) == (dataset, alert, names[:drifted])
    assert (row.hr10, row.churn_auc, row.n_current_users) == (0.4, None, 20)
    found = drift.alerts(summary).collect()
    assert len(found) == int(alert)
    if drifted == 3:
        assert found[0].message == "Drift score=0.33 | Drifted: ['f0', 'f1', 'f2']"


def test_a_side_without_values_gives_null(spark):
    some = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, b double")
    none = some.filter("a > 5")
    empty = {r.feature: r for r in drift.ks_drift(none, some, ["a", "b"]).collect()}
    assert all((r.ks_statistic, r.p_value, r.drift, r.n_ref) == (None, None, None, 0) for r in empty.values())
    half = drift.ks_drift(some, some.withColumn("b", F.lit(None).cast("double")), ["a", "b"])
    rows = {r.feature: r for r in half.collect()}
    assert rows["b"].p_value is None and rows["a"].p_value == 1.0
    summary = drift.drift_summary(half, "2024-01-05").first()
    assert (summary.n_untested_cols, summary.n_drifted_cols, summary.n_total_cols) == (1, 0, 2)


def test_history_skips_missing_days(spark, tmp_path):
    path = str(tmp_path / "summary")
    assert runlog.drift_history(spark, path) is None
    days = [("2024-01-01", 0.1), ("2024-01-20", 0.2), ("2024-01-30", 0.3)]
    rows = spark.createDataFrame(days, "date string, drift_score double").withColumn("day", F.col("date").cast("date"))
    layers.write_json(rows, path, by="day")
    history = runlog.drift_history(spark, path, days=20, today="2024-01-31")
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day", plan)
    found = history.collect()
    assert [r.date for r in found] == [date(2024, 1, 20), date(2024, 1, 30)]
    assert runlog.latest_report(spark, path, today="2024-01-31").first().drift_score == 0.3
    assert runlog.latest_report(spark, path, today="2024-02-20").count() == 0


def test_run_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert runlog.latest_metric(spark, path, "churn", "auc") is None
    runlog.log_metrics(runlog.metric_rows(spark, "churn", {"auc": 0.6, "f1": 0.5}, datetime(2024, 1, 1)), path)
    runlog.log_metrics(runlog.metric_rows(spark, "churn", {"auc": 0.7, "f1": None}, datetime(2024, 1, 2)), path)
    assert runlog.latest_metric(spark, path, "churn", "auc") == 0.7
    assert runlog.latest_metric(spark, path, "churn", "f1") is None


def test_exact_p_counts_all_orders(spark):
    """Every order of two small samples, and the scipy values of larger ones as fixed numbers."""
    from itertools import combinations

    rows, wanted = [], []
    for n1, n2 in [(1, 1), (3, 4), (5, 5), (2, 7)]:
        reached = []
        for chosen in combinations(range(n1 + n2), n1):
            i = j = most = 0
            for k in range(n1 + n2):
                i, j = i + (k in chosen), j + (k not in chosen)
                most = max(most, abs(i * n2 - j * n1))
            reached.append(most)
        for reach in sorted(set(reached)):
            rows.append((reach / (n1 * n2), n1, n2))
            wanted.append(sum(r >= reach for r in reached) / len(reached))
    df = spark.createDataFrame(rows, "d double, n1 long, n2 long")
    found = [r[0] for r in df.select(drift.two_sample_p(F.col("d"), F.col("n1"), F.col("n2"))).collect()]
    assert found == pytest.approx(wanted, abs=1e-12)
    large = df.select(drift.two_sample_p(F.lit(18 / 201), F.lit(201), F.lit(201)).alias("exact"), drift.kolmogorov_p(F.lit(18 / 201), F.lit(201), F.lit(201)).alias("far")).first()
    assert abs(large.exact - large.far) < 0.05 and large.exact != large.far
