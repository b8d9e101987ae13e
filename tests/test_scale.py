import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.operators import scale


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small data would be coalesced into one partition and hide mistakes between partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_global_positions_are_a_bijection(spark):
    rng = random.Random(2)
    values = [(rng.randrange(10**6),) for _ in range(5000)]
    df = spark.createDataFrame(values, "v int").repartition(7)
    rows = scale.global_positions(df, ["v"]).collect()
    assert sorted(r.position for r in rows) == list(range(5000))
    assert [r.v for r in sorted(rows, key=lambda r: r.position)] == sorted(v for (v,) in values)


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), v, rng.randrange(5), rng.randrange(5)) for v in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, x long, y long").repartition(5)
    ranges = scale.stored_ranges(df, "g", "v")
    assert ranges.select("_part").distinct().count() > 1
    running = scale.running_totals(ranges, "g", "v", ["x", "y"])
    found = {(r.g, r.v): (r.running_x, r.running_y) for r in running.collect()}
    totals = {"a": [0, 0], "b": [0, 0]}
    for g, v, x, y in rows:
        totals[g][0] += x
        totals[g][1] += y
        assert found[g, v] == tuple(totals[g])


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, fraction):
    values = np.random.default_rng(4).normal(size=1001)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    assert scale.exact_percentile(df, "x", fraction) == pytest.approx(np.percentile(values, fraction * 100), abs=1e-12)


def test_exact_percentile_of_nothing(spark):
    assert scale.exact_percentile(spark.createDataFrame([], "x double"), "x", 0.5) is None


def test_shared_folder_is_the_configured_one(spark):
    assert scale.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_percentile_of_ties_counts_equal_values_first(spark):
    """Nine of ten rows share one value: it is one row of the sort, whatever their number."""
    df = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("v"))
    values = [float(r.v) for r in df.collect()]
    for share in (0.5, 0.9, 0.95, 1.0):
        assert scale.exact_percentile(df, "v", share) == pytest.approx(float(np.quantile(values, share)))
    counted = df.groupBy("v").count()
    assert counted.count() == 4_000


def test_adaptive_execution_splits_three_hundred_hot_keys(spark):
    """No list of hot keys: a join on keys of any skew gives the plain result."""
    left = spark.range(60_000).select((F.col("id") % 300).alias("key"), "id")
    right = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    assert left.join(right, "key").count() == 60_000


def test_a_cluster_refuses_folders_of_one_machine(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            value = "file:/tmp/x"

            @classmethod
            def get(cls, key, default=None):
                return cls.value

    with pytest.raises(ValueError):
        scale.shared_folder(Session())
    Session.conf.value = None
    with pytest.raises(ValueError):
        scale.shared_folder(Session())
    Session.conf.value = "hdfs://x/y"
    assert scale.shared_folder(Session()) == "hdfs://x/y"


def test_merged_sketches_have_a_bounded_rank_error(spark):
    rows = spark.range(200_000).selectExpr("timestamp_seconds(id * 20) AS ts", "pmod(hash(id), 100000) AS v")
    days = scale.daily_sketches(rows.unionByName(spark.sql("SELECT timestamp_seconds(0) AS ts, CAST(NULL AS INT) AS v")), "ts", "v")
    assert days.count() == 47
    for fraction in (0.05, 0.5, 0.95):
        found = scale.merged_percentile(days, fraction).first()
        below = rows.filter(F.col("v") <= found.percentile).count()
        assert found.rows == 200_000 and abs(below / 200_000 - fraction) < 0.01
        one = scale.merged_percentile(days, fraction, "day").filter("day = '1970-01-03'").first()
        exact = scale.exact_percentile(rows.filter("to_date(ts) = '1970-01-03'"), "v", fraction)
        assert one.rows == 4_320 and abs(one.percentile - exact) < 2_000
    assert scale.merged_percentile(days.limit(0), 0.5).count() == 0
