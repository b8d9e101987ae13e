"""Churn classifier, its evaluation, and the views of its predictions."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from playtide.functions.columns import risk_level, stable_hash, stable_uniform
from playtide.operators.quality import histogram, top_n
from playtide.operators.scale import cut_lineage, stored_ranges
from playtide.schema import CHURN_EXTENDED_FEATURES, CHURN_FEATURES, VALIDATION_SEEDS


def gbt_classifier(iterations: int = 10, seed: int = 42, label: str = "churn", subsample: bool = True) -> GBTClassifier:
    """M9: boosted trees; the settings are fixed values. The notebook setting is 20 iterations without subsampling."""
    gbt = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=iterations, maxDepth=4, stepSize=0.1, seed=seed
    )
    if subsample:
        gbt = gbt.setSubsamplingRate(0.8).setFeatureSubsetStrategy("0.8")
    return gbt


def churn_pipeline(features: Sequence[str] = CHURN_FEATURES, classifier=None) -> Pipeline:
    """M8: gender index, feature vector, classifier. Any MLlib-style classifier fits in."""
    indexer = StringIndexer(inputCol="gender", outputCol="gender_idx", handleInvalid="keep")
    assembler = VectorAssembler(
        inputCols=["gender_idx", *features], outputCol="features", handleInvalid="keep"
    )
    return Pipeline(stages=[indexer, assembler, classifier or gbt_classifier()])


def holdout(df: DataFrame, seed: int = 42, train_share: float = 0.8, key: Sequence[str] = ("userId",)):
    """Stable train and test parts. Rows of one user stay together."""
    in_train = stable_uniform(seed, *key) < train_share
    return df.filter(in_train), df.filter(~in_train)


def _standings(scored: DataFrame, label: str, score: str, *by: str) -> DataFrame:
    """Rows counted by (score, label, ``by``), with ``_won``: the negatives that a positive of that score beats, ties half.

    The counts are sorted and stored once; a running total over their ranges
    gives the negatives below, so no size is approximated and nothing is joined
    but one row per range. Rows without a score are left out.
    """
    positive = F.col(label).cast("double") == 1
    counted = (
        scored.groupBy(F.col(score).cast("double").alias("_score"), positive.alias("_positive"), *by)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_score").isNotNull())
        .withColumn("_neg", F.when(~F.col("_positive"), F.col("_n")).otherwise(0))
    )
    ranges = stored_ranges(counted, "_score")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.groupBy("_part").agg(F.sum("_neg").alias("_sum"))  # one row per range
    starts = starts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    upto = F.sum("_neg").over(W.partitionBy("_part").orderBy("_score").rangeBetween(W.unboundedPreceding, W.currentRow))
    equal = F.sum("_neg").over(W.partitionBy("_part", "_score"))
    return ranges.withColumn("_upto", upto - equal / 2.0).join(F.broadcast(starts), "_part").withColumn(
        "_won", F.when(F.col("_positive"), F.col("_n") * (F.col("_start") + F.col("_upto"))).otherwise(0.0)
    )


def _area(won: float | None, positives: int | None, negatives: int | None) -> float:
    return float(won / (positives * negatives)) if positives and negatives else 0.5


def area_under_roc(scored: DataFrame, label: str = "churn", score: str = "score") -> float:
    """Exact area under the ROC curve of a numeric score, ties counting half; 0.5 when a class is missing."""
    positives = F.sum(F.when(F.col("_positive"), F.col("_n")))
    return _area(*_standings(scored, label, score).agg(F.sum("_won"), positives, F.sum("_neg")).first())


def with_score(predicted: DataFrame) -> DataFrame:
    """Rows of a fitted classifier with the score of class 1 as a plain column."""
    return predicted.withColumn("score", vector_to_array("rawPrediction")[1])


def evaluate_binary(scored: DataFrame, label: str = "churn") -> dict[str, float]:
    """AUC, accuracy and F1 weighted by class, from one count by (score, label, prediction)."""
    rows = with_score(scored).select(F.col(label).cast("double").alias("label"), "score", "prediction")
    standings = _standings(rows, "label", "score", "label", "prediction")
    found = standings.groupBy("label", "prediction").agg(F.sum("_n").alias("n"), F.sum("_won").alias("won")).collect()
    table = {(r["label"], r["prediction"]): r["n"] for r in found}
    total, f1 = sum(table.values()), 0.0
    for c in {k[0] for k in table}:
        hits = table.get((c, c), 0)
        actual, called = (sum(n for k, n in table.items() if k[i] == c) for i in (0, 1))
        f1 += actual / total * (2 * hits / (actual + called))
    right = sum(n for (a, b), n in table.items() if a == b)
    sizes = [sum(n for (a, _), n in table.items() if a is not None and (a == 1) == positive) for positive in (True, False)]
    return {"auc": _area(sum(r["won"] for r in found), *sizes), "accuracy": right / total if total else 0.0, "f1": f1}


def predict_churn(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Scores of all users with the probability as a plain double."""
    return model.transform(df).select(
        "userId",
        "churn",
        vector_to_array("probability")[1].alias("churn_prob"),
        "prediction",
        "total_songs",
        "dislike_ratio",
        "cancel_count",
    )


def feature_importance(model: PipelineModel) -> DataFrame:
    """Importance of each input, largest first."""
    inputs = model.stages[-2].getInputCols()
    weights = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    from pyspark.sql import SparkSession

    rows = SparkSession.active().createDataFrame(
        list(zip(inputs, weights)), "feature string, importance double"
    )
    return rows.orderBy(F.desc("importance"), "feature")


def multi_seed_validation(
    df: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    seeds: Sequence[int] = VALIDATION_SEEDS,
    iterations: int = 20,
    classifier=None,
    parallelism: int = 7,
) -> DataFrame:
    """One row per seed with the AUC on that seed's 20 % hold-out.

    The per-user table is stored once, so the seeds do not re-read the events.
    The fits do not depend on each other and are submitted ``parallelism`` at a
    time, which fills a cluster that one fit of many short stages cannot.
    """
    stored = cut_lineage(df)

    @inheritable_thread_target(df.sparkSession)
    def run(seed: int) -> tuple[int, float, int, int]:
        train, test = holdout(stored, seed)
        chosen = classifier or gbt_classifier(iterations, subsample=False)
        scored = churn_pipeline(features, chosen).fit(train).transform(test)
        return int(seed), area_under_roc(with_score(scored)), train.count(), test.count()

    with ThreadPool(min(parallelism, len(seeds))) as pool:
        rows = pool.map(run, seeds)
    return df.sparkSession.createDataFrame(rows, "seed int, auc double, n_train long, n_test long")


# Limits of the verdict.
def validation_verdict(runs: DataFrame, max_std: float = 0.08, min_mean: float = 0.55) -> DataFrame:
    """Spread over the seeds and whether the model may be used."""
    stats = runs.agg(
        F.avg("auc").alias("mean_auc"),
        F.stddev_samp("auc").alias("std_auc"),
        F.min("auc").alias("min_auc"),
        F.max("auc").alias("max_auc"),
    )
    verdict = (
        F.when(F.col("std_auc") > max_std, "reject: unstable")
        .when(F.col("mean_auc") < min_mean, "reject: no signal")
        .otherwise("accept")
    )
    return stats.withColumn("verdict", verdict)


def compare_feature_sets(
    df: DataFrame, seeds: Sequence[int] = VALIDATION_SEEDS, iterations: int = 20
) -> DataFrame:
    """Verdicts of the base and the extended features on the same seeds."""
    stored = cut_lineage(df)

    def run(name: str, features: Sequence[str]) -> DataFrame:
        runs = multi_seed_validation(stored, features, seeds, iterations)
        return validation_verdict(runs).withColumn("feature_set", F.lit(name))

    return run("base", CHURN_FEATURES).unionByName(run("extended", CHURN_EXTENDED_FEATURES))


def churn_kpis(pred: DataFrame) -> DataFrame:
    """Users, users at high and medium risk, mean probability."""
    tier = risk_level(F.col("churn_prob"), inclusive=True)
    return pred.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(tier == "high").alias("high_risk"),
        F.count_if(tier == "medium").alias("medium_risk"),
        F.avg("churn_prob").alias("avg_prob"),
    )


def churn_histogram(pred: DataFrame, bins: int = 20) -> DataFrame:
    """A18 on the churn probability."""
    return histogram(pred, "churn_prob", bins, 0.0, 1.0)


def confusion_matrix(pred: DataFrame, label: str = "churn") -> DataFrame:
    """Users per (label, prediction)."""
    return pred.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("count"))


def top_at_risk(pred: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` users most likely to churn, with the risk as percent text."""
    best = top_n(pred, n, [F.desc("churn_prob"), "userId"])
    return best.select(
        "userId",
        "churn_prob",
        F.format_string("%.1f%%", F.col("churn_prob") * 100).alias("risk"),
        "total_songs",
        "cancel_count",
    )


def stable_sample(df: DataFrame, key: Sequence[str], n: int = 500, seed: int = 42) -> DataFrame:
    """Random ``n`` rows, the same on every run; each task keeps only ``n``."""
    return top_n(df, n, [stable_hash(seed, *key), *key])


def lookup_churn(user: str, pred: DataFrame) -> DataFrame:
    """One user's churn probability, flag and risk tier."""
    return pred.filter(F.col("userId") == user).select(
        "userId",
        "churn_prob",
        (F.col("churn_prob") > 0.5).alias("is_churn"),
        risk_level(F.col("churn_prob")).alias("risk_level"),
    )
