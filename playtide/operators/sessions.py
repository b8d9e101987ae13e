"""Session sequences, reconstruction error and anomaly scores.

The reconstruction model is PCA with 16 components: the same vectors, error
formula, threshold rule and output table as an autoencoder with a bottleneck of
that width, but other numeric scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from playtide.functions.columns import minus, page_code, scaled_sequence, squared_norm
from playtide.operators.scale import carried, cut_lineage, exact_percentile, stored_ranges
from playtide.schema import MAX_SESSION_LENGTH, MIN_SESSION_LENGTH, SESSION_KEY

COMPONENTS = 16
ROUNDING = 1e-12


def gap_sessions(events: DataFrame, gap_ms: int = 30 * 60_000, by: str = "userId", time: str = "ts") -> DataFrame:
    """Sessions by inactivity gap, for sources without a session id, in batch.

    A session starts at an event more than ``gap_ms`` after the one before and ends
    ``gap_ms`` after its last event. Events are sorted in ranges of (user, time), so
    the events of a hot user lie in many tasks; a range learns from one carried row
    when the user's last event and last start before it were. Events without a user
    or a time are left out.
    """
    known = events.filter(F.col(by).isNotNull() & F.col(time).isNotNull()).select(by, time)
    ranges = stored_ranges(known, by, time)
    _, last = carried(ranges, by, time, F.col(time))
    before = F.coalesce(F.lag(time).over(W.partitionBy("_part", by).orderBy(time)), F.col("_carry"))
    opens = F.when(before.isNull() | (F.col(time) - before > gap_ms), F.col(time))
    marked = cut_lineage(ranges.join(F.broadcast(last), [by, "_part"], "left").select(by, time, "_part", opens.alias("_opens")))
    inside, first = carried(marked, by, time, F.col("_opens"))
    placed = marked.withColumn("_inside", inside).join(F.broadcast(first), [by, "_part"], "left")
    return (
        placed.groupBy(by, F.coalesce("_inside", "_carry").alias("started"))
        .agg((F.max(time) + gap_ms).alias("ended"), F.count(F.lit(1)).alias("session_length"))
        .select(by, "started", "ended", "session_length")
    )


def session_sequences(
    df: DataFrame,
    max_len: int = MAX_SESSION_LENGTH,
    min_len: int = MIN_SESSION_LENGTH,
    by_session_only: bool = False,
) -> DataFrame:
    """First ``max_len`` page codes of each session and its full length.

    Only the rows that can be among the first ``max_len`` of a session leave a
    task, and lengths are counted before the shuffle, so no session is ever
    collected whole. ``by_session_only`` keys sessions by their id alone, with
    the user of the earliest event.
    """
    key = ["sessionId"] if by_session_only else list(SESSION_KEY)
    known = df.filter(F.col("page").isNotNull() & F.col("sessionId").isNotNull()).select(
        "userId", "sessionId", "ts", "itemInSession", "page"
    )
    in_order = W.partitionBy(*key).orderBy("ts", "itemInSession", "page", "userId")
    head = known.withColumn("_at", F.row_number().over(in_order)).filter(F.col("_at") <= max_len)
    entries = F.sort_array(F.collect_list(F.struct("_at", page_code(F.col("page")).alias("code"))))
    sequences = head.groupBy(*key).agg(
        entries.alias("_entries"), *([F.min_by("userId", "_at").alias("userId")] if by_session_only else [])
    )
    lengths = known.groupBy(*key).agg(F.count(F.lit(1)).alias("session_length"))
    long_enough = lengths.filter(F.col("session_length") >= min_len)
    return (
        sequences.join(long_enough, key)
        .withColumn("page_seq", F.col("_entries.code"))
        .select("userId", "sessionId", "session_length", "page_seq")
    )


def session_vectors(sequences: DataFrame, max_len: int = MAX_SESSION_LENGTH) -> DataFrame:
    """Fixed-length vector ``x`` per session."""
    return sequences.select(
        "userId", "sessionId", "session_length", scaled_sequence(F.col("page_seq"), max_len).alias("x")
    )


def session_stats(sequences: DataFrame) -> DataFrame:
    """Valid sessions, mean and maximum length."""
    return sequences.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.avg("session_length").alias("mean_length"),
        F.max("session_length").alias("max_length"),
    )


class SessionModel:
    """Principal components of session vectors, their mean, and an error threshold."""

    def __init__(self, pca: PCAModel, mean: Sequence[float], threshold: float | None = None):
        self.pca = pca
        self.mean = [float(v) for v in mean]
        self.threshold = threshold
        # The fitted transform does not centre, so it also shifts by this much.
        self.mean_projected = [float(v) for v in pca.pc.toArray().T.dot(self.mean)]


def fit_session_model(vectors: DataFrame, k: int = COMPONENTS) -> SessionModel:
    """Fit on all session vectors; only the k x length matrix reaches the driver."""
    features = vectors.select(array_to_vector("x").alias("features"))
    mean = features.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    return SessionModel(PCA(k=k, inputCol="features", outputCol="projected").fit(features), mean)


def reconstruction_error(vectors: DataFrame, model: SessionModel) -> DataFrame:
    """Mean squared difference between each vector and its reconstruction.

    The components are orthonormal, so the squared error is what the centred
    vector has beyond its projection. Rounding noise counts as no error.
    """
    projected = model.pca.transform(vectors.withColumn("features", array_to_vector("x")))
    kept = squared_norm(minus(vector_to_array("projected"), model.mean_projected))
    lost = squared_norm(minus(F.col("x"), model.mean)) - kept
    error = F.when(lost > ROUNDING, lost).otherwise(0.0) / F.size("x")
    return projected.withColumn("recon_error", error).drop("features", "projected")


def score_columns(error: Column, threshold: Column) -> dict[str, Column]:
    """Flag and score, the error over the threshold kept within 0..5."""
    relative = F.when(threshold > 0, error / threshold).otherwise(F.when(error > 0, 5.0).otherwise(0.0))
    return {
        "is_anomaly": (error > threshold).cast("int"),
        "anomaly_score": F.least(F.greatest(relative, F.lit(0.0)), F.lit(5.0)),
    }


def fit_threshold(vectors: DataFrame, model: SessionModel, pct: float = 95) -> SessionModel:
    """Set the threshold to a percentile of the training errors."""
    errors = reconstruction_error(vectors, model)
    return SessionModel(model.pca, model.mean, exact_percentile(errors, "recon_error", pct / 100))


def anomaly_scores(
    vectors: DataFrame, model: SessionModel | None = None, pct: float = 95, k: int = COMPONENTS
) -> DataFrame:
    """Score every session, fitting model and threshold when not given."""
    if model is None:
        vectors = cut_lineage(vectors)
        model = fit_session_model(vectors, k)
    if model.threshold is None:
        model = fit_threshold(vectors, model, pct)
    scored = reconstruction_error(vectors, model)
    return scored.withColumns(score_columns(F.col("recon_error"), F.lit(model.threshold))).select(
        "sessionId", "userId", "session_length", "recon_error", "is_anomaly", "anomaly_score"
    )


def anomaly_share(scores: DataFrame) -> DataFrame:
    """Sessions, anomalous ones and their share."""
    return scores.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("is_anomaly").cast("long").alias("anomalies"),
        F.avg("is_anomaly").alias("share"),
    )


def lookup_anomaly(session_id: int, scores: DataFrame) -> DataFrame:
    """Stored score of a session; empty when unknown."""
    return scores.filter(F.col("sessionId") == session_id)
