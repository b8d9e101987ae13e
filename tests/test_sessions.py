import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.operators import sessions
from playtide.schema import PAGE_VOCABULARY


def visits(user, session, pages):
    return [
        {"userId": user, "sessionId": session, "ts": i, "itemInSession": i, "page": page} for i, page in enumerate(pages)
    ]


def test_sequence_lengths_and_codes(events):
    rows = visits("a", 1, ["Home", "NextSong"])
    rows += visits("a", 2, ["Home"] * 50) + visits("a", 3, ["Home"] * 50 + ["Help"])
    rows += visits("b", 2, ["Nowhere", "NextSong", "Help"])
    rows += [{"userId": "b", "sessionId": 2, "ts": 9, "page": None}, {"userId": "b", "ts": 9, "page": "Home"}]
    found = {(r.userId, r.sessionId): r for r in sessions.session_sequences(events(*rows[::-1])).collect()}
    assert set(found) == {("a", 2), ("a", 3), ("b", 2)}
    assert found["a", 3].session_length == 51 and found["a", 3].page_seq == [1] * 50
    assert found["b", 2].page_seq == [0, 2, 10]


def test_by_session_only_merges_users(events):
    rows = visits("a", 1, ["Home", "NextSong"]) + [{"userId": "b", "sessionId": 1, "ts": 50, "page": "Help"}]
    row = sessions.session_sequences(events(*rows), by_session_only=True).first()
    assert (row.userId, row.session_length, row.page_seq) == ("a", 3, [1, 2, 10])


def test_vectors_are_padded_and_scaled(events):
    df = sessions.session_sequences(events(*visits("a", 1, ["Home", "NextSong", "Save Settings"])))
    x = sessions.session_vectors(df).first().x
    assert len(x) == 50 and x[:3] == pytest.approx([1 / 23, 2 / 23, 22 / 23]) and set(x[3:]) == {0.0}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, len(PAGE_VOCABULARY), size=(300, 50))
    rows = [(f"u{i}", i, 50, [float(c) / 23 for c in row]) for i, row in enumerate(codes)]
    return spark.createDataFrame(rows, "userId string, sessionId long, session_length long, x array<double>")


def test_error_equals_a_singular_value_reconstruction(vectors):
    model = sessions.fit_session_model(vectors, k=16)
    rows = sessions.reconstruction_error(vectors, model).orderBy("sessionId").collect()
    x = np.array([r.x for r in rows])
    centred = x - x.mean(axis=0)
    _, _, basis = np.linalg.svd(centred, full_matrices=False)
    rebuilt = centred @ basis[:16].T @ basis[:16]
    assert [r.recon_error for r in rows] == pytest.approx(((centred - rebuilt) ** 2).mean(axis=1), abs=1e-9)


def test_scores_follow_the_percentile(vectors):
    scores = sessions.anomaly_scores(vectors)
    rows = scores.collect()
    errors = np.array([r.recon_error for r in rows])
    limit = np.percentile(errors, 95)
    assert [r.is_anomaly for r in rows] == [int(e > limit) for e in errors]
    assert [r.anomaly_score for r in rows] == pytest.approx(np.clip(errors / limit, 0, 5))
    share = sessions.anomaly_share(scores).first()
    assert share.sessions == 300 and share.anomalies == 15 and share.share == 0.05
    assert sessions.lookup_anomaly(7, scores).count() == 1 and sessions.lookup_anomaly(-1, scores).count() == 0


def test_threshold_zero(spark):
    df = spark.createDataFrame([(0.0,), (0.1,)], "e double")
    cols = sessions.score_columns(F.col("e"), F.lit(0.0))
    assert [(r.is_anomaly, r.anomaly_score) for r in df.withColumns(cols).collect()] == [(0, 0.0), (1, 5.0)]


def test_gap_sessions_of_a_hot_user(spark):
    """Half of the events are one user's; sessions span ranges, and equal times are one event time."""
    import random

    rng = random.Random(3)
    rows = [("hot" if i % 2 else f"u{rng.randrange(20)}", rng.randrange(4000) * (1 if i % 4 else 3)) for i in range(3000)]
    rows += [(None, 5), ("u1", None), *rows[:50]]
    wanted = []
    for user in {u for u, _ in rows if u}:
        times = sorted(t for u, t in rows if u == user and t is not None)
        start = times[0]
        for at, t in enumerate(times):
            if at + 1 == len(times) or times[at + 1] - t > 7:
                wanted.append((user, start, t + 7, sum(start <= x <= t for x in times)))
                start = times[at + 1] if at + 1 < len(times) else None
    df = spark.createDataFrame(rows, "userId string, ts long").repartition(5)
    assert sorted(map(tuple, sessions.gap_sessions(df, 7).collect())) == sorted(wanted)
    assert sessions.gap_sessions(df.limit(0), 7).collect() == []
