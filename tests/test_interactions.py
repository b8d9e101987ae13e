import hashlib

import pytest
from pyspark.sql import functions as F

from playtide.functions.columns import stable_hash
from playtide.operators import interactions, listening


@pytest.fixture(scope="module")
def plays(spark):
    rows = [
        ("u1", "s1", "a"), ("u1", "s1", "a"), ("u1", "s2", "a"), ("u2", "s1", "a"), ("u2", "s3", "b"),
        ("u3", "s2", "a"), ("u4", "s4", "c"), ("u4", "s4", "c"), (None, "s1", "a"), ("u1", None, "a"),
    ]
    return spark.createDataFrame([("NextSong", *r) for r in rows], "page string, userId string, song string, artist string")


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(u, s) for u in range(12) for s in range(20) if (u * 7 + s * 3) % 5 < 2]
    rows += [(12, s) for s in range(20)]  # a user who played every song
    return spark.createDataFrame(rows, "user_idx int, song_idx int").withColumns(
        {"play_count": F.lit(1).cast("long"), "label": F.lit(1.0)}
    )


def test_activity_limits_use_totals_before_filtering(plays):
    found = {(r.userId, r.song): r.play_count for r in interactions.interaction_matrix(plays).collect()}
    # u3 has one play and s3 was played once; u2 keeps s1 although s3 goes.
    assert found == {("u1", "s1"): 2, ("u1", "s2"): 1, ("u2", "s1"): 1, ("u4", "s4"): 2}


def test_play_modes(plays):
    assert listening.plays(plays, "ranking").count() == 9
    assert listening.plays(plays, "rating").count() == 8
    assert listening.plays(plays, "strict").count() == 8
    with pytest.raises(ValueError):
        listening.plays(plays, "other")


def test_matrix_stats(plays):
    row = interactions.matrix_stats(interactions.interaction_matrix(plays)).first()
    assert (row.users, row.songs, row.interactions) == (3, 3, 4)
    assert row.sparsity == pytest.approx(1 - 4 / 9)


def test_dense_ids_follow_sorted_names(spark):
    names = [f"n{i}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "name string").repartition(6)
    found = {r.name: r.idx for r in interactions.dense_ids(df, "name", "idx").collect()}
    assert found == {n: i for i, n in enumerate(sorted(names))}


def test_hash_ids_and_mapping(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "userId string, song string")
    hashed = interactions.hash_ids(df)
    assert all(0 <= r.user_idx < 100_000 and 0 <= r.song_idx < 100_000 for r in hashed.collect())
    shared = spark.createDataFrame([(1, "z"), (1, "b"), (2, "c")], "idx int, name string")
    assert set(map(tuple, interactions.id_mapping(shared, "idx", "name").collect())) == {(1, "b"), (2, "c")}


def brute_negatives(pairs, n_songs, ratio, seed):
    seen = set(pairs)
    found = []
    for user, pos in pairs:
        unseen = [s for s in range(n_songs) if (user, s) not in seen]
        for draw in range(1, ratio + 1):
            text = f"{seed}:{user}:{pos}:{draw}"
            if unseen:
                found.append((user, unseen[int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % len(unseen)]))
    return found


@pytest.mark.parametrize("ratio", [4, 1, 3])
def test_negatives_equal_brute_force(pairs, ratio):
    rows = [(r.user_idx, r.song_idx) for r in pairs.collect()]
    found = interactions.negative_samples(pairs, 20, ratio, 7)
    assert sorted((r.user_idx, r.song_idx) for r in found.collect()) == sorted(brute_negatives(rows, 20, ratio, 7))


def test_users_who_know_nearly_all_songs_get_every_negative(spark):
    """60 users know 34 of 40 songs each; a limit on draws would leave some short."""
    rows = [(u, (u * 7 + i) % 40) for u in range(60) for i in range(34)]
    found = interactions.negative_samples(spark.createDataFrame(rows, "user_idx int, song_idx int"), 40)
    assert found.count() == 4 * len(rows)
    assert not {(r.user_idx, r.song_idx) for r in found.collect()} & set(rows)


def test_negatives_are_unseen_and_repeatable(pairs):
    seen = {(r.user_idx, r.song_idx) for r in pairs.collect()}
    first = sorted((r.user_idx, r.song_idx) for r in interactions.negative_samples(pairs, 20).collect())
    again = interactions.negative_samples(pairs.repartition(9), 20).collect()
    assert not seen & set(first)
    assert all(user != 12 for user, _ in first)
    assert first == sorted((r.user_idx, r.song_idx) for r in again)


def test_splits_partition_the_input(spark):
    rows = [(i, i % 50, float(i % 5 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_idx int, song_idx int, label double")
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    exact = interactions.stratified_split(df, shares, "label", ["user_idx", "song_idx"], exact=True)
    sizes = {(r.split, r.label): r.rows for r in interactions.class_balance(exact).collect()}
    assert sizes == {
        ("train", 1.0): 420, ("val", 1.0): 90, ("test", 1.0): 90,
        ("train", 0.0): 1680, ("val", 0.0): 360, ("test", 0.0): 360,
    }
    assert sorted(r.user_idx for r in exact.collect()) == list(range(3000))
    hashed = interactions.stratified_split(df, shares, "label", ["user_idx", "song_idx"])
    by_split = {r.split: r["count"] for r in hashed.groupBy("split").count().collect()}
    assert sum(by_split.values()) == 3000 and 1950 < by_split["train"] < 2250


def test_training_set_shuffle_keeps_rows(pairs):
    neg = interactions.negative_samples(pairs, 20)
    plain = interactions.training_set(pairs, neg).collect()
    mixed = interactions.training_set(pairs, neg, shuffle=True).collect()
    assert sorted(plain) == sorted(mixed) and plain != mixed


def test_stable_hash_is_md5(spark):
    value = spark.range(1).select(stable_hash(3, F.lit("a"), F.lit(None), F.lit(5)).alias("h")).first().h
    assert value == int(hashlib.md5(b"3:a::5").hexdigest()[:15], 16)


def test_active_cells_are_found_without_moving_the_matrix(spark):
    """The few inactive users and songs are broadcast on their stored size; the matrix is read where it lies."""
    cells = [("u", "s"), ("u", "t"), ("v", "s"), ("v", "s"), ("w", "s"), ("u", "once"), ("v", "once2")]
    rows = spark.createDataFrame([("NextSong", u, s, "a") for u, s in cells], "page string, userId string, song string, artist string")
    kept = interactions.interaction_matrix(rows, 2)
    assert {(r.userId, r.song, r.play_count) for r in kept.collect()} == {("u", "s", 1), ("v", "s", 2)}
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
