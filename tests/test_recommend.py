import pytest
from pyspark.sql import functions as F

from playtide.operators import recommend


@pytest.fixture(scope="module")
def positives(spark):
    rows = [(u, s, 1 + (u * s) % 3) for u in range(30) for s in range(25) if (u + s) % 3 == 0]
    return spark.createDataFrame(rows, "user_idx int, song_idx int, play_count long")


@pytest.fixture(scope="module")
def model(positives):
    return recommend.train_als(positives, rank=4, iterations=3, blocks=2)


def test_next_prime():
    assert [recommend.next_prime(n) for n in (0, 2, 4, 25, 97)] == [2, 2, 5, 29, 97]


@pytest.mark.parametrize("n_neg", [3, 99])
def test_candidates(positives, n_neg):
    known = {(r.user_idx, r.song_idx) for r in positives.collect()}
    rows = recommend.ranking_candidates(positives, 25, n_users=10, n_neg=n_neg).collect()
    users = {r.user_idx for r in rows}
    assert len(users) == 10
    for user in users:
        own = [r.song_idx for r in rows if r.user_idx == user and r.is_positive]
        others = [r.song_idx for r in rows if r.user_idx == user and not r.is_positive]
        unseen = 25 - sum(u == user for u, _ in known)
        assert len(own) == 1 and (user, own[0]) in known
        assert len(others) == len(set(others)) == min(n_neg, unseen)
        assert not any((user, song) in known for song in others)


def test_known_songs_are_left_out(spark, positives):
    known = spark.createDataFrame([(u, s) for u in range(30) for s in range(20)], "user_idx int, song_idx int")
    rows = recommend.ranking_candidates(positives, 25, known=known).filter("is_positive = 0").collect()
    assert rows and all(r.song_idx >= 20 for r in rows)


def test_hit_rate_counts_better_candidates(spark):
    rows = [(0, 1, 1, 0.5), (0, 2, 0, 0.9), (0, 3, 0, 0.1), (1, 5, 1, 0.2), (1, 6, 0, 0.2), (1, 4, 0, 0.2), (2, 1, 0, 0.3)]
    scored = spark.createDataFrame(rows, "user_idx int, song_idx int, is_positive int, score double")
    # User 0: one better. User 1: a tie won by the smaller index 4. User 2: no scored positive.
    for k, hits in ((1, 0), (2, 2)):
        row = recommend.hit_rate(scored, k).first()
        assert (row.users, row.hits, row.hit_rate) == (3, hits, pytest.approx(hits / 3))


def test_perfect_scores_hit_always(positives):
    scores = positives.select("user_idx", "song_idx", F.lit(1.0).alias("score"))
    assert recommend.hit_rate_at_k(scores, positives, 25, k=1).first().hit_rate == 1.0


def test_als_is_repeatable_and_non_negative(positives, model):
    recs = recommend.recommend_all(model, 5)
    ranked = recommend.rank_recommendations(recs, 3).collect()
    again = recommend.train_als(positives, rank=4, iterations=3, blocks=2)
    assert sorted(ranked) == sorted(recommend.rank_recommendations(recommend.recommend_all(again, 5), 3).collect())
    assert len(ranked) == 90 and {r.rank for r in ranked} == {1, 2, 3} and all(r.score >= 0 for r in ranked)
    assert recommend.als_rmse(model, positives) < 1.0
    assert recommend.recommend_users(model, positives.filter("user_idx = 3").select("user_idx").distinct(), 4).count() == 1
    hit = recommend.als_hit_rate(model, recommend.ranking_candidates(positives, 25)).first()
    assert hit.users == 30 and 0 <= hit.hit_rate <= 1


def test_decode_text_and_lookup(spark, model):
    songs = spark.createDataFrame([(i, f"Song {i}") for i in range(0, 25, 2)], "song_idx int, song string")
    users = spark.createDataFrame([(0, "ann"), (1, "bob")], "user_idx int, userId string")
    recs = recommend.recommend_all(model, 10)
    found = recommend.lookup_recommendations("bob", recs, users, songs, 4)
    rows = found.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4] and {r.userId for r in rows} == {"bob"}
    assert all(r.song.startswith(("Song ", "song_")) for r in rows)
    assert recommend.lookup_recommendations("nobody", recs, users, songs).count() == 0
    text = {r.userId: r.recommended for r in recommend.recommendation_text(recs, users, songs, 2).collect()}
    assert set(text) == {"ann", "bob"} and text["bob"].startswith("1. ") and text["bob"].count("\n") == 9
    assert recommend.encode_names(songs.select("song").limit(3), songs, "song", "song_idx").count() == 3


def test_top_k(spark):
    rows = [(0, s, float(s % 3)) for s in range(9)]
    scores = spark.createDataFrame(rows, "user_idx int, song_idx int, score double")
    best = recommend.top_k_scores(scores, 4).orderBy("rank").collect()
    assert [r.song_idx for r in best] == [2, 5, 8, 1]


def test_evaluate_scores(spark):
    df = spark.createDataFrame([(1.0, 0.9), (1.0, 0.4), (0.0, 0.5), (0.0, 0.1)], "label double, score double")
    row = recommend.evaluate_scores(df).first()
    assert row.accuracy == 0.5 and row.auc == pytest.approx(0.75)


def test_top_items_equal_sql_over_the_factors(spark):
    """Blocks by norm, of which most users meet few; ties, a block of fewer items than wanted, users without a vector's length."""
    import duckdb
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    items = rng.gamma(1.0, 1.0, (500, 6)) * np.exp(rng.normal(0, 1.5, (500, 1)))
    items[7] = items[8] = items[9]
    users = np.vstack([rng.gamma(1.0, 1.0, (80, 6)), np.zeros((1, 6)), -rng.gamma(1.0, 1.0, (3, 6))])
    frames = {n: pd.DataFrame({"id": range(len(x)), "features": [r.tolist() for r in x.astype(np.float32)]}) for n, x in (("u", users), ("i", items))}
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    wanted = con.sql("""SELECT u.id, i.id, row_number() OVER (PARTITION BY u.id ORDER BY list_inner_product(u.features::DOUBLE[], i.features::DOUBLE[]) DESC, i.id) AS rank
        FROM u, i QUALIFY rank <= 10""").fetchall()
    tables = {n: spark.createDataFrame(f, "id int, features array<float>").repartition(3) for n, f in frames.items()}
    for block, part in ((4096, 20_000), (40, 30), (7, 1000)):
        df = recommend.top_items(tables["u"], tables["i"], 10, block, part)
        found = [(r.user_idx, x.song_idx, n + 1) for r in df.collect() for n, x in enumerate(r.recommendations)]
        assert sorted(found) == sorted(wanted)
        assert "CartesianProduct" not in df._jdf.queryExecution().toString()
    assert recommend.top_items(tables["u"], tables["i"].limit(0)).count() == 0
    assert recommend.top_items(tables["u"].limit(0), tables["i"]).count() == 0


def _shuffled(plan):
    """Rows written by all shuffles of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled(plan.plan())
    own = plan.metrics().get("shuffleRecordsWritten")
    below = plan.children()
    return (own.get().value() if own.isDefined() else 0) + sum(_shuffled(below.apply(i)) for i in range(below.size()))


def _factors(spark, rows):
    import pandas as pd

    frame = pd.DataFrame({"id": range(len(rows)), "features": [r.tolist() for r in rows]})
    return spark.createDataFrame(frame, "id int, features array<double>")


def _best_by_sort(users, items, k):
    import numpy as np

    return [(u, int(i), n + 1) for u, row in enumerate(users @ items.T) for n, i in enumerate(np.lexsort((np.arange(len(row)), -row))[:k])]


def test_top_items_copies_blocks_only_for_users_who_want_them(spark):
    """Items of one direction but for a few, which a few users want: all blocks were copied for each part of the users."""
    import numpy as np

    rng = np.random.default_rng(5)
    items = rng.uniform(50, 100, (2000, 1)) * (1 + rng.uniform(0, 0.02, (2000, 4)))
    items[::500] = [0, 0, 0, 101]
    users = 1 + rng.integers(0, 4, (600, 4)).astype(float)
    users[:3] = [0, 0, 0, 1]
    df = recommend.top_items(_factors(spark, users), _factors(spark, items), 10, 40, 10)
    found = [(r.user_idx, x.song_idx, n + 1) for r in df.collect() for n, x in enumerate(r.recommendations)]
    assert sorted(found) == sorted(_best_by_sort(users, items, 10))
    assert _shuffled(df._jdf.queryExecution().executedPlan()) < 2 * (len(users) + len(items))


@pytest.mark.parametrize("few", [1, 8])
def test_top_items_in_all_directions(spark, monkeypatch, few):
    """No block can be left out for most users: many groups and parts, negative parts, ties, equal and zero vectors."""
    import numpy as np

    monkeypatch.setattr(recommend, "BLOCKS_PER_GROUP", 3)
    monkeypatch.setattr(recommend, "FEW_PARTS", few)
    rng = np.random.default_rng(6)
    items, users = rng.integers(-3, 4, (400, 5)).astype(float), rng.integers(-3, 4, (90, 5)).astype(float)
    items[100:110], users[7] = items[0], 0
    for block in (4, 25):
        df = recommend.top_items(_factors(spark, users), _factors(spark, items), 6, block, 5)
        found = [(r.user_idx, x.song_idx, n + 1) for r in df.collect() for n, x in enumerate(r.recommendations)]
        assert sorted(found) == sorted(_best_by_sort(users, items, 6))


def test_stored_factors_score_as_the_model_does(spark, positives, model, tmp_path):
    """RMSE, hit rate and one user's list from written factor tables, against the model and SQL over the files."""
    import duckdb

    for name, table in (("users", model.userFactors), ("items", model.itemFactors)):
        table.write.parquet(f"{tmp_path}/{name}")
    users, items = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("users", "items"))
    row = recommend.factor_rmse(positives.union(spark.createDataFrame([(99, 0, 1), (0, 99, 1)], positives.schema)), users, items).first()
    assert row.pairs == positives.count() and row.rmse == pytest.approx(recommend.als_rmse(model, positives), abs=1e-6)
    candidates = recommend.ranking_candidates(positives, 25)
    assert recommend.hit_rate(recommend.factor_scores(candidates, users, items)).first() == recommend.als_hit_rate(model, candidates).first()

    names = spark.createDataFrame([(3, "cleo"), (77, "new")], "user_idx int, userId string")
    songs = positives.select("song_idx").distinct().withColumn("song", F.concat(F.lit("s"), F.col("song_idx")))
    wanted = duckdb.sql(f"""SELECT 's' || i.id, row_number() OVER (ORDER BY list_inner_product(u.features::DOUBLE[], i.features::DOUBLE[]) DESC, i.id) AS rank
        FROM '{tmp_path}/users/*.parquet' u, '{tmp_path}/items/*.parquet' i WHERE u.id = 3 QUALIFY rank <= 6""").fetchall()
    found = recommend.lookup_factors("cleo", users, items, names, songs, 6)
    assert sorted((r.song, r["rank"]) for r in found.collect()) == sorted(wanted)
    for unknown in ("new", "nobody"):
        assert recommend.lookup_factors(unknown, users, items, names, songs).count() == 0


def test_co_listening_factors(spark):
    plays = spark.createDataFrame([(0, 0, 2), (0, 3, 1), (1, 3, 5)], "user_idx int, song_idx int, play_count long")
    users, songs = recommend.co_listening_factors(plays, 2)
    assert {r.id: r.features for r in users.collect()} == {0: [2, 1], 1: [0, 5]}
    assert {r.id: r.features for r in songs.collect()} == {0: [4, 2], 3: [2, 26]}
