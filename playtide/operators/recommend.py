"""Matrix factorisation, ranking of candidates, lookups of recommendations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from playtide.functions.columns import stable_hash
from playtide.operators.scale import cut_lineage, global_positions


RATINGS_PER_BLOCK = 1_000_000
ITEMS_PER_BLOCK, BLOCKS_PER_GROUP, USERS_PER_PART = 4_096, 32, 20_000
FEW_PARTS, PART_GROWS = 8, 5  # parts beyond the first few hold so many times the users
USERS_AT_ONCE, LOOK_FIRST = 500, 256  # the best of the items looked at first bar most others of their block from ranking


def train_als(
    ratings: DataFrame,
    rating: str = "play_count",
    implicit: bool = False,
    rank: int = 10,
    iterations: int = 10,
    reg: float = 0.1,
    blocks: int | None = None,
    seed: int = 42,
) -> ALSModel:
    """M3: non-negative ALS; users or songs unseen in training are dropped when scoring.

    The number of blocks follows the ratings, ``RATINGS_PER_BLOCK`` each.
    """
    if blocks is None:
        blocks = max(10, -(-ratings.count() // RATINGS_PER_BLOCK))
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        implicitPrefs=implicit,
        userCol="user_idx",
        itemCol="song_idx",
        ratingCol=rating,
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
    )
    return als.fit(ratings.select("user_idx", "song_idx", F.col(rating).cast("float").alias(rating)))


def als_rmse(model: ALSModel, test: DataFrame, rating: str = "play_count") -> float:
    """M4: root mean squared error on held-out ratings."""
    scored = model.transform(test.withColumn(rating, F.col(rating).cast("double")))
    return RegressionEvaluator(metricName="rmse", labelCol=rating, predictionCol="prediction").evaluate(scored)


RECS = "array<struct<song_idx:int,rating:float>>"


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    values = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    """``n`` lists of ``values``, which are in the order of their ``rows``."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), values)


def _recs(rows: np.ndarray, n: int, ids: np.ndarray, scores: np.ndarray) -> pa.ListArray:
    return _lists(rows, n, pa.StructArray.from_arrays([pa.array(ids, pa.int32()), pa.array(scores, pa.float64())], ["song_idx", "rating"]))


def _most(users: np.ndarray, axis: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each user and block, no less than the greatest inner product with an item of the block.

    Vectors are split along and off the unit vector ``axis``: the parts along it multiply,
    those off it reach the product of their lengths at most. ``limits`` has a block's greatest
    and least part along the axis, its greatest length off it and its greatest length.
    """
    along = users @ axis
    off = np.linalg.norm(users - np.outer(along, axis), axis=1)
    whole = np.outer(np.linalg.norm(users, axis=1), limits[:, 3])
    split = np.maximum(np.outer(along, limits[:, 0]), np.outer(along, limits[:, 1])) + np.outer(off, limits[:, 2])
    return np.minimum(split, whole) + 1e-9 * whole  # a margin for rounding: a bound is met rather once too often


def _limits(vectors: np.ndarray, axis: np.ndarray) -> np.ndarray:
    """The row of ``_most``'s limits for the block of these items."""
    along = vectors @ axis
    off = np.linalg.norm(vectors - np.outer(along, axis), axis=1)
    return np.array([[along.max(), along.min(), off.max(), np.linalg.norm(vectors, axis=1).max()]])


def _add_block(best: tuple, users: np.ndarray, at: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple:
    """``best`` with a block's items: (user, item, score) of the ``k`` best by user, ties to the smaller item.

    ``at`` are the rows of ``users`` that meet the block; their ``least``, below which no
    score counts, is raised to their ``k``-th score in place.
    """
    scores = users[at] @ vectors.T
    kept = scores >= least[at, None]
    many = np.flatnonzero(np.count_nonzero(kept, axis=1) > k)
    if len(many):
        kept[many] = scores[many] >= np.partition(scores[many], -k, axis=1)[:, -k, None]
    row, col = np.nonzero(kept)
    if not len(row):
        return best
    rows, items, found = (np.concatenate(x) for x in zip(best, (at[row], ids[col], scores[row, col])))
    order = np.lexsort((items, -found, rows))
    rows, items, found = rows[order], items[order], found[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    last = rank == k - 1
    least[rows[last]] = np.maximum(least[rows[last]], found[last])
    return rows[rank < k], items[rank < k], found[rank < k]


def _nothing() -> tuple:
    return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.float64)


def _meet_first(
    users: pa.Table, ids: np.ndarray, vectors: np.ndarray, axis: np.ndarray, limits: np.ndarray, groups: np.ndarray, starts: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """(user_idx, recs, least, wanted, features): the best of the first block and the ``groups`` of further blocks that can add to them.

    The rows of ``limits`` are the further blocks in the order of their groups, which begin
    at ``starts``. Features are kept for users who want a group.
    """
    factors = _matrix(users["features"])
    for start in range(0, len(factors), USERS_AT_ONCE):
        own = factors[start : start + USERS_AT_ONCE]
        n, least = len(own), np.full(len(own), -np.inf)
        best = _nothing()
        for piece in (slice(0, LOOK_FIRST), slice(LOOK_FIRST, None)):
            best = _add_block(best, own, np.arange(n), least, ids[piece], vectors[piece], k)
        rows, items, found = best
        wants, group = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(groups):
            wants, group = np.nonzero(np.maximum.reduceat(_most(own, axis, limits), starts, axis=1) >= least[:, None])
        still = np.unique(wants)
        kept = _lists(np.repeat(still, own.shape[1]), n, pa.array(own[still].ravel(), pa.float64()))
        columns = [
            users["user_idx"].slice(start, n).combine_chunks(),
            _recs(rows, n, items, found),
            pa.array(least),
            _lists(wants, n, pa.array(groups[group], pa.int32())),
            kept,
        ]
        yield pa.RecordBatch.from_arrays(columns, ["user_idx", "recs", "least", "wanted", "features"])


def _meet_group(users: pa.Table, items: pa.Table, axis: np.ndarray, k: int) -> pa.Table:
    """(user_idx, recs): what the blocks of a group add to the best of these users; users meet those whose bound reaches their least score."""
    kind = pa.list_(pa.struct([("song_idx", pa.int32()), ("rating", pa.float64())]))
    empty = pa.table({"user_idx": pa.array([], pa.int32()), "recs": pa.array([], kind)})
    if not len(users) or not len(items):
        return empty
    number = items["_block"].to_numpy()
    order = np.argsort(number, kind="stable")
    ids, vectors = items["song_idx"].to_numpy()[order], _matrix(items["features"])[order]
    cuts = [0, *(np.flatnonzero(np.diff(number[order])) + 1), len(order)]
    blocks = [(ids[a:b], vectors[a:b], _limits(vectors[a:b], axis)) for a, b in zip(cuts, cuts[1:])]
    factors, idx, bar, out = _matrix(users["features"]), users["user_idx"].to_numpy(), users["least"].to_numpy(), [empty]
    for start in range(0, len(idx), USERS_AT_ONCE):
        own, least = factors[start : start + USERS_AT_ONCE], bar[start : start + USERS_AT_ONCE].copy()
        most, best = _most(own, axis, np.concatenate([x for _, _, x in blocks])), _nothing()
        for i, (songs, rows, _) in enumerate(blocks):
            at = np.flatnonzero(most[:, i] >= least)
            if len(at):
                best = _add_block(best, own, at, least, songs, rows, k)
        some, row = np.unique(best[0], return_inverse=True)
        out.append(pa.table({"user_idx": pa.array(idx[start + some], pa.int32()), "recs": _recs(row, len(some), *best[1:])}))
    return pa.concat_tables(out)


def top_items(
    user_factors: DataFrame, item_factors: DataFrame, k: int = 10, block: int = ITEMS_PER_BLOCK, part: int = USERS_PER_PART
) -> DataFrame:
    """The ``k`` items with the greatest inner product for every user, without a product of both tables.

    Items are cut into blocks in the order of their norms, the longest first. All users meet
    the first block; after that a user meets only the blocks whose bound (``_most``, along and
    off the mean direction of the first block) reaches the ``k``-th score so far. They go
    there by an equi-join on (group of ``BLOCKS_PER_GROUP`` blocks, part of the users who want
    the group): a group that nobody wants is not copied, others once for each ``part`` of the
    users who want them, beyond ``FEW_PARTS`` copies once for each ``part * PART_GROWS``; a
    user goes once to each wanted group. Users whose first block is proved to be enough are
    not shuffled. Ties go to the smaller item; factors are (id, features) as a fitted model
    has them, one row per id.
    """
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    users = user_factors.select(F.col("id").alias("user_idx"), "features")
    items = item_factors.select(F.col("id").alias("song_idx"), "features", (-norm).alias("_less"))
    placed = cut_lineage(
        global_positions(items, ["_less", "song_idx"])
        .withColumn("_block", F.floor(F.col("position") / block).cast("int"))
        .select("_block", F.floor(F.col("_block") / BLOCKS_PER_GROUP).cast("int").alias("_group"), "song_idx", "features", "_less")
    )
    first = placed.filter("_block = 0").orderBy("_less").select("song_idx", "features").toPandas()  # one block
    ids, vectors = first["song_idx"].to_numpy(), np.array(first["features"].tolist(), np.float64)
    total = vectors.sum(axis=0)
    axis = total / (np.linalg.norm(total) or 1.0)
    line = F.array(*[F.lit(float(x)) for x in np.atleast_1d(axis)])
    split = placed.filter("_block > 0").withColumn("_along", _dot(F.col("features"), line))
    off = F.aggregate(F.zip_with("features", line, lambda x, y: x - F.col("_along") * y), F.lit(0.0), lambda a, x: a + x * x)
    most = [F.max("_along"), F.min("_along"), F.max(F.sqrt(off)), -F.min("_less")]
    bounds = split.groupBy("_group", "_block").agg(*most).orderBy("_block").collect()  # a row per block
    limits = np.array([r[2:] for r in bounds], np.float64).reshape(-1, 4)
    groups, starts = np.unique(np.array([r["_group"] for r in bounds], np.int32), return_index=True)

    def meet_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(ids):
                yield from _meet_first(pa.Table.from_batches([batch]), ids, vectors, axis, limits, groups, starts, k)

    recs = "recs array<struct<song_idx:int,rating:double>>"
    found = cut_lineage(
        users.mapInArrow(meet_first, f"user_idx int, {recs}, least double, wanted array<int>, features array<double>")
    )
    best = found.filter("size(wanted) = 0").select("user_idx", F.col("recs").alias("best"))
    if len(bounds):
        reached = found.select("user_idx", "features", "least", F.explode("wanted").alias("_group"))
        n = F.count(F.lit(1))
        parts = F.greatest(F.ceil(n / (part * PART_GROWS)), F.least(F.ceil(n / part), F.lit(FEW_PARTS))).cast("int")
        sizes = F.broadcast(reached.groupBy("_group").agg(parts.alias("_parts")))  # a row per group
        to = F.pmod(F.xxhash64("user_idx"), F.col("_parts")).cast("int").alias("_part")
        own = reached.join(sizes, "_group").select("_group", to, "user_idx", "features", "least")
        copies = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")
        spread = placed.filter("_block > 0").join(sizes, "_group").select("_group", copies, "_block", "song_idx", "features")
        left, right = (df.groupBy("_group", "_part") for df in (own, spread))
        more = left.cogroup(right).applyInArrow(lambda a, b: _meet_group(a, b, axis, k), f"user_idx int, {recs}")
        both = found.filter("size(wanted) > 0").select("user_idx", "recs").unionByName(more)
        in_order = F.transform(F.flatten(F.collect_list("recs")), lambda r: F.struct((-r["rating"]).alias("less"), r["song_idx"].alias("song_idx")))
        merged = both.groupBy("user_idx").agg(F.slice(F.array_sort(in_order), 1, k).alias("_in_order"))
        again = F.transform("_in_order", lambda r: F.struct(r["song_idx"].alias("song_idx"), (-r["less"]).alias("rating")))
        best = best.unionByName(merged.select("user_idx", again.alias("best")))
    return best.select("user_idx", F.col("best").cast(RECS).alias("recommendations"))


def recommend_all(model: ALSModel, k: int = 10) -> DataFrame:
    """Top ``k`` songs of every user."""
    return top_items(model.userFactors, model.itemFactors, k)


def recommend_users(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` songs of the given users."""
    return model.recommendForUserSubset(users, k)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda total, x: total + x)


def factor_scores(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, name: str = "score") -> DataFrame:
    """Inner product of the stored factors of each (user_idx, song_idx) pair.

    A pair without one of its factors is left out, as an unseen user or song is when a
    model scores. Hot users and songs are split by adaptive execution.
    """
    users = user_factors.select(F.col("id").alias("user_idx"), F.col("features").alias("_user"))
    items = item_factors.select(F.col("id").alias("song_idx"), F.col("features").alias("_item"))
    joined = pairs.join(users, "user_idx").join(items, "song_idx")
    return joined.withColumn(name, _dot(F.col("_user"), F.col("_item"))).drop("_user", "_item")


def factor_rmse(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, rating: str = "play_count") -> DataFrame:
    """M4: (pairs, rmse) of the stored factors on rated pairs."""
    scored = factor_scores(pairs, user_factors, item_factors, "_found")
    off = F.col("_found") - F.col(rating)
    return scored.agg(F.count(F.lit(1)).alias("pairs"), F.sqrt(F.avg(off * off)).alias("rmse"))


def lookup_factors(
    user: str, user_factors: DataFrame, item_factors: DataFrame, users: DataFrame, songs: DataFrame, k: int = 10
) -> DataFrame:
    """One user's ``k`` best songs from stored factors; empty when the user is unknown.

    No model is loaded or fitted: the user's vector is one filtered row, every song is
    scored by one inner product, and each task keeps ``k`` songs. Ties go to the smaller song.
    """
    own = user_factors.join(users.filter(F.col("userId") == user).select(F.col("user_idx").alias("id")), "id").select("id", "features").first()
    at, vector = own or (None, [])
    scored = item_factors.filter(F.lit(own is not None)).select(
        F.lit(at).cast("int").alias("user_idx"),
        F.col("id").alias("song_idx"),
        _dot(F.col("features"), F.array(*[F.lit(float(v)) for v in vector]).cast("array<double>")).alias("score"),
    )
    return decode_ids(top_k_scores(scored, k), songs, "song_idx", "song").select(F.lit(user).alias("userId"), "rank", "song", "score")


def co_listening_factors(plays: DataFrame, size: int = 16) -> tuple[DataFrame, DataFrame]:
    """(user factors, song factors) without a fit, as (id, features): songs fall into ``size`` groups by their index.

    A user's vector is the plays by group; a song's is the sum of its listeners' vectors,
    each as often as they played it. Both are sums of fixed width, added on the map side,
    so a song heard by everyone is one row per task.
    """
    group = F.pmod(F.col("song_idx"), F.lit(size))
    own = [F.sum(F.when(group == i, F.col("play_count")).otherwise(0)).alias(f"_{i}") for i in range(size)]
    listeners = plays.groupBy("user_idx").agg(*own)
    users = cut_lineage(listeners.select(F.col("user_idx").alias("id"), F.array(*[F.col(f"_{i}") for i in range(size)]).alias("features")))
    met = plays.select("user_idx", "song_idx", "play_count").join(users.withColumnRenamed("id", "user_idx"), "user_idx")
    shared = met.groupBy("song_idx").agg(*[F.sum(F.col("play_count") * F.col("features")[i]).alias(f"_{i}") for i in range(size)])
    return users, cut_lineage(shared.select(F.col("song_idx").alias("id"), F.array(*[F.col(f"_{i}") for i in range(size)]).alias("features")))


def rank_recommendations(recs: DataFrame, k: int = 10) -> DataFrame:
    """One row per recommended song with its rank from 1."""
    return recs.select(
        "user_idx", F.posexplode(F.slice("recommendations", 1, k)).alias("_at", "_rec")
    ).select(
        "user_idx",
        (F.col("_at") + 1).alias("rank"),
        F.col("_rec.song_idx").alias("song_idx"),
        F.col("_rec.rating").alias("score"),
    )


def top_k_scores(scores: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` rows per user of a (user_idx, song_idx, score) table."""
    best = W.partitionBy("user_idx").orderBy(F.desc("score"), "song_idx")
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def decode_ids(
    df: DataFrame, mapping: DataFrame, idx: str, name: str, prefix: str = "song_"
) -> DataFrame:
    """Index to name, ``prefix`` + index when the mapping lacks it.

    A hit song fills many rows: a small mapping is broadcast by the optimizer on
    its measured size, beyond that adaptive execution splits the song.
    """
    joined = df.join(mapping.select(idx, name), idx, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.concat(F.lit(prefix), F.col(idx).cast("string"))))


def encode_names(df: DataFrame, mapping: DataFrame, name: str, idx: str) -> DataFrame:
    """Name to index; unknown names are left out."""
    return df.join(mapping.select(name, idx), name)


def recommendation_text(recs: DataFrame, users: DataFrame, songs: DataFrame, n: int | None = 20) -> DataFrame:
    """Numbered list of recommended songs as text, for the first ``n`` users."""
    shown = recs if n is None else recs.orderBy("user_idx").limit(n)
    named = decode_ids(rank_recommendations(shown, 10), songs, "song_idx", "song")
    line = F.format_string("%d. %s (%.2f)", "rank", "song", "score")
    lists = named.groupBy("user_idx").agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("l"))
    text = lists.select("user_idx", F.array_join(F.col("l.line"), "\n").alias("recommended"))
    return decode_ids(text, users, "user_idx", "userId", "user_").select("userId", "recommended")


def next_prime(n: int) -> int:
    """Smallest prime not below ``n`` (at least 2)."""
    value = max(n, 2)
    while any(value % d == 0 for d in range(2, int(value**0.5) + 1)):
        value += 1
    return value


def ranking_candidates(
    positives: DataFrame,
    n_songs: int,
    known: DataFrame | None = None,
    n_users: int | None = 500,
    n_neg: int = 99,
    seed: int = 42,
) -> DataFrame:
    """One positive and up to ``n_neg`` unseen songs for sampled users, all for ``n_users=None``.

    Each user walks the catalogue from a random start with a random step,
    modulo a prime, so it meets every song once. Visiting ``n_neg`` songs more
    than the user knows is enough to find the unseen ones, so no user is paired
    with the whole catalogue. ``known`` adds songs to leave out, such as the
    training positives.
    """
    prime = next_prime(n_songs)
    users = positives.select("user_idx").distinct()
    if n_users is not None:
        users = users.orderBy(stable_hash(seed, "user_idx"), "user_idx").limit(n_users)
    one = W.partitionBy("user_idx").orderBy(stable_hash(seed, "user_idx", "song_idx"), "song_idx")
    chosen = (
        positives.select("user_idx", "song_idx")
        .distinct()
        .join(users, "user_idx", "left_semi")
        .withColumn("_rank", F.row_number().over(one))
        .filter("_rank = 1")
        .select("user_idx", "song_idx", F.lit(1).alias("is_positive"))
    )
    heard = positives.select("user_idx", "song_idx")
    if known is not None:
        heard = heard.unionByName(known.select("user_idx", "song_idx"))
    heard = heard.join(users, "user_idx", "left_semi").distinct()
    visits = F.least(F.lit(prime), F.col("_known") + F.lit(n_neg + prime - n_songs))
    block = 4096
    walk = (
        heard.groupBy("user_idx")
        .agg(F.count(F.lit(1)).alias("_known"))
        .withColumn("_visits", visits)
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_visits") - 1) / block))))
        .withColumn(
            "_step",
            F.explode(
                F.sequence(
                    F.col("_block") * block,
                    F.least(F.col("_visits"), (F.col("_block") + 1) * block) - 1,
                )
            ),
        )
        .select(
            "user_idx",
            "_step",
            F.pmod(
                F.pmod(stable_hash(f"{seed}start", "user_idx"), F.lit(prime))
                + F.col("_step") * (F.pmod(stable_hash(f"{seed}step", "user_idx"), F.lit(max(prime - 1, 1))) + 1),
                F.lit(prime),
            )
            .cast("int")
            .alias("song_idx"),
        )
        .filter(F.col("song_idx") < n_songs)
    )
    first = W.partitionBy("user_idx").orderBy("_step")
    unseen = (
        walk.join(heard, ["user_idx", "song_idx"], "left_anti")
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= n_neg)
        .select("user_idx", "song_idx", F.lit(0).alias("is_positive"))
    )
    return chosen.unionByName(unseen)


def hit_rate(scored: DataFrame, k: int = 10) -> DataFrame:
    """Share of users whose positive is among their ``k`` best candidates.

    On equal scores the smaller song index ranks first. A user whose positive
    has no score counts as a miss.
    """
    standing = F.struct(F.col("score"), (-F.col("song_idx")).alias("s"))
    own = F.max(F.when(F.col("is_positive") == 1, standing)).over(W.partitionBy("user_idx"))
    ranks = (
        scored.withColumn("_own", own)
        .groupBy("user_idx")
        .agg(F.when(F.max("_own").isNotNull(), F.count_if(standing > F.col("_own"))).alias("above"))
    )
    hit = F.when(F.col("above") < k, 1).otherwise(0)
    return ranks.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum(hit).cast("long").alias("hits"),
        F.avg(hit.cast("double")).alias("hit_rate"),
    )


def hit_rate_at_k(
    scores: DataFrame,
    positives: DataFrame,
    n_songs: int,
    known: DataFrame | None = None,
    k: int = 10,
    n_users: int | None = 500,
    n_neg: int = 99,
    seed: int = 42,
) -> DataFrame:
    """M20 for any score table, by (user_idx, song_idx) or by song_idx only."""
    candidates = ranking_candidates(positives, n_songs, known, n_users, n_neg, seed)
    on = [c for c in ("user_idx", "song_idx") if c in scores.columns]
    scored = candidates.join(scores.select(*on, "score"), on, "left")
    return hit_rate(scored.withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0))), k)


def als_hit_rate(model: ALSModel, candidates: DataFrame, k: int = 10) -> DataFrame:
    """M20 on the candidates scored by a factor model."""
    return hit_rate(model.transform(candidates).withColumnRenamed("prediction", "score"), k)


def evaluate_scores(scored: DataFrame, label: str = "label", score: str = "score", limit: float = 0.5) -> DataFrame:
    """Area under the ROC curve and accuracy of a score cut at ``limit``."""
    from playtide.operators.churn import area_under_roc

    accuracy = scored.agg(
        F.avg(((F.col(score) >= limit) == (F.col(label) == 1)).cast("double")).alias("accuracy")
    )
    return accuracy.withColumn("auc", F.lit(area_under_roc(scored, label, score)))


def lookup_recommendations(
    user: str, recs: DataFrame, users: DataFrame, songs: DataFrame, k: int = 10
) -> DataFrame:
    """One user's ``k`` best songs by name; empty when the user is unknown."""
    wanted = F.broadcast(users.filter(F.col("userId") == user).limit(1))
    ranked = rank_recommendations(recs.join(wanted.select("user_idx"), "user_idx", "left_semi"), k)
    return decode_ids(ranked, songs, "song_idx", "song").select(
        F.lit(user).alias("userId"), "rank", "song", "score"
    )
