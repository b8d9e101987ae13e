import numpy as np

from playtide.llm import quality, queries


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = queries.op8_quality(spark, "/root/testdata/sf0.01")
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert rows.count() == 1000 and sum(r.predicted == r.quality for r in held) > 0.93 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in held)


def test_gradients_match_differences():
    network, rng = quality.Attention(), np.random.RandomState(0)
    x, owner, labels = rng.rand(7, 1025).astype(np.float32), np.array([0, 0, 0, 1, 1, 2, 2]), np.array([1, 0, 1])
    starts, weigh = np.array([0, 3, 5]), np.ones(3)

    def loss():
        p = network.forward(x, starts, owner)[-1]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    grads = network._gradients(x, starts, owner, labels, weigh)
    for p, g in ((network.v, grads[2]), (network.u, grads[3]), (network.w, grads[4]), (network.out, grads[5])):
        p[0, 0] += 1e-2
        up = loss()
        p[0, 0] -= 2e-2
        down = loss()
        p[0, 0] += 1e-2
        assert abs((up - down) / 2e-2 - g[0, 0]) < 2e-3


def test_odd_rows(odd, docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (4, 0), (6, 0), (9, None)], "doc_id long, quality int")
    rows = quality.score(odd, quality.train(odd, labels)).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert quality.train(odd, labels.limit(0)) == 0.5
    assert {r.score for r in quality.score(odd, 0.5).collect()} == {0.5}
    assert quality.score(odd.limit(0), 0.5).count() == 0


def test_blocks_of_passages_give_the_same_scores(spark, monkeypatch):
    network = quality.Attention()
    texts = [("word " * 4_000,), ("short",), ("A line.\n" * 900,)]
    docs = spark.createDataFrame(texts, "text string").selectExpr("monotonically_increasing_id() AS doc_id", "text").coalesce(1)
    whole = [r.score for r in quality.score(docs, network).collect()]
    monkeypatch.setattr(quality, "BLOCK", 7)
    found, owner = quality.passages([t.encode() for t, in texts])
    plain = network.forward(quality.encoded(found), np.searchsorted(owner, np.arange(3)), owner)[-1]
    assert np.allclose(whole, plain, atol=1e-5) and np.allclose([r.score for r in quality.score(docs, network).collect()], plain, atol=1e-5)


def test_few_rows_of_a_label_are_ranked(spark, monkeypatch):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS INT) AS quality")
    docs = labels.selectExpr("doc_id", "concat('text ', doc_id) AS text")
    seen = []
    monkeypatch.setattr(quality.Attention, "fit", lambda self, x, owner, labels: seen.append(labels))
    quality.train(docs, labels, per_label=50)
    assert seen[0].sum() == 50 and len(seen[0]) == 100
