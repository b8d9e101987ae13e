from playtide.llm import langid, queries


def test_held_out_accuracy(spark, whole):
    rows = queries.op5_langid(spark, "/root/testdata/sf0.01").join(whole.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == whole.count() and len(held) > 150
    assert sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_folded_tables_give_the_convolution():
    network = langid.Network(["a", "b"])
    network.fold()
    found, _ = langid.windows(["some text é and more"])
    embedded = network.embedding[found]
    pooled = []
    for w, filters, bias in zip(langid.WIDTHS, network.filters, network.bias):
        view = [embedded[:, k : langid.WINDOW - w + 1 + k] @ filters[k * langid.EMBEDDED : (k + 1) * langid.EMBEDDED] for k in range(w)]
        pooled.append(sum(view).max(axis=1) + bias)
    import numpy as np

    plain = langid.softmax(np.maximum(np.hstack(pooled), 0) @ network.out + network.out_bias)
    assert np.allclose(plain, network.probabilities(found), atol=1e-5)


def test_the_whole_text_counts(docs):
    network = langid.train(docs(*[(i, "der die das und nicht " * 9, "de") for i in range(40)], *[(100 + i, "the of and with that " * 9, "en") for i in range(40)]))
    text = "the of and with " * 20
    rows = {r.doc_id: r for r in langid.predict(docs((1, text), (2, text + "und die der das " * 400)), network).collect()}
    assert rows[1].lang_pred == "en" and rows[2].lang_pred == "de"


def test_odd_rows(odd, docs):
    network = langid.train(docs((1, "hello there", "en"), (2, "guten tag", "de"), (3, None, "fr"), (4, "x", None)))
    rows = {r.doc_id: r for r in langid.predict(odd, network).collect()}
    assert network.languages == ["de", "en"]
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 8} and rows[1].score == 0
    assert langid.predict(odd.limit(0), network).count() == 0
    empty = langid.train(odd.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}
    assert langid.predict(odd, network).columns == [*odd.columns, "lang_pred", "score"]
