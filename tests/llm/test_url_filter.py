import numpy as np
import pytest
import xxhash

from playtide.llm import queries, url_filter


def judged(spark, urls, rules=queries.RULES):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(2)
    return {r.page_id: r for r in url_filter.judge(df, rules).collect()}


def test_hosts_paths_and_the_longest_rule(spark):
    urls = ["http://A.Example.NET/en/x?q", "https://example.net/de/", "http://net", "ftp://x.org/fr/1#t", "http://xorg/fr/", "http://b.example.com/de/?a", "http://example.com?x/de/", None, "example.net/en/", "", "http://badnet/"]
    rows = judged(spark, urls)
    assert [(rows[i].rule, rows[i].verdict) for i in range(len(urls))] == [
        ("example.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("org/fr/", "allow"), (None, "allow"),
        ("example.com/de/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
    ]
    assert (rows[0].host, rows[0].path) == ("a.example.net", "/en/x") and (rows[6].host, rows[6].path) == ("example.com", "")
    assert (rows[7].host, rows[7].path) == ("", "")


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda key: len(key))
    index = url_filter.Digests([("block", "aa.com", "/"), ("allow", "bb.com", "/")])
    found = url_filter.Mapped(index.raw, index.size)
    at = found.find([b"bb.com/", b"cc.com/", b"aa.com/"])
    assert [found.string(k) if k >= 0 else None for k in at] == [b"bb.com/", None, b"aa.com/"]


def test_many_rules(spark):
    rules = [("block" if i % 2 else "allow", f"h{i}.example.com", "/") for i in range(5_000)]
    rows = judged(spark, [f"http://sub.h{i}.example.com/x" for i in range(0, 6_000, 7)], rules)
    for n, i in enumerate(range(0, 6_000, 7)):
        assert rows[n].rule == (f"h{i}.example.com/" if i < 5_000 else None)


def test_bad_rules_raise_and_empty_tables_pass(spark, monkeypatch):
    with pytest.raises(ValueError):
        url_filter.Digests([("block", "a", "/"), ("allow", "a", "/")])
    assert judged(spark, ["http://a/b"], [])[0].verdict == "allow"
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, queries.RULES).count() == 0
    monkeypatch.setattr(url_filter, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        url_filter.Digests([("block", "a.example.com", "/")])


def test_sorted(spark):
    index = url_filter.Digests(queries.RULES)
    keys = np.frombuffer(index.raw[: 8 * index.size], np.uint64)
    assert (keys[:-1] <= keys[1:]).all()
