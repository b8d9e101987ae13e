import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.llm import prefix_trie as T
from playtide.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, g long, conv string, next int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return (turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest())


def plain(rows):
    """The nodes of the rebuilt conversations, each found by walking all prefixes."""
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - int(np.fmod(c, 5))
        built[c] = tuple(own.get(source, [])[:h] + said[h:])
    members, last = {}, {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
        last.setdefault(said, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        rest = [below(c) for c in children.get(node, [])]
        return (sum(r[0] for r in rest) if rest else 1), own + sum(r[1] for r in rest)

    out = []
    for node, who in members.items():
        leaves, saved = below(node)
        ids = ",".join(map(str, sorted(last.get(node, []))))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])), leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def talk(spark):
    def build(rows):
        full = [(*r, "x", 7, "y", 3) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return build


def found(df, **sizes):
    got = T.trie(T.rebuilt(T.turns(df)), **sizes)
    assert got.columns == NAMES
    return sorted(map(tuple, got.collect()))


def conversations(seed, count, turns=9):
    """Conversations over few texts, so that many prefixes are shared, with nulls and repeated rows."""
    rng, rows = np.random.default_rng(seed), []
    for c in rng.permutation(count * 2)[:count].tolist():
        for t in range(int(rng.integers(1, turns))):
            role = [None, "", "user", "assistant"][int(rng.integers(4))] if rng.random() < 0.2 else "user"
            text = [None, "", "é", "hello there"][int(rng.integers(4))] if rng.random() < 0.3 else "hi"
            rows.append((c - 7, None if t == 2 and c % 11 == 0 else t, role, text))
    return [*rows, *rows[:5], (None, 1, "user", "no id"), (None, None, None, None)]


@pytest.mark.parametrize("sizes", [{}, {"together": 3, "stretch": 40}])
def test_nodes_equal_brute_force(talk, sizes):
    rows = conversations(1, 120)
    assert found(talk(rows), **sizes) == plain(rows)


def test_one_long_conversation_and_a_hot_one(talk, monkeypatch):
    """A third of the turns in one conversation, a third of the conversations alike, and members in several pieces."""
    monkeypatch.setattr(T, "PIECE", 3)
    rows = [(1000, k, "user", f"t{k % 7}") for k in range(300)]
    rows += [(5 * k, t, "user", "same") for k in range(40) for t in range(4)]
    rows += [(5 * k + 1, 0, "user", f"own {k}") for k in range(40, 60)]
    assert found(talk(rows)) == plain(rows)


def test_turnless_and_empty(talk):
    rows = [(c, 0, "user", "x") for c in (3, 6, 11, 12, 16)]
    assert found(talk(rows)) == plain(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in found(talk(rows)))
    assert found(talk([])) == []
    assert found(talk([(None, 1, "user", "x")])) == []


def test_the_order_of_rows_does_not_matter(talk):
    rows = conversations(2, 40)
    assert found(talk(rows)) == found(talk(rows[::-1]))


def test_a_list_is_ranked_whatever_its_tasks(spark):
    rng = np.random.default_rng(4)
    order = rng.permutation(500).tolist()
    rows = [(int(rng.integers(9)), 0, a, b) for a, b in zip(order, [*order[1:], None])]
    arcs = spark.createDataFrame(rows, "conv long, depth long, arc long, next long")
    for sizes in ({}, {"together": 5}, {"stretch": 30, "together": 5}):
        got = {r.arc: r.position for r in T.ranked(arcs, 500, **sizes).collect()}
        assert [got[a] for a in order] == list(range(500))


def test_prefix_sums_in_blocks(spark):
    rows = spark.range(1000).select(F.col("id").alias("position"), (F.col("id") * 7 % 13).alias("v"))
    got = {r.position: r.sum_v for r in T.prefix_sums(rows, 1000, ["v"], block=7).collect()}
    assert got == {i: sum(k * 7 % 13 for k in range(i + 1)) for i in range(1000)}


def test_sql_equals_brute_force(tmp_path):
    rows = conversations(3, 80)
    import pandas as pd

    conversations_table = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations_table)
    assert sorted(con.sql(queries.OP11).fetchall()) == plain(rows)
