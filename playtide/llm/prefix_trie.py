"""Prefix trie of conversations, its subtree sums by the Euler-tour technique.

Every prefix of a conversation's turns is a node, one node for all conversations that share
it. A prefix is known by two 64-bit sums of hashes of its turns and their places, so it is a
running sum along the conversation, and a conversation of any length is summed range by
range of a sorted table. Aggregates over (prefix sums, depth) make the nodes; a prefix that
many conversations share is combined in every task before the shuffle.

Subtree sums: each node gives an enter and an exit arc of the tour around the trie. The
successor of an arc is the first child's enter arc, the next sibling's or the parent's exit
arc, found from the nodes' places in the order of (parent, smallest member). The list is
ranked in two steps: tasks that hold a range of (smallest member, depth) contract the
stretches of the tour that lie within them by pointer jumping, and the contracted list, one
element for each stretch, is ranked by pointer jumping in Spark joins (in one task up to
``TOGETHER`` elements). Prefix sums over the arcs' positions, in blocks of ``BLOCK``, then
give any subtree sum as the difference between its exit and its enter arc.

The digest of a node's members is one chain over an ordered string, which nothing can
split: tasks with a range of the ids join them to texts of at most ``PIECE`` ids first, and
a hot node's texts are then read one after the other by one task that holds one of them.

Defined results: turns with equal numbers follow the order of the SHA-256 of the bytes of
role and text; a null role or text is empty; a null turn comes first; rows without a conv_id are
left out; a repeated row is a turn of its own; an empty table gives no row (no root either);
other columns are left out and their names do not matter. Two different prefixes would be
taken for one only if both 64-bit sums agreed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm.common import partitions, stored

BLOCK = 4_096  # neighbours that one window holds
STRETCH = 1_000_000  # arcs that a task contracts
TOGETHER = 65_536  # stretches up to which one task ranks the contracted list
PIECE = 4_096  # ids in one text of members

WIDE = "decimal(28,0)"  # of a 64-bit number whose sums stay exact


def _sorted_ranges(df: DataFrame, *order: str) -> DataFrame:
    """The rows in ranges of ``order``, stored with the number of their range as ``_part``."""
    return stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def _running(ranges: DataFrame, group: str, order: list[str], sums: dict[str, Column], rows: list[str]) -> DataFrame:
    """``rows`` and the running ``sums`` by ``order`` in each ``group`` of rows in ranges of (group, order).

    A range starts from what its first group had in earlier ranges: one row a range at most.
    """
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranges.groupBy(group, "_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    starts = totals.select(group, "_part", *[F.sum(n).over(before).alias(f"_from_{n}") for n in sums])
    starts = starts.filter(F.col(f"_from_{next(iter(sums))}").isNotNull())
    own = ranges.select("_part", *rows, *[F.sum(c).over(inside).alias(f"_own_{n}") for n, c in sums.items()])
    joined = own.join(F.broadcast(starts), ["_part", group], "left")
    return joined.select(*rows, *[(F.col(f"_own_{n}") + F.coalesce(f"_from_{n}", F.lit(0))).alias(n) for n in sums])


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, place (from 0), digest of (role, text) and size of the text in bytes, for every turn."""
    said, role_text = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.octet_length(role_text).cast("string"), F.concat(role_text, said)), 256)
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("_turn"), digest.alias("digest"), F.octet_length(said).cast("long").alias("size")
    )
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # repeated rows, alike in all else, share no range
    ranges = _sorted_ranges(rows, "conv", "_turn", "digest", "_row")
    placed = _running(ranges, "conv", ["_turn", "digest", "_row"], {"place": F.lit(1).cast("long")}, ["conv", "digest", "size"])
    return placed.withColumn("place", F.col("place") - 1)


def rebuilt(own: DataFrame) -> DataFrame:
    """conv, place, digest and size of the rebuilt turns; a conversation without any has one row whose place is null.

    The first h turns come from the conversation whose id is conv - conv % 5, the others are
    the own ones from the h-th on; h is the hash of the id modulo 9.
    """
    own = stored(own)
    heads = F.crc32(F.col("conv").cast("string")) % F.lit(9)
    sizes = stored(own.groupBy("conv").agg(F.count(F.lit(1)).alias("_turns")))
    plans = sizes.select("conv", "_turns", heads.alias("_h"), (F.col("conv") - F.col("conv") % 5).alias("_source"))
    sources = sizes.select(F.col("conv").alias("_source"), F.col("_turns").alias("_theirs"))
    plans = plans.join(sources, "_source", "left").withColumn("_head", F.least("_h", F.coalesce("_theirs", F.lit(0))))
    plans = stored(plans)
    first = own.filter("place < 8").withColumnRenamed("conv", "_source")  # h is 8 at most
    led = plans.join(first, "_source").filter("place < _head").select("conv", "place", "digest", "size")
    rest = own.join(plans.select("conv", "_h", "_head"), "conv").filter("place >= _h")
    rest = rest.select("conv", (F.col("place") - F.col("_h") + F.col("_head")).alias("place"), "digest", "size")
    none = F.lit(None)
    bare = plans.filter("_head + greatest(_turns - _h, 0) = 0").select("conv", none.cast("long").alias("place"), none.cast("string").alias("digest"), none.cast("long").alias("size"))
    return led.union(rest).union(bare)


def _key(number: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(number), *parts)


def prefixes(rows: DataFrame) -> DataFrame:
    """conv, depth, key and parent's key (k1, k2, p1, p2), size, of every prefix; depth 0 for every conversation."""
    place = F.col("place").cast("long")
    turn = rows.filter("place is not null").select("conv", "place", "size", _key(1, place, F.col("digest")).alias("_h1"), _key(2, F.col("digest"), place).alias("_h2"))
    ranges = _sorted_ranges(turn, "conv", "place")
    sums = {"_s1": F.col("_h1").cast(WIDE), "_s2": F.col("_h2").cast(WIDE)}
    summed = _running(ranges, "conv", ["place"], sums, ["conv", "place", "size", "_h1", "_h2"])
    depth = F.col("place") + 1
    before = [F.col(s) - F.col(h) for s, h in (("_s1", "_h1"), ("_s2", "_h2"))]

    def keys(d: Column, one: Column, two: Column) -> list[Column]:
        wide = [c.cast("decimal(38,0)") for c in (one, two)]
        return [_key(3, d, *wide), _key(4, *wide, d)]

    nodes = [*keys(depth, F.col("_s1"), F.col("_s2")), *keys(depth - 1, *before)]
    inner = summed.select("conv", depth.alias("depth"), *[c.alias(n) for c, n in zip(nodes, ("k1", "k2", "p1", "p2"))], "size")
    zero = F.lit(0).cast("long")
    root = [c.alias(n) for c, n in zip(keys(zero, zero, zero), ("k1", "k2"))]
    none = F.lit(None).cast("long")
    tops = rows.select("conv").distinct().select("conv", zero.alias("depth"), *root, none.alias("p1"), none.alias("p2"), zero.alias("size"))
    return inner.union(tops)


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, conv) rows in order -> (k1, k2, first conv, the ids in one text)."""
    node, held = None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["k1", "k2", "first", "ids"])

    for batch in batches:
        done = []
        for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if held and ((k1, k2) != node or len(held) == PIECE):
                done.append((*node, held[0], ",".join(map(str, held))))
                held = []
            node = (k1, k2)
            held.append(conv)
        if done:
            yield batch_of(done)
    if held:
        yield batch_of([(*node, held[0], ",".join(map(str, held)))])


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, first, ids) rows in order -> (k1, k2, SHA-256 of the ids joined by commas)."""
    node, state = None, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        done = []
        for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (k1, k2) == node:
                state.update(b",")
            else:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield batch_of(done)
    if node:
        yield batch_of([(*node, state.hexdigest())])


def ends(rows: DataFrame) -> DataFrame:
    """k1, k2 and the digest of the ids of the conversations that end at a node."""
    last = rows.groupBy("conv").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("_end"))
    last = last.select("_end.k1", "_end.k2", "conv")
    order = ["k1", "k2", "conv"]
    pieces = stored(last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined_ids, "k1 long, k2 long, first long, ids string"))
    lined = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return lined.mapInArrow(_chained, "k1 long, k2 long, ends_sha256 string")


def _numbered(nodes: DataFrame) -> DataFrame:
    """The nodes with their place ``g`` in the order of (parent, smallest member): siblings are neighbours."""
    ranges = _sorted_ranges(nodes, "p1", "p2", "conv")
    counts = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy("_part").orderBy("p1", "p2", "conv")
    placed = ranges.withColumn("_own", F.row_number().over(inside) - 1).join(F.broadcast(counts), "_part")
    return stored(placed.withColumn("g", F.col("_from") + F.col("_own")).drop("_part", "_from", "_own"))


def _families(nodes: DataFrame) -> DataFrame:
    """p1, p2, first and last child's place and their number, for every node with children."""
    children = nodes.filter("p1 is not null")
    return children.groupBy("p1", "p2").agg(F.min("g").alias("_first"), F.max("g").alias("_last"), F.count(F.lit(1)).alias("n_children"))


def tour(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """conv, depth, arc and next arc of the Euler tour: enter arcs are 2g, exit arcs 2g + 1; the last one has no next.

    ``nodes`` have g, conv, depth and, where they have children, ``_first`` and ``_last``.
    """
    enter, leave = F.col("g") * 2, F.col("g") * 2 + 1
    entering = nodes.select("conv", "depth", enter.alias("arc"), F.coalesce(F.col("_first") * 2, leave).alias("next"))
    # the exit of a last child leads to the exit of its parent, that of another child to its next sibling
    up = nodes.filter("_last is not null").select((F.col("_last")).alias("g"), leave.alias("_up"))
    leaving = nodes.select("g", "conv", "depth").join(up, "g", "left")
    after = F.when(F.col("_up").isNotNull(), F.col("_up")).when(F.col("depth") > 0, F.col("g") * 2 + 2)
    return entering.union(leaving.select("conv", "depth", leave.alias("arc"), after.alias("next")))


def _contracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(arc, next) rows of a task -> (arc, first arc of its stretch, places after it, next if it ends the stretch)."""
    table = pa.Table.from_batches(batches, schema=pa.schema([("arc", pa.int64()), ("next", pa.int64())]))
    if not table.num_rows:
        return
    arc, after = table["arc"].to_numpy(), table["next"].fill_null(-1).to_numpy()
    order = np.argsort(arc)
    arc, after = arc[order], after[order]
    at = np.minimum(np.searchsorted(arc, after), len(arc) - 1)
    inside = arc[at] == after
    before = np.arange(len(arc))  # the arc before, or the arc itself at the start of a stretch
    before[at[inside]] = np.flatnonzero(inside)
    places = (before != np.arange(len(arc))).astype(np.int64)
    while True:
        further = before[before]
        if (further == before).all():
            break
        places += places[before]
        before = further
    ending = pa.array(after, mask=inside | (after < 0))
    columns = [pa.array(arc), pa.array(arc[before]), pa.array(places), ending, pa.array(~inside)]
    whole = pa.RecordBatch.from_arrays(columns, names=["arc", "stretch", "_offset", "next", "_ends"])
    for start in range(0, whole.num_rows, 100_000):
        yield whole.slice(start, 100_000)


def _jumped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stretch, next, places from its first arc to the end of the list) of a whole list by pointer jumping."""
    table = pa.Table.from_batches(batches, schema=pa.schema([("stretch", pa.int64()), ("next", pa.int64()), ("to_end", pa.int64())]))
    if not table.num_rows:
        return
    name, after, far = table["stretch"].to_numpy(), table["next"].fill_null(-1).to_numpy(), table["to_end"].to_numpy()
    order = np.argsort(name)
    name, after, far = name[order], after[order], np.append(far[order], 0)
    at = np.append(np.where(after < 0, len(name), np.searchsorted(name, after)), len(name))
    while (at[:-1] < len(name)).any():
        far, at = far + far[at], at[at]
    none = pa.nulls(len(name), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(name), none, pa.array(far[:-1])], names=["stretch", "next", "to_end"])


def ranked(arcs: DataFrame, count: int, stretch: int = STRETCH, together: int = TOGETHER) -> DataFrame:
    """arc and its position from 0, of a list of ``count`` arcs (conv, depth, arc, next)."""
    tasks = max(partitions(arcs.sparkSession), -(-count // stretch))
    local = arcs.repartitionByRange(tasks, "conv", "depth").select("arc", "next")
    local = stored(local.mapInArrow(_contracted, "arc long, stretch long, _offset long, next long, _ends boolean"))
    schema = "stretch long, next long, to_end long"
    listed = stored(local.filter("_ends").select("stretch", "next", (F.col("_offset") + 1).alias("to_end")))
    if listed.count() <= together:
        listed = listed.coalesce(1).mapInArrow(_jumped, schema)
    else:
        while not listed.filter("next is not null").isEmpty():
            ahead = listed.select(F.col("stretch").alias("next"), F.col("next").alias("_next"), F.col("to_end").alias("_more"))
            far = listed.filter("next is not null").join(ahead, "next").select("stretch", F.col("_next").alias("next"), (F.col("to_end") + F.col("_more")).alias("to_end"))
            listed = stored(far.union(listed.filter("next is null")))
    starts = listed.select("stretch", (F.lit(count) - F.col("to_end")).alias("_start"))
    return local.join(starts, "stretch").select("arc", (F.col("_start") + F.col("_offset")).alias("position"))


def prefix_sums(rows: DataFrame, count: int, values: list[str], block: int = BLOCK) -> DataFrame:
    """The rows, positions 0 to ``count`` - 1, with the sums of ``values`` up to each (``sum_*``), in blocks of ``block``."""
    inside = Window.partitionBy("_block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_block", F.expr(f"position div {block}"))
    own = placed.select("*", *[F.sum(v).over(inside).alias(f"sum_{v}") for v in values])
    if count <= block:
        return own.drop("_block")
    blocks = placed.groupBy(F.col("_block").alias("position")).agg(*[F.sum(v).alias(v) for v in values])
    totals = prefix_sums(blocks, -(-count // block), values, block)
    starts = totals.select((F.col("position") + 1).alias("_block"), *[F.col(f"sum_{v}").alias(f"_from_{v}") for v in values])
    kept = [*rows.columns, *[(F.col(f"sum_{v}") + F.coalesce(f"_from_{v}", F.lit(0))).alias(f"sum_{v}") for v in values]]
    return own.join(starts, "_block", "left").select(*kept)


def _parents(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """g and parent_conv_id of every node with a parent; the children of one parent meet it in blocks of ``BLOCK``."""
    whose = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id")).join(families, ["p1", "p2"])
    blocks = F.explode(F.sequence(F.expr(f"_first div {BLOCK}"), F.expr(f"_last div {BLOCK}")))
    whose = whose.select("p1", "p2", "parent_conv_id", blocks.alias("_block"))
    children = nodes.filter("p1 is not null").select("g", "p1", "p2", F.expr(f"g div {BLOCK}").alias("_block"))
    return children.join(whose, ["p1", "p2", "_block"]).select("g", "parent_conv_id")


def trie(rows: DataFrame, stretch: int = STRETCH, together: int = TOGETHER) -> DataFrame:
    """The nodes of the trie of the given turns (conv, place from 0 without gaps, digest, size)."""
    found = stored(prefixes(rows))
    nodes = found.groupBy("k1", "k2", "depth", "p1", "p2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"))
    nodes = _numbered(nodes)
    count = 2 * nodes.count()
    families = stored(_families(nodes))
    own = families.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "_first", "_last", "n_children")
    nodes = stored(nodes.join(own, ["k1", "k2"], "left"))
    positions = ranked(tour(nodes, families), count, stretch, together)
    saved = (F.col("n_convs") - 1) * F.col("size")
    weights = nodes.select((F.col("g") * 2).alias("arc"), F.col("_first").isNull().cast("long").alias("leaf"), saved.alias("saving"))
    zero = F.lit(0).cast("long")
    weights = weights.union(nodes.select(F.col("g") * 2 + 1, zero, zero))
    summed = prefix_sums(stored(positions.join(weights, "arc")), count, ["leaf", "saving"])
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    below = summed.groupBy(F.expr("arc div 2").alias("g")).agg(
        F.sum(sign * F.col("sum_leaf") + F.col("leaf")).alias("n_leaves"), F.sum(sign * F.col("sum_saving") + F.col("saving")).alias("saved_tokens")
    )
    out = nodes.join(below, "g").join(_parents(nodes, families), "g", "left").join(ends(found), ["k1", "k2"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
