"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents with one
and the same set form a class; from here on only classes count, so copies cost nothing.
Each class has ``COORDINATES`` minhashes. A tree starts with all classes; a node picks one
coordinate at random, now and then two, and sends each class to the child of its minwise
value there. Nodes of one class end; small nodes are compared exhaustively, larger ones
branch on: first as a Spark job per level, and once a node fits in a task, inside the task.
Independent trees repeat this until the target recall is met.

Comparisons estimate the similarity from the minhashes; pairs within four standard errors
of the limit or above become candidates, and a candidate counts only when the full sets,
made again from the texts, confirm it. Two passes keep candidates few and lose none: the
first takes, in the first trees, a forest of the most similar pairs of each node, and
joins classes along confirmed links; the second takes, in all trees, the classes that are
close to one of another component, brings their texts to the node and compares full sets,
the most similar first, until the components are one or all close pairs are refuted. So
links never outnumber the members of a node. What is left in nodes that ``LEVELS`` levels do
not make small enough is cut into blocks, and the second pass compares every two blocks that
are not of one component, each pair a task of its own and without branching: exact, and
quadratic in the classes that are alike but below the limit. Components come from alternating
large-star and small-star steps.

Recall: one coordinate separates a pair of similarity s with probability 1 - s, so a pair
at 0.85 in nodes that end at the root is missed by nine trees with probability below 1e-7;
nodes that branch d times keep a pair by a branching process of mean s * 1.25 per level.
Below a limit of 85 there are twelve trees and enough second coordinates for a mean of 1.16
per level: by that process a pair at 0.80 is missed with probability 0.0001 after 8 levels
and 0.0009 after 15, the spread of its estimate counted in.

Defined results: A-Z are lower-cased, words are runs without ASCII white space; fewer words
than a shingle make one shingle; a null text or one without words has no shingle, is linked
with nothing and is its own component. Rows with a null doc_id take part; the smallest
non-null id names the component. Repeated rows are one class. An empty table gives no row.
``near_duplicates`` leaves other columns out, ``deduplicated`` keeps them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import apart, each_group, sliced, stored, whole

WORDS = 5  # of a shingle
COORDINATES = 128  # minhashes of a class
TREES, FIRST_TREES = 9, 3  # of the second and of the first pass
SECOND = 0.25  # share of nodes that branch on two coordinates
LIMIT, LOWER_TREES, MEAN = 85, 12, 1.16  # below this limit: trees, and children per level that hold a pair at the limit
SMALL = 128  # classes up to which a node is compared exhaustively
LARGE = 2_000  # classes above which a node branches in a Spark job of its own
LEVELS = 8  # Spark jobs that branch; a node that is still larger is compared block against block
BROADCAST_ROWS = 1_000_000  # of 40 bytes; more candidates meet their texts in a shuffle
ROWS, CHARS = 250, 1_000_000

_random = np.random.RandomState(20240607)
_ODD = _random.randint(0, 2**63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.randint(0, 2**63, COORDINATES, np.uint64)
_PLACE = _random.randint(0, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space
    if len(_words) > 60_000:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(h))
    if not size:
        return h
    with np.errstate(over="ignore"):
        total = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            total += h[k : len(h) - size + 1 + k] * _PLACE[k]
    return np.unique(mix(total))


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """The least of each coordinate's 32-bit hash over a set."""
    least = np.full(COORDINATES, 2**32 - 1, np.uint32)
    for start in range(0, len(hashes), 1024):
        with np.errstate(over="ignore"):
            values = ((hashes[start : start + 1024, None] * _ODD + _ADD) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, values.min(axis=0), out=least)
    return least


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, hash) -> (id, hash, n_shingles, digest of the set, minhashes)."""
    for batch in sliced(batches, ROWS, CHARS, "text"):
        sizes, digests, signatures = [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            signatures.append(minhashes(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            names=["_id", "_text_hash", "n_shingles", "_set", "_sig"],
        )


def _second(limit: int) -> float:
    """Share of nodes that branch on two coordinates: as many as keep a pair at the limit on its way."""
    return SECOND if limit >= LIMIT else min(1.0, 100 * MEAN / limit - 1)


def _children(nodes: np.ndarray, signatures: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and child node of each branch that the rows take from their nodes."""
    at = np.arange(len(nodes))
    first = mix(nodes ^ np.uint64(0xA5A5A5A5)) % np.uint64(COORDINATES)
    again = mix(nodes ^ np.uint64(0x5A5A5A5A5A))
    two = (again >> np.uint64(11)) < np.uint64(share * 2**53)
    second = again % np.uint64(COORDINATES)
    rows = np.concatenate([at, at[two]])
    coordinate = np.concatenate([first, second[two]])
    value = signatures[rows, coordinate.astype(np.int64)].astype(np.uint64)
    with np.errstate(over="ignore"):
        child = mix(mix(nodes[rows] + coordinate * np.uint64(0x9E3779B97F4A7C15)) ^ value)
    return rows, child


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _branch(names: list[str], share: float, trees: int = 0):
    """A task from (node?, cls, _sig, ...) rows to their rows in the child nodes; roots if ``trees``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                found = _signatures(part.column(part.schema.get_field_index("_sig")))
                cls = part.column(part.schema.get_field_index("cls")).to_numpy()
                if trees:
                    sets = [(t, mix(np.full(len(cls), t + 1, np.uint64))) for t in range(trees)]
                else:
                    tree = part.column(part.schema.get_field_index("tree")).to_numpy()
                    sets = [(tree, part.column(part.schema.get_field_index("node")).to_numpy().view(np.uint64))]
                for tree, nodes in sets:
                    rows, child = _children(nodes, found, share)
                    whose = np.full(len(rows), tree, np.int32) if trees else tree[rows]
                    yield pa.RecordBatch.from_arrays([pa.array(whose.astype(np.int32)), pa.array(child.view(np.int64)), pa.array(cls[rows])], names=names)

    return task


def _close(limit: float) -> float:
    """Least estimate of a candidate: four standard errors below the limit."""
    return limit - 4 * (limit * (1 - limit) / COORDINATES) ** 0.5


def _leaves(found: np.ndarray, labels: np.ndarray, node: int, share: float) -> Iterator[np.ndarray]:
    """Members of the nodes to compare below a node of a task, without those of one component.

    A node branches on as long as that saves comparisons: similar classes, which would stay
    together for many levels, are compared where they are.
    """
    stack = [(np.arange(len(found)), np.uint64(node))]
    while stack:
        members, name = stack.pop()
        if len(members) < 2 or (labels[members] == labels[members[0]]).all():
            continue
        if len(members) <= SMALL:
            yield members
            continue
        rows, child = _children(np.full(len(members), name, np.uint64), found[members], share)
        order = np.argsort(child, kind="stable")
        rows, child = rows[order], child[order]
        cuts = [0, *(np.flatnonzero(child[1:] != child[:-1]) + 1).tolist(), len(child)]
        if 2 * sum((b - a) ** 2 for a, b in zip(cuts, cuts[1:])) > len(members) ** 2:
            yield members
            continue
        stack += [(members[rows[a:b]], child[a]) for a, b in zip(cuts, cuts[1:]) if b - a > 1]


def _alike(found: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of one member and others."""
    return np.count_nonzero(found[others] == found[one], axis=1) / COORDINATES


def _forest(found: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Edges of a maximum spanning forest of the estimates, grown from one member to the next (Prim)."""
    best, source, left, now, out = np.full(len(found), -1.0), np.zeros(len(found), np.int64), np.arange(1, len(found)), 0, []
    while len(left):
        estimate = _alike(found, now, left)
        closer = estimate > best[left]
        best[left[closer]], source[left[closer]] = estimate[closer], now
        at = int(best[left].argmax())
        now = int(left[at])
        if best[now] >= least:
            out.append((int(source[now]), now, float(best[now])))
        left = np.delete(left, at)
    return out


def _crossing(found: np.ndarray, labels: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """All pairs of different components whose estimate is high enough."""
    out = []
    for one in range(len(found) - 1):
        others = one + 1 + np.flatnonzero(labels[one + 1 :] != labels[one])
        estimate = _alike(found, one, others)
        out += [(one, int(o), float(e)) for o, e in zip(others[estimate >= least], estimate[estimate >= least])]
    return out


def _candidates(limit: int, forest: bool):
    """A task from rows sorted by node (node, cls, label, _sig) to candidate pairs of classes."""
    least, share = _close(limit / 100), _second(limit)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in each_group(batches, "node"):
            cls, at = np.unique(node["cls"].to_numpy(), return_index=True)
            if len(cls) < 2:
                continue
            found = _signatures(node["_sig"])[at]
            labels = node["label"].to_numpy()[at]
            edges: dict[tuple[int, int], float] = {}
            for m in _leaves(found, labels, node["node"][0].as_py() % 2**64, share):
                pairs = _forest(found[m], least) if forest else _crossing(found[m], labels[m], least)
                edges.update({(min(m[a], m[b]), max(m[a], m[b])): e for a, b, e in pairs})
            if not edges:
                continue
            a, b = np.array(list(edges), np.int64).T
            estimate = np.array(list(edges.values()))
            if forest:
                leader = np.arange(len(cls))
                kept = []
                for i in np.argsort(-estimate, kind="stable").tolist():
                    x, y = a[i], b[i]
                    while leader[x] != x:
                        leader[x] = x = leader[leader[x]]
                    while leader[y] != y:
                        leader[y] = y = leader[leader[y]]
                    if x != y:
                        leader[max(x, y)] = min(x, y)
                        kept.append(i)
                a, b = a[kept], b[kept]
            if len(a):
                first, second = np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b])
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second)], names=["a", "b"])

    return task


def _involved(limit: int, whole: bool = False):
    """A task from rows sorted by node (node, cls, label, _sig) to the members that are close to one of another component; ``whole`` nodes do not branch."""
    least, share = _close(limit / 100), _second(limit)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in each_group(batches, "node"):
            cls, at = np.unique(node["cls"].to_numpy(), return_index=True)
            found, labels = _signatures(node["_sig"])[at], node["label"].to_numpy()[at]
            close = np.zeros(len(cls), bool)
            leaves = [np.arange(len(cls))] if whole else _leaves(found, labels, node["node"][0].as_py() % 2**64, share)
            for m in leaves:
                for i, one in enumerate(m[:-1].tolist()):
                    others = m[i + 1 :][labels[m[i + 1 :]] != labels[one]]
                    others = others[_alike(found, one, others) >= least]
                    close[others] = True
                    close[one] |= len(others) > 0
            if close.any():
                columns = [pa.array(np.full(close.sum(), node["node"][0].as_py())), pa.array(cls[close]), pa.array(labels[close])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "cls", "label"])

    return task


def _joined(limit: int):
    """A task from rows sorted by node (node, cls, label, _sig, text) to links of full sets that join components.

    A member is compared with the members of other components that its minhashes allow, the
    most similar first, until a link joins the two components: no more links than members.
    """
    least = _close(limit / 100)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in each_group(batches, "node"):
            cls, at = np.unique(node["cls"].to_numpy(), return_index=True)
            found, labels = _signatures(node["_sig"])[at], node["label"].to_numpy()[at]
            texts = node["text"].to_pylist()
            sets, a, b = [shingles(texts[i]) for i in at.tolist()], [], []
            for one in range(len(cls) - 1):
                others = one + 1 + np.flatnonzero(labels[one + 1 :] != labels[one])
                estimate = _alike(found, one, others)
                for other in others[np.argsort(-estimate, kind="stable")][: (estimate >= least).sum()].tolist():
                    if labels[other] == labels[one]:
                        continue
                    both = len(np.intersect1d(sets[one], sets[other], assume_unique=True))
                    if 100 * both >= limit * (len(sets[one]) + len(sets[other]) - both):
                        a.append(cls[one])
                        b.append(cls[other])
                        labels = np.where(labels == labels[other], labels[one], labels)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a)), pa.array(np.array(b))], names=["a", "b"])

    return task


def _confirm(limit: int):
    """A task that keeps the pairs whose full sets are similar enough (``limit`` in hundredths)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = np.zeros(0, np.uint64), None
        for batch in sliced(batches, ROWS, CHARS, "text_a"):
            column = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            keep = []
            for a, one, other in zip(column["a"], column["text_a"], column["text_b"]):
                if a != last:
                    held, last = shingles(one), a
                set_b = shingles(other)
                both = len(np.intersect1d(held, set_b, assume_unique=True))
                keep.append(100 * both >= limit * (len(held) + len(set_b) - both))
            chosen = batch.filter(pa.array(keep)).select(["a", "b"])
            if chosen.num_rows:
                yield chosen

    return task


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest reachable.

    Large-star links the larger neighbours of a node to its smallest neighbour, small-star
    the smaller ones; both keep components whole and end when every link goes to its root.
    """
    edges, before = stored(links.select("a", "b").filter("a < b").distinct()), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        large = large.filter("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("m"), "a", "b")
        small = small.select(F.col("m").alias("a"), "b").union(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        edges = stored(small.filter("a < b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _nodes(classes: DataFrame, trees: int, share: float) -> tuple[DataFrame, DataFrame | None]:
    """(tree, node, cls) of all nodes with two classes or more and about ``LARGE`` at most, and (node, cls) of larger ones.

    The larger ones are among the first too, in parts that each have the node's first class:
    enough for the first pass to join what is alike, not for pairs across parts.
    """
    schema = "tree int, node long, cls long"
    names = ["tree", "node", "cls"]
    level = stored(classes.select("cls", "_sig").mapInArrow(_branch(names, share, trees), schema))
    done, over = [], None
    for depth in range(LEVELS):
        counted = level.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.min("cls").alias("_first"))
        kept = level.join(counted.filter("_n > 1"), "node")
        if depth == LEVELS - 1:
            over = stored(kept.filter(F.col("_n") > LARGE).select("node", "cls"))
            parts = F.ceil(F.col("_n") / LARGE)
            own = kept.withColumn("_part", F.pmod(F.xxhash64("cls"), parts)).select("tree", "node", "cls", "_part")
            led = counted.filter("_n > 1").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            led = led.select(F.lit(0).alias("tree"), "node", F.col("_first").alias("cls"), "_part")
            done.append(own.union(led).select("tree", F.xxhash64("node", "_part").alias("node"), "cls").distinct())
            break
        done.append(kept.filter(F.col("_n") <= LARGE).select(*names))
        large = stored(counted.filter(F.col("_n") > LARGE))
        if large.isEmpty():
            break
        rows = level.join(large, "node").select(*names).join(classes.select("cls", "_sig"), "cls")
        level = stored(rows.mapInArrow(_branch(names, share), schema).distinct())
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return stored(out), None if over is None or over.isEmpty() else over


def _blocks(over: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, cls): every two blocks of the classes of nodes that are too large, unless both are of one component.

    Nodes that share classes are one group, so two classes meet once however many nodes hold
    both. A component of ``LARGE`` classes has blocks of its own, the rest of a group is dealt
    by hash.
    """
    first = over.groupBy("cls").agg(F.min("node").alias("a"))
    shared = over.join(first, "cls").select("a", F.col("node").alias("b")).distinct()
    roots = components(shared).withColumnRenamed("root", "_root")
    group = first.join(roots, first["a"] == roots["node"], "left").select("cls", F.coalesce("_root", "a").alias("_group"))
    marked = group.join(labels, group["cls"] == labels["_of"], "left").select("_group", "cls", F.coalesce("root", "cls").alias("label"))
    marked = stored(marked)
    own = marked.groupBy("_group", "label").agg(F.count(F.lit(1)).alias("_n"))
    own = own.withColumn("_own", F.when(F.col("_n") >= LARGE, F.col("label")))
    sized = own.groupBy("_group", "_own").agg(F.ceil(F.sum("_n") / LARGE).alias("_blocks"))
    large = own.filter("_own is not null").select("_group", "label", "_own")
    held = marked.join(large, ["_group", "label"], "left")
    dealt = held.join(sized.withColumnsRenamed({"_group": "_g", "_own": "_o"}), (F.col("_group") == F.col("_g")) & F.col("_own").eqNullSafe(F.col("_o")))
    dealt = dealt.select("_group", "cls", "_own", F.pmod(F.xxhash64("cls"), "_blocks").alias("_block"))
    one = sized.select("_group", "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block"))
    one = stored(one.withColumn("_at", F.xxhash64("_group", F.coalesce("_own", F.lit(-1)), "_block")))
    two = one.select("_group", F.col("_own").alias("_own2"), F.col("_at").alias("_at2"))
    pairs = one.join(two, "_group").filter("_at <= _at2 and not coalesce(_own = _own2, false)")
    pairs = pairs.select("_at", "_at2", F.xxhash64("_at", "_at2").alias("node"))
    ends = stored(pairs.select("_at", "node").union(pairs.select("_at2", "node")).distinct())
    dealt = dealt.withColumn("_at", F.xxhash64("_group", F.coalesce("_own", F.lit(-1)), "_block"))
    return dealt.join(ends, "_at").select("node", "cls")


def _spread(nodes: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, cls, label, _sig) of the nodes with two components or more, sorted by node."""
    marked = nodes.join(labels, nodes["cls"] == labels["_of"], "left").select("node", "cls", F.coalesce("root", "cls").alias("label"))
    mixed = marked.groupBy("node").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
    rows = marked.join(mixed.select("node"), "node").join(classes.select("cls", "_sig"), "cls")
    return rows.repartition("node").sortWithinPartitions("node").select("node", "cls", "label", "_sig")


def _texts_of(chosen: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(cls, text) of the chosen classes."""
    chosen = stored(chosen.distinct().join(classes.select("cls", "_id", "_set"), "cls"))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    own = texts.join(chosen, texts["_tid"].eqNullSafe(chosen["_id"])).select("cls", "_set", "text")
    return stored(own.mapInArrow(_own_text, "cls long, text string")).dropDuplicates(["cls"])


def _first_links(nodes: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, limit: int) -> DataFrame:
    """Confirmed links among the forests of all nodes."""
    pairs = stored(_spread(nodes, classes, labels).mapInArrow(_candidates(limit, True), "a long, b long").distinct())
    held = _texts_of(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))), classes, texts)
    full = pairs.join(held.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    full = full.join(held.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return stored(full.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(limit), "a long, b long"))


def _second_links(nodes: DataFrame, over: DataFrame | None, classes: DataFrame, labels: DataFrame, texts: DataFrame, limit: int) -> DataFrame:
    """Confirmed links that join the components which the first pass has left apart."""
    schema = "node long, cls long, label long"
    members = _spread(nodes, classes, labels).mapInArrow(_involved(limit), schema)
    if over is not None:
        members = members.union(_spread(_blocks(over, labels), classes, labels).mapInArrow(_involved(limit, True), schema))
    members = stored(members)
    held = _texts_of(members.select("cls"), classes, texts)
    rows = members.join(classes.select("cls", "_sig"), "cls").join(held, "cls")
    rows = rows.repartition("node").sortWithinPartitions("node").select("node", "cls", "label", "_sig", "text")
    return stored(rows.mapInArrow(_joined(limit), "a long, b long").distinct())


def _own_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, set digest, text): only texts with that set, as an id may be repeated with another text."""
    for batch in sliced(batches, ROWS, CHARS, "text"):
        texts, sets = batch.column(2).to_pylist(), batch.column(1).to_pylist()
        keep = [len(found := shingles(t)) > 0 and xxhash.xxh3_128_digest(found.tobytes()) == s for t, s in zip(texts, sets)]
        yield batch.filter(pa.array(keep)).select(["cls", "text"])


def _members(docs: DataFrame, limit: int, trees: int | None, text: str, doc_id: str) -> DataFrame:
    """_id, _text_hash, n_shingles, component_id and the component's _root (null without shingles) of every row."""
    texts = docs.select(F.col(doc_id).alias("_tid"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    signed = texts.withColumn("_hash", F.xxhash64("text")).mapInArrow(_signed, f"_id {kind}, _text_hash long, n_shingles long, _set binary, _sig binary")
    rows = stored(signed.withColumns({"_row": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))
    sets = stored(rows.filter("_set is not null").groupBy("_set").agg(F.min("_row").alias("cls"), F.min("_id").alias("_least")))
    classes = rows.join(sets.select(F.col("cls").alias("_row")), "_row").select(F.col("_row").alias("cls"), "_id", "_set", "_sig")
    classes = stored(classes)
    spark = docs.sparkSession
    nodes, over = _nodes(classes, trees or (TREES if limit >= LIMIT else LOWER_TREES), _second(limit))
    none = spark.createDataFrame([], "_of long, root long")
    first = _first_links(nodes.filter(F.col("tree") < FIRST_TREES), classes, none, texts, limit)
    joined = components(first)
    second = _second_links(nodes, over, classes, joined.withColumnRenamed("node", "_of"), texts, limit)
    if not second.isEmpty():
        joined = components(first.union(second))
    named = sets.join(joined, sets["cls"] == joined["node"], "left").select("_set", "_least", F.coalesce("root", "cls").alias("root"))
    named = stored(named)
    lowest = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = named.join(lowest, "root").select("_set", "component_id", F.col("root").alias("_root"))
    # one row per set and partition meets the answer, and the rows of a partition then meet it
    pairs = rows.filter("_set is not null").select("_set", "_part").distinct().join(named, "_set")
    out = rows.select("_id", "_text_hash", "n_shingles", "_set", "_part").join(pairs, ["_set", "_part"], "left")
    return out.select("_id", "_text_hash", "n_shingles", F.coalesce("component_id", "_id").alias("component_id"), "_root")


def near_duplicates(docs: DataFrame, limit: int = 85, trees: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; ``limit``: similarity in hundredths."""
    kept = F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return _members(docs, limit, trees, text, doc_id).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", kept)


def deduplicated(docs: DataFrame, limit: int = 80, trees: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of which one of each component stays, that with the smallest doc_id.

    Where rows of a component repeat this id, one of them stays: that of the text with the
    smallest hash. A row without an id stays unless its component has a row with one.
    """
    found = stored(_members(docs, limit, trees, text, doc_id).filter("component_id is not null"))
    least = found.filter("_id <=> component_id and _root is not null").groupBy("_root", "_id").agg(F.count(F.lit(1)).alias("_n"), F.min("_text_hash").alias("_key"))
    again = stored(least.filter("_n > 1").select("_root", "_id", "_key"))
    other = found.join(again, ["_root", "_id"]).filter("_text_hash != _key")
    lost = found.filter("not (_id <=> component_id)").select("_id", "_text_hash").union(other.select("_id", "_text_hash"))
    rows = apart(docs, text, doc_id).withColumn("_key", F.xxhash64("_words"))

    def meets(chosen: DataFrame, how: str) -> DataFrame:
        if chosen.count() <= BROADCAST_ROWS:
            chosen = F.broadcast(chosen)
        return rows.join(chosen, rows["_own"].eqNullSafe(chosen["_id"]) & (rows["_key"] == chosen["_text_hash"]), how)

    lost = stored(lost.distinct())
    if again.isEmpty():
        return whole(meets(lost, "left_anti"), docs.columns, text)
    one = stored(again.select("_id", F.col("_key").alias("_text_hash")).distinct())
    kept = meets(lost.union(one), "left_anti").unionByName(meets(one, "left_semi").dropDuplicates(["_own", "_key"]))
    return whole(kept, docs.columns, text)
