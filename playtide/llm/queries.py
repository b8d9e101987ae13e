"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm import embedding_dedup, exact_dedup, langid, lm_score, near_dedup, packing, periodic_runs, pii, prefix_trie, quality, sentencepiece_bpe, topk, url_filter


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    return sentencepiece_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every document; the largest doc_id of equal texts stays."""
    return exact_dedup.membership(table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The sequence and the place of every piece of every document, in sequences of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document among those whose shingle sets are 85 % alike."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"), limit=85)


def op5_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document."""
    return langid.identified(table(spark, folder, "documents"))


def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram base and model score of every document."""
    return lm_score.scored(table(spark, folder, "documents"))


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten vectors with the highest inner product for every hundredth vector."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    return pii.findings(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(table(spark, folder, "conversations"))))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words in every document, made periodic in part by its hash, and the text without them."""
    return periodic_runs.digests(table(spark, folder, "documents"))


def op13_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every vector among those of its label with a cosine of 0.98 or more, and its links."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The rule and the verdict for the url of every page."""
    return url_filter.judge(table(spark, folder, "pages"), RULES)


OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""

OP9 = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC) AS n
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""

OP2 = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

# crc32 bit by bit over the decimal digits of the id
OP11 = """
WITH t AS (
  SELECT conv_id, turn, strlen(coalesce(text, ''))::BIGINT AS size,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, size, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place FROM t),
plan AS (
  SELECT conv_id, count(*) AS turns, conv_id - conv_id % 5 AS source,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                     lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
                                          lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
             4294967295) % 9 AS h
  FROM own GROUP BY conv_id),
head AS (
  SELECT p.conv_id, p.h, p.turns, least(p.h, coalesce(s.turns, 0)) AS head, p.source FROM plan p LEFT JOIN plan s ON s.conv_id = p.source),
built AS (
  SELECT h.conv_id, o.place, o.digest, o.size FROM head h JOIN own o ON o.conv_id = h.source AND o.place < h.head
  UNION ALL
  SELECT h.conv_id, o.place - h.h + h.head, o.digest, o.size FROM head h JOIN own o ON o.conv_id = h.conv_id AND o.place >= h.h),
m AS (
  SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS size FROM head
  UNION ALL
  SELECT conv_id, place + 1, string_agg(digest, ',') OVER w,
         CASE WHEN place = 0 THEN '' ELSE string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END, size
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
z AS (SELECT conv_id, max(depth) AS last FROM m GROUP BY conv_id),
n AS (
  SELECT node, any_value(parent) AS parent, m.depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE z.last = m.depth), '')) AS ends_sha256
  FROM m JOIN z USING (conv_id) GROUP BY node, m.depth),
k AS (
  SELECT n.*, (SELECT count(*) FROM n c WHERE c.parent = n.node) AS n_children FROM n),
s AS (
  SELECT a.node, sum((k.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((k.n_convs - 1) * k.size)::BIGINT AS saved_tokens
  FROM k JOIN m a ON a.conv_id = k.conv_id AND a.depth <= k.depth GROUP BY a.node)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
FROM k JOIN s USING (node) LEFT JOIN n p ON p.node = k.parent
"""

OP13 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 ELSE false END),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to a function of (spark, folder of tables)."""
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_packing": op3_packing,
        "op4_near_dedup": op4_near_dedup,
        "op5_langid": op5_langid,
        "op6_lm_score": op6_lm_score,
        "op7_topk": op7_topk,
        "op8_quality": op8_quality,
        "op9_url_filter": op9_url_filter,
        "op10_pii": op10_pii,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_embedding_dedup": op13_embedding_dedup,
    }


def statements() -> dict[str, str]:
    """Query name to SQL over the same tables."""
    return {"op2_exact_dedup": OP2, "op7_topk": OP7, "op9_url_filter": OP9, "op11_prefix_trie": OP11, "op13_embedding_dedup": OP13}
