"""Personal data: fixed patterns, and terms that give away what the patterns protect.

Email addresses, ip addresses, card and phone numbers are found by patterns. The method then
looks at the words of all documents that hold one of these entities, at any distance: a
term's disclosure of an entity is the share of the documents with the term that hold the
entity, P(entity | term), and the information it gives is log2(P(entity | term) / P(entity)),
where P(entity) counts the entity once for each document that holds it among all words. A
term that reaches both thresholds in ``SUPPORT`` different texts (copies of a text are one)
is generalised wherever it stands, as a document without the entity reveals it too. Before
texts, terms and entities meet, what cannot reach the thresholds is left out by exact counts.
Everything is DataFrame functions.

Patterns use possessive quantifiers, which find the same matches (no part of a match can be
given back) and need neither recursion nor a second look at a long run of characters.
Positions come from splitting a text at the matches and adding up lengths; they count code
points from 0, ends are exclusive.

Defined results: null text is empty and has no span; a match that fails its check (parts
over 255, Luhn, digit counts) is dropped and not tried again; spans of two kinds may
overlap in the lists, and a sanitised text replaces the union of overlapping spans by the
first one's mark; repeated rows get equal spans; other columns are kept by ``sanitised``,
whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import apart, ascii_lower, stored, whole

SUPPORT = 3  # different texts
DISCLOSED = 0.5  # least P(entity | term)
BITS = 6.0  # least information about the entity
BROADCAST_ROWS = 500_000  # of terms or of documents with marked terms; more are shuffled
MARK = "\uffff"  # no character of any text; stands for those of an entity
WHITE = r"[\x20\x09-\x0D]"
TRIM = ".,;:!?()[]{}\"'<>|*#$%&"  # not part of a term at its ends

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<start:int,end:int>"


def no_spans() -> Column:
    """An empty array of spans."""
    return F.array().cast(f"array<{SPAN}>")


EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: A pattern, a quick test that all its texts pass, and the check of a match.
RULES = {
    "email": (EMAIL, lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True)),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda m: m.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")),
    "card": (CARD, lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), lambda m: F.call_function("luhn_check", F.regexp_replace(m, r"[\x20-]", ""))),
    "phone": (PHONE, lambda t: t.rlike(r"\+[0-9]"), lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)),
}


def matches(text: Column, kind: str) -> Column:
    """Spans of one kind in order: array of (start, end)."""
    pattern, quick, check = RULES[kind]
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), check(m).alias("fits")))
    start = F.struct(F.lit(0).alias("at"), no_spans().alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["fits"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.when(quick(text), F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(no_spans())


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one array of spans per kind."""
    whole = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    return whole.withColumns({f"_{k}": matches(F.col("_text"), k) for k in KINDS})


def _named(kind: str, made: Callable[[str, Column], Column]) -> Column:
    """The spans of a kind, each turned into ``made(kind, span)``."""
    return F.transform(f"_{kind}", lambda s: made(kind, s))


def _rest() -> Column:
    """The text with ``MARK`` for each character of an entity: what touches one is not a word of its own."""
    parts = [_named(k, lambda k, s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS]
    spans = F.sort_array(F.concat(*parts))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        since, until = F.greatest(acc["at"], s["start"]), F.greatest(acc["at"], s["end"])
        piece = F.array(F.substring(F.col("_text"), acc["at"] + 1, since - acc["at"]), F.repeat(F.lit(MARK), until - since))
        return F.struct(until.alias("at"), F.concat(acc["out"], piece).alias("out"))

    end = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, end)).otherwise(F.col("_text"))


def _terms(text: Column) -> Column:
    """Distinct terms of a text."""
    words = F.transform(F.split(ascii_lower(text), f"{WHITE}+"), lambda w: F.btrim(w, F.lit(TRIM)))
    return F.array_distinct(F.filter(words, lambda w: (w != "") & ~F.contains(w, F.lit(MARK))))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def disclosing(docs: DataFrame, text: str = "text") -> DataFrame | None:
    """Terms whose disclosure of an entity reaches the thresholds; None if no entity has the support."""
    spanned = with_spans(docs, text).withColumn("_hash", F.xxhash64("_text"))
    entity = lambda k, s: F.xxhash64(F.lit(k), ascii_lower(F.substring("_text", s["start"] + 1, s["end"] - s["start"])))
    held = spanned.select("_hash", F.explode(F.array_distinct(F.concat(*(_named(k, entity) for k in KINDS)))).alias("_entity"))
    # rows of one text are put together first, so a repeated entity is no hot key
    held = stored(held.groupBy("_entity", "_hash").agg(F.count(F.lit(1)).alias("_n")).hint("rebalance"))
    entities = held.groupBy("_entity").agg(F.count(F.lit(1)).alias("_texts"), F.sum("_n").alias("_rows")).filter(F.col("_texts") >= SUPPORT)
    held = stored(held.join(entities.select("_entity", "_rows"), "_entity"))
    if held.isEmpty():
        return None
    inside = spanned.join(_small(held.select("_hash").distinct()), "_hash", "left_semi").select("_hash", F.explode(_terms(_rest())).alias("term"))
    inside = stored(inside.distinct())
    terms = stored(inside.groupBy("term").agg(F.count(F.lit(1)).alias("_texts")).filter(F.col("_texts") >= SUPPORT).select("term"))
    words = docs.select(F.explode(_terms(F.col(text))).alias("term"))
    most = held.agg(F.max("_rows")).first()[0]
    few = terms.count() <= BROADCAST_ROWS  # otherwise words are counted in each task before they meet the terms
    words = words.join(F.broadcast(terms), "term") if few else words
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("_all")).filter(F.col("_all") * DISCLOSED <= most)
    counted = counted if few else counted.join(terms, "term")
    total = docs.agg(F.sum(F.size(F.split(F.col(text), f"{WHITE}+")))).first()[0] or 1
    rare = inside.join(_small(stored(counted)), "term")
    pairs = rare.join(held, "_hash").filter(F.col("_all") * DISCLOSED <= F.col("_rows"))
    pairs = pairs.groupBy("_entity", "term", "_all", "_rows").agg(F.sum("_n").alias("_both"), F.count(F.lit(1)).alias("_support"))
    share = F.col("_both") / F.greatest("_all", "_both")
    bits = F.log2(share / (F.col("_rows") / F.lit(float(total))))
    return stored(pairs.filter((F.col("_support") >= SUPPORT) & (share >= DISCLOSED) & (bits >= BITS)).select("term").distinct())


def _places(rest: Column, terms: Column) -> Column:
    """Spans of all occurrences of the terms as words, without what is trimmed."""
    trim = "[" + "".join(f"\\{c}" for c in TRIM) + "]*+"
    quoted = F.transform(terms, lambda t: F.regexp_replace(t, r"([!-/:-@\[-`{-~\x00-\x1F])", r"\\$1"))
    pattern = F.concat(F.lit(rf"(?i)(?:^|(?<={WHITE})){trim}(?:"), F.array_join(quoted, "|"), F.lit(rf")(?={trim}(?:{WHITE}|\z))"))
    gaps, found = F.split(rest, pattern, -1), F.regexp_extract_all(rest, pattern, F.lit(0))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), F.length(F.ltrim(m, F.lit(TRIM))).alias("own")))
    start = F.struct(F.lit(0).alias("at"), no_spans().alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + x["gap"] + x["size"]
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct((end - x["own"]).alias("start"), end.alias("end")))).alias("spans"))

    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def terms_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame | None:
    """(_id, _hash, _found): disclosing terms by document, None if there are none."""
    found = disclosing(docs, text)
    if found is None or found.isEmpty():
        return None
    words = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"), F.explode(_terms(F.col(text))).alias("term"))
    return stored(words.join(_small(found), "term").groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("term")).alias("_found")))


def all_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with _text, _email, _ip, _card, _phone and _term."""
    found, spanned = terms_of(docs, text, doc_id), with_spans(docs, text)
    if found is None:
        return spanned.withColumn("_term", no_spans())
    hashed = spanned.withColumn("_key", F.xxhash64("_text"))
    joined = hashed.join(_small(found), hashed[doc_id].eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash")), "left")
    places = F.when(F.col("_found").isNotNull(), _places(_rest(), F.col("_found"))).otherwise(no_spans())
    return joined.withColumn("_term", places).drop("_id", "_hash", "_key", "_found")


def _listed(kinds: tuple[str, ...]) -> Column:
    parts = [_named(k, lambda k, s: F.concat(F.lit(f"{k}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, counts of each kind, digest of the base spans and all spans."""
    return all_spans(docs.select("doc_id", "text")).select(
        "doc_id",
        *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(KINDS), 256).alias("base_sha256"),
        _listed((*KINDS, "term")).alias("spans"),
    )


def sanitised(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with every span replaced by the name of its kind in brackets; texts without spans stay as they are."""
    parts = [_named(k, lambda k, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{k.upper()}]").alias("mark"))) for k in (*KINDS, "term")]
    spans = F.sort_array(F.concat(*parts))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.array(F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), s["mark"])
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(F.col("_words"))
    found = all_spans(apart(docs, text, doc_id), "_words", "_own")
    return whole(found, docs.columns, text, clean)
