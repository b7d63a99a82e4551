"""Lookup, tiered search, full text and suggestions over an entry table.

``entries`` has id, word_hindi, word_hinglish_roman, definition, source,
part_of_speech, confidence_score, severity_score, toxicity_flags and a unique
ord (rec_id). Filters come before limits unless ``edge_parity`` is asked for.
Every order ends in the ord, so results do not depend on partitioning, and
every top-k is a TakeOrderedAndProject.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import contains_literal

LOOKUP_CAP, SEARCH_CAP, SUGGEST_CAP = 50, 100, 20
K1, B = 1.2, 0.75
#: A token of the inverted index keeps its combining marks.
TOKEN = "[\\p{L}\\p{M}\\p{N}]+"


def check_limit(limit: int) -> None:
    """Limits are 1 to SEARCH_CAP; others are refused."""
    if not 1 <= limit <= SEARCH_CAP:
        raise ValueError(f"limit must be within 1 and {SEARCH_CAP}")


def low(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def is_safe() -> Column:
    """Severity below 0.5; missing severity is safe."""
    return F.coalesce(F.nanvl(F.col("severity_score"), F.lit(0.0)), F.lit(0.0)) < 0.5


def _filtered(entries: DataFrame, safe: bool, min_confidence: float, pos: str | None = None) -> DataFrame:
    if safe:
        entries = entries.where(is_safe())
    if min_confidence > 0:
        entries = entries.where(F.col("confidence_score") >= min_confidence)
    return entries.where(F.col("part_of_speech") == pos) if pos else entries


def _confidence() -> Column:
    return F.coalesce(F.nanvl(F.col("confidence_score"), F.lit(0.0)), F.lit(0.0))


def tier_search(entries: DataFrame, q: str, limit: int = 20, safe: bool = False, min_confidence: float = 0.0, pos: str | None = None, ord_col: str = "rec_id") -> DataFrame:
    """Entries with ``tier`` (100 headword, 95 roman, 80/75/50 substring of headword, roman, definition), best first.

    Order: tier, confidence, ord. An empty query finds nothing.
    """
    q = q.strip().lower()
    tier = (
        F.when(low("word_hindi") == q, 100)
        .when(low("word_hinglish_roman") == q, 95)
        .when(contains_literal(F.col("word_hindi"), q), 80)
        .when(contains_literal(F.col("word_hinglish_roman"), q), 75)
        .when(contains_literal(F.col("definition"), q), 50)
    )
    hits = _filtered(entries, safe, min_confidence, pos).withColumn("tier", tier).where(F.col("tier").isNotNull() if q else F.lit(False))
    return hits.orderBy(F.desc("tier"), _confidence().desc(), ord_col).limit(min(limit, SEARCH_CAP))


def lookup(entries: DataFrame, word: str, limit: int = 10, safe: bool = False, min_confidence: float = 0.0, ord_col: str = "rec_id") -> DataFrame:
    """Exact matches of headword or roman; only where there are none, substring matches. One plan.

    The best tier is the one of the first row in order, so the fallback needs
    no second pass: the rows of the best tier are the head of the ordered list.
    """
    q = word.strip().lower()
    exact = (low("word_hindi") == q) | (low("word_hinglish_roman") == q)
    partial = contains_literal(F.col("word_hindi"), q) | contains_literal(F.col("word_hinglish_roman"), q) | contains_literal(F.col("definition"), q)
    hits = _filtered(entries, safe, min_confidence).withColumn("tier", F.when(exact, 1).when(partial, 2)).where(F.col("tier").isNotNull() if q else F.lit(False))
    top = hits.orderBy("tier", _confidence().desc(), ord_col).limit(min(limit, LOOKUP_CAP))
    best = top.agg(F.min("tier").alias("_best"))  # one row of at most LOOKUP_CAP
    return top.join(F.broadcast(best), top["tier"] == best["_best"]).drop("_best")


def best_match(entries: DataFrame, slug: str, ord_col: str = "rec_id") -> DataFrame:
    """At most one entry, with ``exact``: the first exact match, else the first that contains the slug."""
    q = slug.strip()
    exact = (F.col("word_hindi") == q) | (F.col("word_hinglish_roman") == q.lower())
    partial = F.col("word_hindi").contains(q) | contains_literal(F.col("word_hinglish_roman"), q)
    hits = entries.withColumn("exact", exact).where((exact | partial) if q else F.lit(False)).withColumn("exact", F.coalesce("exact", F.lit(False)))
    return hits.orderBy(F.desc("exact"), ord_col).limit(1)


def edge_lookup(entries: DataFrame, word: str, limit: int = 10, ord_col: str = "rec_id") -> DataFrame:
    """Entries whose headword is the word as it is written, or whose roman is its lower case; where there are none, those
    that contain it (% and _ are wildcards, case does not matter). In their own order, 50 at most."""
    q = word.strip()
    exact = (F.col("word_hindi") == q) | (F.col("word_hinglish_roman") == q.lower())
    partial = F.col("word_hindi").ilike(f"%{q}%") | F.col("word_hinglish_roman").ilike(f"%{q}%")
    hits = entries.withColumn("tier", F.when(exact, 1).when(partial, 2)).where(F.col("tier").isNotNull() if q else F.lit(False))
    top = hits.orderBy("tier", ord_col).limit(min(limit, LOOKUP_CAP))
    best = top.agg(F.min("tier").alias("_best"))  # one row of at most LOOKUP_CAP
    return top.join(F.broadcast(best), top["tier"] == best["_best"]).drop("_best")


def edge_facets(page: DataFrame, pos: str | None = None) -> DataFrame:
    """As ``facets``, after a page's limit: parts of speech in lower case with empty ones as "other", sources of the rows of ``pos`` alone."""
    kind = F.coalesce(F.nullif(F.lower(F.trim("part_of_speech")), F.lit("")), F.lit("other"))
    rows = page if pos is None else page.where(kind == pos.lower())
    by_pos = page.groupBy(kind.alias("value")).agg(F.count("*").alias("n")).select(F.lit("pos").alias("facet"), "value", "n")
    return by_pos.unionByName(rows.groupBy(F.col("source").alias("value")).agg(F.count("*").alias("n")).select(F.lit("source").alias("facet"), "value", "n"))


def suggest(entries: DataFrame, q: str, limit: int = 8, ord_col: str = "rec_id") -> DataFrame:
    """(roman, hindi, tier): spellings that begin with q; exact first, then shorter, then by roman."""
    q = q.strip().lower()
    hit = low("word_hinglish_roman").startswith(q) | low("word_hindi").startswith(q)
    hits = entries.where((hit & (low("word_hinglish_roman") != "")) if q else F.lit(False))
    # min of a struct with the ord: the first row's headword, with partial sums
    one = hits.groupBy(F.col("word_hinglish_roman").alias("roman")).agg(F.min(F.struct(F.col(ord_col).alias("o"), F.coalesce("word_hindi", F.lit("")).alias("h"))).alias("m")).select("roman", F.col("m.h").alias("hindi"))
    tier = F.when(F.lower("roman") == q, 0).when(F.lower("hindi") == q, 1).when(F.lower("roman").startswith(q), 2).otherwise(3)
    return one.withColumn("tier", tier).orderBy("tier", F.length("roman"), "roman").limit(min(limit, SUGGEST_CAP))


def facets(page: DataFrame) -> DataFrame:
    """(facet, value, n) of a page of results: parts of speech (empty ones left out) and sources."""
    pos = page.where(F.coalesce(F.col("part_of_speech"), F.lit("")) != "").groupBy(F.col("part_of_speech").alias("value")).agg(F.count("*").alias("n")).select(F.lit("pos").alias("facet"), "value", "n")
    return pos.unionByName(page.groupBy(F.col("source").alias("value")).agg(F.count("*").alias("n")).select(F.lit("source").alias("facet"), "value", "n"))


def hash_index(entries: DataFrame, ord_col: str = "rec_id") -> DataFrame:
    """(key, id, ord): the last entry of each lower-case headword or roman."""
    keys = F.explode(F.array_distinct(F.array(low("word_hindi"), low("word_hinglish_roman"))))
    return entries.select("id", F.col(ord_col).cast("long").alias("ord"), keys.alias("key")).where("key <> ''").groupBy("key").agg(F.max(F.struct("ord", "id")).alias("m")).select("key", F.col("m.id").alias("id"), F.col("m.ord").alias("ord"))


# --- full text ------------------------------------------------------------------
def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))


def inverted_index(entries: DataFrame, columns: list[str], ord_col: str = "rec_id") -> DataFrame:
    """(token, ord, tf, dl): postings with the document's length. Write it partitioned or bucketed by token to serve from it."""
    text = F.concat_ws(" ", *[F.col(c) for c in columns])
    docs = entries.select(F.col(ord_col).cast("long").alias("ord"), tokens(text).alias("t"))
    return docs.select("ord", F.size("t").cast("long").alias("dl"), F.explode("t").alias("token")).groupBy("token", "ord", "dl").agg(F.count("*").alias("tf"))


def full_text(entries: DataFrame, q: str, columns: list[str], limit: int = 20, safe: bool = False, min_confidence: float = 0.0, prefix: bool = False, edge_parity: bool = False, ord_col: str = "rec_id") -> DataFrame:
    """Entries that hold every token of q (as prefixes if ``prefix``), with ``bm25``, best first.

    BM25 with k1 1.2 and b 0.75 over the columns together; idf is
    ln((N - n + 0.5) / (n + 0.5)), 1e-6 at least. Order: score, confidence, ord.
    ``edge_parity``: the safe filter after the limit. The statistics are one
    aggregation over token counts per document, the match is a filter on arrays
    in the same pass: no index is needed for a one-off query.
    """
    wanted = list(dict.fromkeys(re.findall(r"[^\W_](?:[^\W_]|[ऀ-ःऺ-ॏ])*", q.lower())))
    docs = entries.withColumn("_t", tokens(F.concat_ws(" ", *[F.col(c) for c in columns]))).withColumn("_dl", F.size("_t"))

    def tf(w: str) -> Column:
        return F.size(F.filter("_t", lambda t: t.startswith(w) if prefix else t == w))

    if not wanted:
        return docs.where(F.lit(False)).withColumn("bm25", F.lit(0.0)).drop("_t", "_dl")
    docs = docs.withColumns({f"_tf{i}": tf(w) for i, w in enumerate(wanted)})
    stats = docs.agg(F.count("*").alias("_n"), F.avg("_dl").alias("_avg"), *[F.sum((F.col(f"_tf{i}") > 0).cast("long")).alias(f"_df{i}") for i in range(len(wanted))])
    hits = docs
    for i in range(len(wanted)):
        hits = hits.where(F.col(f"_tf{i}") > 0)
    if not edge_parity:
        hits = _filtered(hits, safe, min_confidence)
    hits = hits.join(F.broadcast(stats))  # one row of sums
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.greatest(F.log((F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5)), F.lit(1e-6))
        f = F.col(f"_tf{i}")
        score = score + idf * (f * (K1 + 1)) / (f + K1 * (1 - B + B * F.col("_dl") / F.col("_avg")))
    out = hits.withColumn("bm25", F.round(score, 6)).orderBy(F.desc("bm25"), _confidence().desc(), ord_col).limit(min(limit, SEARCH_CAP))
    if edge_parity:
        out = _filtered(out, safe, min_confidence)
    return out.select(*entries.columns, "bm25")
