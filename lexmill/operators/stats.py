"""Counts, audits and reports over an entry table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import definition_lang, diff_class, has_devanagari, normalize_safety
from lexmill.operators.search import is_safe


def n_sources() -> Column:
    return F.size(F.array_distinct(F.coalesce("sources", F.array("source"))))


def severity() -> Column:
    return F.coalesce(F.nanvl(F.col("severity_score"), F.lit(0.0)), F.lit(0.0))


def score_bucket(c: Column, per: int = 100) -> Column:
    """The bucket's lower end times ``per``; null scores have none. Rounding at 1e-9 keeps 0.29 in bucket 29."""
    return F.floor(c * per + 1e-9).cast("long")


def meta(entries: DataFrame) -> DataFrame:
    """(metric, value, n): entries by source, part of speech, language and score bucket, and by more than one source."""
    x = entries.select("source", F.coalesce("part_of_speech", F.lit("")).alias("pos"), definition_lang(F.coalesce("definition", F.lit(""))).alias("lang"), F.when(F.col("confidence_score").between(0, 1), score_bucket(F.col("confidence_score")).cast("string")).otherwise("none").alias("bucket"), (n_sources() > 1).cast("string").alias("multi"))
    long = x.select(F.explode(F.map_from_arrays(F.lit(["source", "pos", "lang", "confidence", "multi_source"]), F.array("source", "pos", "lang", "bucket", "multi"))).alias("metric", "value"))
    return long.groupBy("metric", "value").agg(F.count("*").alias("n"))


def stats(entries: DataFrame, related: DataFrame) -> DataFrame:
    """(metric, n): totals of entries, safe and toxic ones, and relations."""
    one = entries.agg(F.count("*").alias("total"), F.count_if(is_safe()).alias("safe"), F.count_if(~is_safe()).alias("toxic"))
    long = one.select(F.explode(F.map_from_arrays(F.lit(["total", "safe", "toxic"]), F.array("total", "safe", "toxic"))).alias("metric", "n"))
    return long.unionByName(related.agg(F.count("*").alias("n")).select(F.lit("relations").alias("metric"), "n"))


def top_pos(entries: DataFrame, k: int = 15) -> DataFrame:
    """The k most frequent parts of speech that aren't empty; ties by name."""
    return entries.where(F.coalesce(F.col("part_of_speech"), F.lit("")) != "").groupBy(F.col("part_of_speech").alias("pos")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pos").limit(k)


def merge_audit(deduped: DataFrame, thin: int = 20) -> DataFrame:
    """One row on the deduplicated lexicon: how many are merged, and how complete the merged ones are."""
    d = deduped.withColumn("merged", F.size("sources") > 1)
    m, hi, en = F.col("merged"), F.coalesce("definition_hi", F.lit("")) != "", F.coalesce("definition_en", F.lit("")) != ""
    count = lambda c: F.count_if(m & c)
    return d.agg(
        F.count("*").alias("total"), F.count_if(m).alias("merged"), count(hi).alias("with_hi"), count(en).alias("with_en"), count(hi & en).alias("with_both"),
        count(hi & en & (F.col("definition_hi") == F.col("definition_en"))).alias("identical"),
        count(F.length("definition") < thin).alias("thin"), F.least(count(F.length("definition") < thin), F.lit(30)).cast("long").alias("thin_capped"),
    )


def source_sets(deduped: DataFrame) -> DataFrame:
    """(sources, n): how often each set of two or more sources stands behind a merged entry."""
    return deduped.where(F.size("sources") > 1).groupBy(F.array_join(F.array_sort(F.array_distinct("sources")), ", ").alias("sources")).agg(F.count("*").alias("n"))


def confidence_audit(entries: DataFrame) -> DataFrame:
    """Per score bucket (hundredths): n, its share of all scored entries, average definition length, shares with example, toxicity, Devanagari and both definitions."""
    d = F.coalesce("definition", F.lit(""))
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    both = (F.coalesce("definition_hi", F.lit("")) != "") & (F.coalesce("definition_en", F.lit("")) != "")
    buckets = entries.where(F.col("confidence_score").between(0, 1)).groupBy(score_bucket(F.col("confidence_score")).alias("bucket")).agg(
        F.count("*").alias("n"), share(severity() >= 0.5).alias("with_toxicity"), F.round(F.avg(F.length(d)), 6).alias("avg_definition"), share(F.coalesce("example_sentence", F.lit("")) != "").alias("with_example"),
        share(has_devanagari(d)).alias("with_devanagari"), share(both).alias("complete"),
    )
    total = F.sum("n").over(Window.partitionBy())  # over 101 buckets at most
    return buckets.withColumn("share", F.round(F.col("n") / total, 6))


def bucket_sources(entries: DataFrame, k: int = 5) -> DataFrame:
    """(bucket, source, n, rank): the k most frequent sources of each score bucket; ties by name."""
    g = entries.where(F.col("confidence_score").between(0, 1)).groupBy(score_bucket(F.col("confidence_score")).alias("bucket"), "source").agg(F.count("*").alias("n"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("n"), "source")).cast("long")).where(F.col("rank") <= k)


def severity_histogram(entries: DataFrame) -> DataFrame:
    """(tenth, n) of the severity scores."""
    return entries.groupBy(score_bucket(severity(), 10).alias("tenth")).agg(F.count("*").alias("n"))


def false_negatives(entries: DataFrame, terms: DataFrame) -> DataFrame:
    """(rec_id, term): safe entries whose definition or example holds a listed term that isn't the headword; the least such term."""
    listed = terms.select(F.trim(normalize_safety(F.col("term"))).alias("term")).where("term <> ''").distinct()
    text = normalize_safety(F.concat_ws(" ", "definition", "example_sentence"))
    words = entries.where(is_safe()).select("rec_id", F.trim(normalize_safety(F.coalesce("word_hinglish_roman", F.lit("")))).alias("head"), F.explode(F.array_distinct(F.split(F.trim(text), "\\s+"))).alias("term"))
    return words.join(listed, "term").where("term <> head").groupBy("rec_id").agg(F.min("term").alias("term"))


def suggested_terms(entries: DataFrame, terms: DataFrame, least: int = 5) -> DataFrame:
    """(term, n): romans of entries flagged as profane, named at least ``least`` times and not listed."""
    listed = terms.select(F.trim(normalize_safety(F.col("term"))).alias("term")).distinct()
    flagged = entries.where("profanity").select(F.trim(normalize_safety(F.coalesce("word_hinglish_roman", F.lit("")))).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return flagged.join(listed, "term", "left_anti")


def romanization_audit(entries: DataFrame, expected: DataFrame) -> DataFrame:
    """(kind, n): entries' romans against the expected ones (word_hindi, roman; a word written twice takes its least)."""
    want = expected.where(F.trim("roman") != "").groupBy("word_hindi").agg(F.min("roman").alias("expected"))
    got = entries.select("word_hindi", F.lower(F.trim(F.coalesce("word_hinglish_roman", F.lit("")))).alias("actual"))
    return got.join(want, "word_hindi").groupBy(diff_class(F.col("actual"), F.col("expected")).alias("kind")).agg(F.count("*").alias("n"))


def romanization_summary(entries: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: entries, those with an expected roman (covered), of these passed and failed, and both shares."""
    want = expected.where(F.trim("roman") != "").groupBy(F.col("word_hindi").alias("_w")).agg(F.min("roman").alias("_e"))
    got = entries.select("word_hindi", F.lower(F.trim(F.coalesce("word_hinglish_roman", F.lit("")))).alias("actual")).join(want, F.col("word_hindi") == F.col("_w"), "left")
    share = lambda a, b: F.round(F.col(a) / F.col(b), 6)
    totals = got.agg(F.count("*").alias("entries"), F.count("_e").alias("covered"), F.count_if(F.col("actual") == F.col("_e")).alias("passed"))
    return totals.withColumns({"failed": F.col("covered") - F.col("passed"), "coverage": share("covered", "entries"), "pass_rate": F.when(F.col("covered") > 0, share("passed", "covered"))})


def roman_health(entries: DataFrame) -> DataFrame:
    """One row: entries without a roman, with accents in it, with Devanagari in it."""
    r = F.coalesce("word_hinglish_roman", F.lit(""))
    return entries.agg(F.count_if(F.trim(r) == "").alias("missing"), F.count_if(r.rlike("[À-ɏ̀-ͯ]")).alias("accented"), F.count_if(has_devanagari(r)).alias("devanagari"))


def word_accuracy(pairs: DataFrame) -> DataFrame:
    """One row: of (actual, expected) texts, the words that agree by position, of all expected words."""
    a, e = F.split("actual", " "), F.split("expected", " ")
    same = F.size(F.filter(F.zip_with(a, e, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda ok: ok))
    return pairs.agg(F.sum(same).cast("long").alias("right"), F.sum(F.size(e)).cast("long").alias("words")).withColumn("accuracy", F.round(F.col("right") / F.col("words"), 6))


def histogram_bars(counts: DataFrame, width: int = 40) -> DataFrame:
    """(value, n, bar): a bar of at least one mark, in proportion to the share of all."""
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(total)).select("value", "n", F.repeat(F.lit("█"), F.greatest(F.lit(1), F.floor(F.col("n") * width / F.col("_t")).cast("int"))).alias("bar"))


def release_notes(meta_rows: DataFrame, title: str, k: int = 5) -> DataFrame:
    """(place, line): Markdown from ``meta`` rows: totals by source (all of them, most frequent first), the k most frequent parts of speech."""
    item = F.format_string("- %s: %s", "value", F.format_number("n", 0))
    counts = meta_rows.where(F.col("metric").isin("source", "pos") & (F.col("value") != "")).groupBy("metric", "value").agg(F.sum("n").alias("n"))
    top = counts.where("metric = 'pos'").orderBy(F.desc("n"), "value").limit(k)
    lines = counts.where("metric = 'source'").select(F.lit(1).alias("part"), "n", "value", item.alias("line")).unionByName(top.select(F.lit(3).alias("part"), "n", "value", item.alias("line")))
    heads = meta_rows.sparkSession.createDataFrame([(0, f"# {title}\n\n## Sources\n"), (2, "\n## Parts of speech\n")], "part int, line string").select("part", F.lit(0).cast("long").alias("n"), F.lit("").alias("value"), "line")
    return heads.unionByName(lines).select(F.struct("part", (-F.col("n")).alias("n"), "value").alias("place"), "line")
