"""Ordered deduplication by romanized headword, without collecting a group.

The reference semantics is a fold: rows are taken in order, a row becomes the
group's leader if its score exceeds the leader's, and the leader's score rises
by 50 once an example has been seen in the group. A row can only ever win if no
earlier one had its score before the bonus, whether it has an example or not;
the first row of each (score, example, part of speech) is therefore enough.
Scores are bounded by text lengths, so the list a group folds is short however
many rows it has, and finding it is an aggregation with partial results. What
the leader takes from the others is picked by their places in the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.score import quality
from lexmill.functions.text import definition_hash, definition_lang, has_devanagari, normalize_hindi

EXAMPLE_BONUS = 50


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _leaders(base: DataFrame) -> DataFrame:
    """(roman, n_rows, leaders, ex_ord, pos_ord): leaders' ords from the last to the first; the rows that give example and part of speech."""
    rows = base.select("roman", "ord", _filled("example_sentence").alias("ex"), _filled("part_of_speech").alias("pos"), quality(F.col("definition"), F.col("source"), F.lit("")).alias("u"))
    firsts = rows.groupBy("roman", "u", "ex", "pos").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
    lists = firsts.groupBy("roman").agg(F.sum("n").alias("n_rows"), F.array_sort(F.collect_list(F.struct("ord", "u", "ex", "pos"))).alias("cs"))
    none = F.lit(None).cast("long")
    start = F.struct(none.alias("u"), F.array().cast("array<bigint>").alias("leaders"), none.alias("ex"), none.alias("pos"))

    def step(acc: Column, x: Column) -> Column:
        bar = acc["u"] + F.when(acc["ex"].isNotNull(), EXAMPLE_BONUS).otherwise(0)
        wins = acc["u"].isNull() | (x["u"] + F.when(x["ex"], EXAMPLE_BONUS).otherwise(0) > bar)
        return F.struct(
            F.when(wins, x["u"]).otherwise(acc["u"]).alias("u"),
            F.when(wins, F.concat(F.array(x["ord"]), acc["leaders"])).otherwise(acc["leaders"]).alias("leaders"),
            F.when(x["ex"] & (wins | acc["ex"].isNull()), x["ord"]).otherwise(acc["ex"]).alias("ex"),
            F.when(x["pos"] & (wins | acc["pos"].isNull()), x["ord"]).otherwise(acc["pos"]).alias("pos"),
        )

    led = lists.select("roman", "n_rows", F.aggregate("cs", start, step).alias("f"))
    return led.select("roman", "n_rows", "f.leaders", F.col("f.ex").alias("ex_ord"), F.col("f.pos").alias("pos_ord"))


def _place(leaders: Column, at: Column, pos: Column) -> Column:
    """Order in which the leader's lists take items: the last leader's, those of the leaders before it, then by row."""
    own = F.array_position(leaders, at)
    return F.struct(F.when(own > 0, 0).otherwise(1).alias("late"), F.when(own > 0, own).otherwise(at).alias("at"), pos.alias("pos"))


def dedup_by_roman(entries: DataFrame, ord_col: str = "rec_id", key: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """One row per key: roman, leader (its ord), n_rows, source, sources, word_hindi, definition, definition_lang,
    definition_hi, definition_en, example_sentence, part_of_speech, and the leader's ``carry`` columns.

    ``entries`` needs word_hindi, word_hinglish_roman, definition,
    part_of_speech, example_sentence, source, sources and a unique ord. Rows with
    a null or empty key are left out. sources are the leader's, then the others'
    in the order of the fold; source is the first. Null texts count as empty;
    ties keep the earlier row.
    """
    key, carry = F.col("word_hinglish_roman") if key is None else key, carry or []
    base = entries.select(
        key.alias("roman"), F.col(ord_col).cast("long").alias("ord"), "word_hindi", F.coalesce("definition", F.lit("")).alias("definition"), "part_of_speech", "example_sentence", "source", "sources",
        F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("_")]).alias("carried"),
    ).where(F.coalesce(F.col("roman"), F.lit("")) != "")
    led = _leaders(base)
    at, first = F.col("ord"), F.element_at("leaders", 1)
    dev, lat = has_devanagari(F.col("definition")), F.col("definition").rlike("[A-Za-z]")
    later = at > first
    picked = base.join(led, "roman").groupBy("roman", "n_rows").agg(
        F.max(F.when(at == first, at)).alias("leader"),
        F.max(F.when(at == first, F.col("definition"))).alias("definition"),
        F.max(F.when(at == first, F.coalesce("word_hindi", F.lit("")))).alias("word_hindi"),
        F.max_by("carried", F.when(at == first, at)).alias("carried"),
        F.max(F.when(at == F.col("ex_ord"), F.col("example_sentence"))).alias("example_sentence"),
        F.max(F.when(at == F.col("pos_ord"), F.col("part_of_speech"))).alias("part_of_speech"),
        F.max(F.when(at == F.try_element_at("leaders", F.lit(2)), F.col("definition"))).alias("before_def"),
        F.min(F.when(later, F.struct("ord", "definition"))).alias("next_row"),
        F.min(F.when(later & dev, F.struct("ord", "definition"))).alias("next_dev"),
        F.min(F.when(later & lat, F.struct("ord", "definition"))).alias("next_lat"),
    )
    second = F.coalesce("before_def", F.col("next_row.definition"))  # the first row merged into the leader
    merged = F.col("n_rows") > 1
    d, hi_word = F.col("definition"), has_devanagari(F.col("word_hindi"))
    lang = definition_lang(d)
    hi = F.when(merged, F.when(has_devanagari(d), d).when(has_devanagari(second), second).when(hi_word, F.col("word_hindi")).otherwise(F.col("next_dev.definition")))
    en = F.when(merged, F.when(d.rlike("[A-Za-z]"), d).when(second.rlike("[A-Za-z]"), second).otherwise(F.col("next_lat.definition")))
    out = picked.withColumns({"definition_lang": lang, "definition_hi": F.coalesce(hi, F.when(lang.isin("hi", "mixed"), d)), "definition_en": F.coalesce(en, F.when(lang.isin("en", "mixed"), d))})
    # the distinct sources of a key are few
    named = F.when(F.col("sources").isNull(), F.array("source")).otherwise(F.col("sources"))
    items = base.select("roman", "ord", F.posexplode(named).alias("pos", "item")).join(led.select("roman", "leaders"), "roman").groupBy("roman", "item").agg(F.min(_place(F.col("leaders"), at, F.col("pos"))).alias("place"))
    sources = items.groupBy("roman").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "item"))), lambda x: x["item"]).alias("sources"))
    out = out.join(sources, "roman", "left")
    return out.select(
        "roman", "leader", "n_rows", F.try_element_at("sources", F.lit(1)).alias("source"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), "word_hindi", "definition", "definition_lang", "definition_hi", "definition_en",
        F.coalesce("example_sentence", F.lit("")).alias("example_sentence"), F.coalesce("part_of_speech", F.lit("")).alias("part_of_speech"), *[F.col(f"carried.{c}").alias(c) for c in carry],
    )


def merged_lists(entries: DataFrame, columns: list[str], ord_col: str = "rec_id", key: Column | None = None) -> DataFrame:
    """(roman, field, item, late, at, pos): the distinct items of array columns per key.

    The leader's list takes them in order of late, at and pos. Null and blank
    items are left out. Rows instead of arrays, as a key may hold any number of
    items.
    """
    key = F.col("word_hinglish_roman") if key is None else key
    base = entries.withColumns({"roman": key, "ord": F.col(ord_col).cast("long"), "definition": F.coalesce("definition", F.lit(""))}).where(F.coalesce(F.col("roman"), F.lit("")) != "")
    led = _leaders(base).select("roman", "leaders")
    items = base.select("roman", "ord", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("array<string>").alias("v")) for c in columns])).alias("x")).select("roman", "ord", "x.field", F.posexplode("x.v").alias("pos", "item")).where(F.coalesce("item", F.lit("")) != "")
    once = items.join(led, "roman").groupBy("roman", "field", "item").agg(F.min(_place(F.col("leaders"), F.col("ord"), F.col("pos"))).alias("p"))
    return once.select("roman", "field", "item", F.col("p.late").cast("long").alias("late"), F.col("p.at").cast("long").alias("at"), F.col("p.pos").cast("long").alias("pos"))


def dedup_by_definition(entries: DataFrame, ord_col: str = "rec_id") -> DataFrame:
    """One row per normalised headword and definition: hindi, def_hash, leader (first ord), n_rows,
    sources (joined with + in order of first appearance), example_sentence (first filled), confidence (greatest)."""
    base = entries.select(normalize_hindi(F.coalesce("word_hindi", F.lit(""))).alias("hindi"), definition_hash(F.coalesce("definition", F.lit(""))).alias("def_hash"), F.col(ord_col).cast("long").alias("ord"), "source", "example_sentence", "confidence_score")
    by_source = base.groupBy("hindi", "def_hash", "source").agg(F.min("ord").alias("o"), F.count("*").alias("n"), F.max("confidence_score").alias("c"), F.min(F.when(_filled("example_sentence"), F.struct("ord", "example_sentence"))).alias("e"))
    g = by_source.groupBy("hindi", "def_hash").agg(F.min("o").alias("leader"), F.sum("n").alias("n_rows"), F.max("c").alias("confidence"), F.min("e").alias("e"), F.array_sort(F.collect_list(F.struct("o", "source"))).alias("ss"))
    joined = F.aggregate("ss", F.lit(""), lambda acc, x: F.when(acc == "", x["source"]).when(F.contains(acc, x["source"]), acc).otherwise(F.concat(acc, F.lit("+"), x["source"])))
    return g.select("hindi", "def_hash", "leader", "n_rows", joined.alias("sources"), F.coalesce(F.col("e.example_sentence"), F.lit("")).alias("example_sentence"), "confidence")
