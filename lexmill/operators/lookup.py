"""Romanization of headwords by lookup, then by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import has_devanagari, iso_to_common
from lexmill.functions.translit import romanize


def romanize_headwords(entries: DataFrame, overrides: DataFrame, word: str = "word_hindi", roman: str = "word_hinglish_roman") -> DataFrame:
    """``entries`` with ``roman`` filled and ``_romanization_method`` set.

    An override (word_hindi, roman) comes first (common_word); a word written
    twice there takes its least spelling that isn't blank. Then a Devanagari
    headword by rule (rule), then an existing roman in scholarly spelling (iso)
    or in Devanagari (rule). Null headwords keep their roman. The join's side is
    broadcast by AQE if its measured size allows.
    """
    table = overrides.where(F.trim("roman") != "").groupBy(F.col("word_hindi").alias("_w")).agg(F.min("roman").alias("_r"))
    joined = entries.join(table, F.col(word) == F.col("_w"), "left")
    dev_word, dev_roman = has_devanagari(F.col(word)), has_devanagari(F.col(roman))
    has_roman = F.coalesce(F.trim(roman) != "", F.lit(False))
    value = F.when(F.col("_r").isNotNull(), F.col("_r")).when(dev_word, romanize(F.col(word))).when(has_roman & ~dev_roman, iso_to_common(F.col(roman))).when(has_roman, romanize(F.col(roman))).otherwise(F.coalesce(F.col(roman), F.lit("")))
    method = F.when(F.col("_r").isNotNull(), "common_word").when(dev_word, "rule").when(has_roman & ~dev_roman, "iso").otherwise("rule")
    return joined.withColumns({roman: value, "_romanization_method": method}).drop("_w", "_r")


def romanize_texts(entries: DataFrame) -> DataFrame:
    """definition_hinglish of every definition, example_hinglish of Devanagari examples."""
    d, e = F.col("definition"), F.col("example_sentence")
    return entries.withColumns({
        "definition_hinglish": F.when(has_devanagari(d), romanize(d)).when(F.coalesce(d, F.lit("")) != "", iso_to_common(d)),
        "example_hinglish": F.when(has_devanagari(e), romanize(e)),
    })
