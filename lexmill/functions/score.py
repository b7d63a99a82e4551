"""Scores of entries, as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import definition_lang


def quality(definition: Column, source: Column, example: Column, lang: Column | None = None) -> Column:
    """Leader score in deduplication: language, length, source, example; empty definitions lose 500."""
    text = F.coalesce(definition, F.lit(""))
    lang = definition_lang(text) if lang is None else lang
    return (
        F.when(lang == "en", 200).when(lang == "mixed", 100).otherwise(0)
        + F.length(text)
        + F.when(source == "WordNet", 100).otherwise(0)
        + F.when(F.coalesce(example, F.lit("")) != "", 50).otherwise(0)
        - F.when(text == "", 500).otherwise(0)
    ).cast("long")


def confidence(source: Column, method: Column, n_sources: Column, has_hi: Column, has_en: Column, has_example: Column, severity: Column) -> Column:
    """Source x romanization x agreement x completeness, 0.3 at most if severe, within 0 and 1 (not rounded)."""
    base = F.when(source == "WordNet", 0.95).when(source == "Wiktionary", 0.85).otherwise(0.70)
    by_method = F.when(method == "common_word", 1.0).when(method == "iso", 0.92).otherwise(0.75)
    agreement = F.lit(1.0) + F.lit(0.03) * (F.greatest(n_sources, F.lit(1)) - 1)
    complete = F.when(has_hi & has_en, 1.05).when(has_en, 1.03).when(has_hi & has_example, 1.02).otherwise(1.0)
    score = base * by_method * agreement * complete
    score = F.when(F.coalesce(severity, F.lit(0.0)) >= 0.5, F.least(score, F.lit(0.3))).otherwise(score)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def frequency(confidence: Column) -> Column:
    """Keyboard frequency 1..255 of a confidence."""
    return F.when(confidence >= 1.0, 255).when(confidence <= 0.30, 1).otherwise((F.lit(1) + (confidence - 0.3) / 0.7 * 254).cast("int")).cast("long")


def heuristic_toxicity(text: Column, indicators: tuple[str, ...]) -> Column:
    """0.3 for each indicator contained, 1.0 at most."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = sum((F.contains(low, F.lit(i)).cast("int") for i in indicators), F.lit(0))
    return F.least(hits * 0.3, F.lit(1.0))
