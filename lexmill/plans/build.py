"""The batch build: raw sources to a finished lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.score import confidence
from lexmill.operators.dedup import dedup_by_roman
from lexmill.operators.lookup import romanize_headwords, romanize_texts
from lexmill.operators.merge import merge_dictionaries
from lexmill.operators.safety import flag_entries
from lexmill.sinks.writers import number_rows
from lexmill.sources.dictionaries import dictionary_entries, parse_dictionary_lines, synset_entries

#: What a lexicon's row keeps of the leader of its group.
CARRIED = ["id", "definition_hinglish", "example_hinglish", "head_word", "tags", "synonyms", "antonyms", "_romanization_method"]


def gather(synsets: DataFrame, words: DataFrame, supplemental: DataFrame | None = None) -> DataFrame:
    """Synset rows, dictionary rows and supplemental rows as one merged table (E1), ``k`` being its order.

    The order is that of synsets by id and word, then of the others by source,
    line and sense; it is a struct, so no number can run into another's.
    """
    key = lambda s, a, b: F.struct(F.lit(s).alias("s"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    first = synset_entries(synsets).withColumn("k", key(0, F.col("synset_id"), F.col("pos_in_synset"))).drop("synset_id", "pos_in_synset")
    second = dictionary_entries(words).withColumn("k", key(1, F.col("line_no"), F.col("sense"))).drop("line_no", "sense")
    if supplemental is not None:
        second = second.unionByName(supplemental.withColumn("k", key(2, F.col("place"), F.lit(0))).drop("place"), allowMissingColumns=True)
    return merge_dictionaries(first, second, "k").drop("origin", "n_merged")


def number_and_romanize(merged: DataFrame, overrides: DataFrame, prefix: str = "HIN-") -> DataFrame:
    """The merged table with romanized headwords and texts, ``ord`` and id, written once: what follows reads it several times."""
    romanized = romanize_texts(romanize_headwords(merged, overrides))
    numbered = number_rows(romanized, [F.col("k")], "ord")
    return numbered.withColumn("id", F.concat(F.lit(prefix), F.format_string("%05d", "ord"))).drop("k")


def finish(rows: DataFrame, blocklist: DataFrame | None) -> DataFrame:
    """Deduplicated, classified, flagged (unless there is no block list) and scored."""
    rows = rows if "sources" in rows.columns else rows.withColumn("sources", F.lit(None).cast("array<string>"))
    lex = dedup_by_roman(rows, "ord", carry=[c for c in CARRIED if c in rows.columns]).withColumnsRenamed({"leader": "ord", "roman": "word_hinglish_roman"})
    if blocklist is not None:
        lex = flag_entries(lex, blocklist, id_col="ord")
    else:
        lex = lex.withColumns({"profanity": F.lit(False), "severity_score": F.lit(0.0)})
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    score = confidence(F.col("source"), F.col("_romanization_method"), F.size(F.array_distinct("sources")), filled("definition_hi"), filled("definition_en"), filled("example_sentence"), F.col("severity_score"))
    return lex.withColumn("confidence_score", F.round(score, 4)).drop("_romanization_method")


def build(synsets: DataFrame, lines: DataFrame, overrides: DataFrame, blocklist: DataFrame | None, supplemental: DataFrame | None = None) -> DataFrame:
    """The lexicon, one row per romanized headword: load, merge, romanize, transliterate texts, number, deduplicate, classify, flag, score.

    Each source is read once; the romanized rows are written once to the shared folder.
    """
    return finish(number_and_romanize(gather(synsets, parse_dictionary_lines(lines), supplemental), overrides), blocklist)
