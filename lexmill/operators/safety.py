"""Flagging by term list, and pluggable scoring of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import normalize_safety

#: Texts scored at once, and the score from which a text is toxic.
BATCH, THRESHOLD = 256, 0.70


def term_set(terms: DataFrame, column: str = "term") -> DataFrame:
    """(term): distinct normalised terms without blank ones."""
    return terms.select(F.trim(normalize_safety(F.col(column))).alias("term")).where("term <> ''").distinct()


#: Listed terms that go into a plan as a value; longer lists are joined.
INLINE_TERMS = 2_000


def flag_entries(entries: DataFrame, terms: DataFrame, column: str = "word_hinglish_roman", id_col: str = "rec_id") -> DataFrame:
    """``entries`` with profanity and severity_score (1.0 or 0.0): a token of ``column`` is a listed term.

    A list of up to ``INLINE_TERMS`` terms, counted first, is compared in place;
    a longer one by a semi join of tokens, with the same result. Ids must be unique.
    """
    listed = [r.term for r in term_set(terms).limit(INLINE_TERMS + 1).collect()]
    words = F.split(F.trim(normalize_safety(F.coalesce(F.col(column), F.lit("")))), "\\s+")
    if len(listed) <= INLINE_TERMS:
        hit = F.arrays_overlap(words, F.lit(sorted(listed))) if listed else F.lit(False)
        return entries.withColumns({"profanity": hit, "severity_score": F.when(hit, 1.0).otherwise(0.0)})
    tokens = entries.select(F.col(id_col).alias("_i"), F.explode(words).alias("term"))
    hits = tokens.join(term_set(terms), "term", "left_semi").select("_i").distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    return entries.join(hits, F.col(id_col) == F.col("_i"), "left").withColumns({"profanity": hit, "severity_score": F.when(hit, 1.0).otherwise(0.0)}).drop("_i", "_hit")


def score_severity(word, gloss, examples, terms: list[str]):
    """1.0 if a token of headword, gloss or examples (an array) is a listed term, else 0.0, as a Column."""
    words = F.split(F.trim(normalize_safety(F.concat_ws(" ", word, gloss, examples))), "\\s+")
    return F.when(F.arrays_overlap(words, F.lit(list(terms))), 1.0).otherwise(0.0) if terms else F.lit(0.0)


def score_texts(df: DataFrame, id_col: str, text_col: str, load: Callable[[], Callable[[list[str]], list[float]]], threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, toxic) by a model that ``load`` makes once per worker: texts -> scores.

    Texts go in batches of 256; null and blank ones are not given to the model
    and score 0. Where the model fails on a batch, its texts are scored one by
    one, and one that fails again gets 0.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()

        def one(t: str) -> float:
            try:
                return float(model([t])[0])
            except Exception:  # noqa: BLE001
                return 0.0

        for b in batches:
            texts = b.column(1).to_pylist()
            scores = [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if t and t.strip()]
            for k in range(0, len(at), BATCH):
                part = at[k : k + BATCH]
                try:
                    got = [float(x) for x in model([texts[i] for i in part])]
                except Exception:  # noqa: BLE001
                    got = [one(texts[i]) for i in part]
                for i, s in zip(part, got, strict=True):
                    scores[i] = s
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([s >= threshold for s in scores], pa.bool_())], names=["id", "score", "toxic"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, score double, toxic boolean").withColumnRenamed("id", id_col)
