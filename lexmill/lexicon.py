"""The library's front door: a lexicon built from sources or read from a folder, with lookup, search, audits and writers.

Every step gives a new ``Lexicon`` over a DataFrame; nothing runs before a
result is asked for, but for the steps that number rows (they write them once).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import dedup, graph, search, stats
from lexmill.operators.index import SearchIndex
from lexmill.plans import build
from lexmill.sinks import writers
from lexmill.sources import dictionaries

TEXTS = ["word_hindi", "word_hinglish_roman", "definition"]


@dataclass(frozen=True)
class Lexicon:
    """``entries`` with a unique ``ord_col``; the tables some steps and audits need are kept beside it."""

    entries: DataFrame
    overrides: DataFrame | None = None
    blocklist: DataFrame | None = None
    ord_col: str = "ord"
    index: SearchIndex | None = field(default=None, compare=False)

    # --- building ---------------------------------------------------------------
    @staticmethod
    def from_sources(spark: SparkSession, synset: str | None = None, jsonl: str | None = None, supplemental: str | None = None, overrides: str | None = None, blocklist: str | None = None) -> Lexicon:
        """Merged rows of the given folders (a missing source is left out), not yet romanized or numbered."""
        synsets = spark.createDataFrame([], "synset_id int, words array<string>, gloss string, examples array<string>, pos string")
        if synset:
            names = [n for n in dictionaries._files(spark, synset) if n.startswith("all.")]
            at = f"{synset}/{'all.hindi' if 'all.hindi' in names else names[0]}" if names else None
            synsets = dictionaries.parse_synsets(spark.read.text(at or synset))
        words = spark.createDataFrame([], "line_no long, line string")
        if jsonl:
            files = [n for n in dictionaries._files(spark, jsonl) if n.endswith(".jsonl")]
            words = spark.read.text(f"{jsonl}/{files[0]}" if files else jsonl).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
        more = dictionaries.read_supplemental_folder(spark, supplemental) if supplemental else None
        merged = build.gather(synsets, dictionaries.parse_dictionary_lines(words), more)
        empty = spark.createDataFrame([], "word_hindi string, roman string")
        return Lexicon(merged, dictionaries.read_overrides(spark, overrides) if overrides else empty, dictionaries.read_terms(spark, blocklist) if blocklist else None)

    @staticmethod
    def read(spark: SparkSession, path: str, ord_col: str = "ord") -> Lexicon:
        """A lexicon's Parquet folder, or its JSON lines where the name ends in .json or .jsonl."""
        df = spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
        return Lexicon(df, ord_col=ord_col)

    def romanize(self) -> Lexicon:
        """Romanized headwords and texts, numbers and ids."""
        return replace(self, entries=build.number_and_romanize(self.entries, self.overrides))

    def dedup_by(self, key: str = "roman", skip_safety: bool = False) -> Lexicon:
        """One row per romanized headword, classified, flagged and scored; ``key`` "definition": per headword and definition, as groups."""
        if key == "definition":
            return replace(self, entries=dedup.dedup_by_definition(self.entries, self.ord_col))
        return replace(self, entries=build.finish(self.entries, None if skip_safety else self.blocklist))

    def build(self, skip_safety: bool = False) -> Lexicon:
        return self.romanize().dedup_by("roman", skip_safety)

    def lists(self, columns: tuple[str, ...] = ("synsets", "all_examples")) -> DataFrame:
        """The items a key's leader takes from its group, as rows (before ``dedup_by``)."""
        return dedup.merged_lists(self.entries, list(columns), self.ord_col)

    # --- parts ------------------------------------------------------------------
    @property
    def safe(self) -> DataFrame:
        return writers.split_safe(self.entries)[0]

    @property
    def excluded(self) -> DataFrame:
        return writers.split_safe(self.entries)[1]

    def meta(self) -> DataFrame:
        return stats.meta(self.entries)

    # --- serving ----------------------------------------------------------------
    def indexed(self, path: str) -> Lexicon:
        """With an index at ``path`` that lookups and searches by token use."""
        return replace(self, index=SearchIndex.build(self.entries, path, TEXTS, self.ord_col))

    def lookup(self, word: str, limit: int = 10, safe: bool = False, min_confidence: float = 0.0, mode: str = "all") -> DataFrame:
        """Exact matches, else substring matches. ``mode`` "last" (with an index): the last exact match alone."""
        search.check_limit(limit)
        if self.index is not None:
            return self.index.lookup(word, limit, safe, min_confidence, mode)
        return search.lookup(self.entries, word, limit, safe, min_confidence, self.ord_col).drop("tier")

    def search(self, q: str, mode: str = "tier", limit: int = 20, safe: bool = False, min_confidence: float = 0.0, pos: str | None = None) -> DataFrame:
        """``mode``: tier (substrings, best first), fts (every token) or prefix (every token's beginning)."""
        search.check_limit(limit)
        if mode == "tier":
            return search.tier_search(self.entries, q, limit, safe, min_confidence, pos, self.ord_col)
        if mode not in ("fts", "prefix"):
            raise ValueError(f"no search mode {mode!r}")
        if self.index is not None and pos is None:
            return self.index.search(q, limit, safe, min_confidence, mode == "prefix")
        rows = self.entries if pos is None else self.entries.where(F.col("part_of_speech") == pos)
        return search.full_text(rows, q, TEXTS, limit, safe, min_confidence, mode == "prefix", ord_col=self.ord_col)

    def suggest(self, q: str, limit: int = 8) -> DataFrame:
        return search.suggest(self.entries, q, limit, self.ord_col)

    def best_match(self, slug: str) -> DataFrame:
        return search.best_match(self.entries, slug, self.ord_col)

    def word_page(self, slug: str, relations: DataFrame, k: int = 20) -> tuple[DataFrame, DataFrame]:
        """(best match, its related entries by type and rank)."""
        best = self.best_match(slug)
        own = best.select(F.col("id").alias("entry_id"))
        return best, graph.related_top(relations.join(F.broadcast(own), "entry_id", "left_semi"), self.entries, k)  # one id

    def related(self, entry_id: str, relations: DataFrame, k: int = 20) -> DataFrame:
        return graph.related_top(relations.where(F.col("entry_id") == entry_id), self.entries, k)

    def stats(self, relations: DataFrame) -> DataFrame:
        return stats.stats(self.entries, relations)

    def facets(self, page: DataFrame) -> DataFrame:
        return search.facets(page)

    def enrich(self, hypernymy: DataFrame, k: int = 20) -> DataFrame:
        """(entry_id, relation_type, related_entry_id, rank) by shared synsets and hypernymy; needs id, synsets and rec_id."""
        e = self.entries if "rec_id" in self.entries.columns else self.entries.withColumn("rec_id", F.col(self.ord_col))
        same = graph.same_synset(e, k).withColumn("relation_type", F.lit("same_synset"))
        return same.unionByName(graph.broader_narrower(e, hypernymy, k))

    # --- audits and writers -----------------------------------------------------
    def audit(self, *names: str) -> dict[str, DataFrame]:
        """The named audits (all by default): transliteration, merge, safety, confidence, each as one or more tables."""
        audits: dict[str, Callable[[], dict[str, DataFrame]]] = {
            "transliteration": lambda: {"health": stats.roman_health(self.entries)} | ({"kinds": stats.romanization_audit(self.entries, self.overrides), "summary": stats.romanization_summary(self.entries, self.overrides)} if self.overrides is not None else {}),
            "merge": lambda: {"summary": stats.merge_audit(self.entries), "source_sets": stats.source_sets(self.entries)},
            "safety": lambda: {"severity": stats.severity_histogram(self.entries)} | ({"missed": stats.false_negatives(self.entries.withColumn("rec_id", F.col(self.ord_col)), self.blocklist), "suggested": stats.suggested_terms(self.entries, self.blocklist)} if self.blocklist is not None else {}),
            "confidence": lambda: {"buckets": stats.confidence_audit(self.entries), "sources": stats.bucket_sources(self.entries)},
        }
        unknown = set(names) - set(audits)
        if unknown:
            raise ValueError(f"no audit named {sorted(unknown)}")
        return {f"{n}.{part}": df for n in names or audits for part, df in audits[n]().items()}

    def write_parquet(self, path: str) -> None:
        self.entries.write.mode("overwrite").parquet(path)

    def write_json(self, path: str, compact: bool = True) -> None:
        writers.write_json(self.entries, path, compact)

    def write_keyboard(self, path: str, locale: str = "hi_Latn") -> None:
        writers.write_keyboard(writers.keyboard_rows(self.entries, self.ord_col, locale), path)

    def write_words(self, path: str) -> None:
        writers.write_words(writers.word_list(self.entries), path)

    def write_all(self, path: str, version: str, built: str) -> None:
        writers.write_artifacts(self.entries, path, version, built)
