"""Writers of the lexicon's artifacts. All write folders of part files, in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.score import frequency
from lexmill.functions.text import has_devanagari, keyboard_word
from lexmill.operators.search import is_safe
from lexmill.plans.runtime import durable


def split_safe(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(safe, excluded): disjoint, together all rows."""
    return entries.where(is_safe()), entries.where(~is_safe())


def excluded_rows(entries: DataFrame) -> DataFrame:
    """The six fields kept of excluded entries."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return entries.where(~is_safe()).select(text("id"), text("word_hindi"), text("word_hinglish_roman"), text("definition"), "severity_score", text("source"))


def write_json(entries: DataFrame, path: str, compact: bool = True) -> None:
    """JSON lines; without null fields if compact."""
    entries.write.mode("overwrite").option("ignoreNullFields", compact).json(path)


def upsert(existing: DataFrame, changes: DataFrame, ord_col: str, id_col: str = "id") -> DataFrame:
    """The last row of each id; of equal ords the changes' row."""
    both = existing.withColumn("_c", F.lit(0)).unionByName(changes.withColumn("_c", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_c"]
    return both.groupBy(F.col(id_col).alias("_id")).agg(F.max_by(F.struct(*columns), F.struct(F.col(ord_col), F.col("_c"))).alias("r")).select("r.*")


def flat(c: str) -> Column:
    """An array as comma-separated text, anything else as text; null as ''."""
    return F.coalesce(F.array_join(F.col(c), ", "), F.lit(""))


def keyboard_rows(entries: DataFrame, ord_col: str = "rec_id", locale: str = "hi_Latn") -> DataFrame:
    """(word, freq, locale, pos, ord): safe Latin words, highest frequency, position and part of speech of the first."""
    w = keyboard_word(F.coalesce("word_hinglish_roman", F.lit("")))
    rows = entries.where(is_safe()).select(w.alias("word"), frequency(F.coalesce(F.nanvl(F.col("confidence_score"), F.lit(0.0)), F.lit(0.0))).alias("freq"), F.coalesce("part_of_speech", F.lit("")).alias("pos"), F.col(ord_col).cast("long").alias("ord")).where((F.col("word") != "") & ~has_devanagari(F.col("word")))
    return rows.groupBy("word").agg(F.max("freq").alias("freq"), F.min(F.struct("ord", "pos")).alias("m")).select("word", "freq", F.lit(locale).alias("locale"), F.col("m.pos").alias("pos"), F.col("m.ord").alias("ord"))


def write_keyboard(rows: DataFrame, path: str) -> None:
    """Six tab-separated columns, lines ended by CR LF, in order of first appearance."""
    line = F.concat_ws("\t", "word", F.col("freq").cast("string"), "locale", F.lit(""), F.lit(""), "pos")
    rows.orderBy("ord").select(line.alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def word_list(entries: DataFrame) -> DataFrame:
    """(word): distinct safe Latin words."""
    w = keyboard_word(F.coalesce("word_hinglish_roman", F.lit("")))
    return entries.where(is_safe()).select(w.alias("word")).where((F.col("word") != "") & ~has_devanagari(F.col("word"))).distinct()


def sql_quote(c: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("'"), F.lit("''")), F.lit("'"))


def sql_dump(entries: DataFrame, columns: list[str], table: str, by: list[str], per: int = 10) -> DataFrame:
    """(n, stmt): INSERTs of ``per`` rows each in order of ``by``, numbered in that order."""
    row = F.concat(F.lit("("), F.concat_ws(",", *[sql_quote(F.col(c)) for c in columns]), F.lit(")"))
    placed = number_rows(entries.select(*dict.fromkeys(by), row.alias("_r")), [F.col(c) for c in by], "_n")
    head = f"INSERT INTO {table} ({','.join(columns)}) VALUES "
    # a statement's rows are ``per`` at most
    rows = placed.groupBy(F.floor((F.col("_n") - 1) / per).alias("n")).agg(F.array_sort(F.collect_list(F.struct("_n", "_r"))).alias("rs"))
    return rows.select("n", F.concat(F.lit(head), F.array_join(F.col("rs._r"), ","), F.lit(";")).alias("stmt"))


def write_dump(dump: DataFrame, path: str) -> None:
    """The statements of ``sql_dump`` as text, in order."""
    dump.orderBy("n").select(F.col("stmt").alias("value")).write.mode("overwrite").text(path)


def number_rows(df: DataFrame, by: list, column: str = "ord") -> DataFrame:
    """``df``, written in order of ``by``, with its rows' places in that order (from 1), counted without one global window.

    Rows are range-partitioned and counted per partition; the counts (one
    number per partition) give each partition its offset.
    """
    placed = durable(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, at = [], 0
    for p, n in counts:
        offsets += [F.lit(p), F.lit(at)]
        at += n
    return placed.withColumn(column, F.pmod("_m", F.lit(1 << 33)) + 1 + (F.create_map(*offsets)[part] if offsets else F.lit(0))).drop("_m")


def assign_ids(entries: DataFrame, ord_col: str = "rec_id", prefix: str = "HIN-") -> DataFrame:
    """``entries`` with id: their place in order of ``ord_col``, of five digits or more."""
    return number_rows(entries, [F.col(ord_col)], "_n").withColumn("id", F.concat(F.lit(prefix), F.format_string("%05d", "_n"))).drop("_n")


# --- artifacts ------------------------------------------------------------------
def without_empty(entries: DataFrame) -> DataFrame:
    """Empty texts and lists as null, so that a compact JSON leaves them out."""
    out = []
    for name, kind in entries.dtypes:
        c = F.col(f"`{name}`")
        out.append((F.nullif(c, F.lit("")) if kind == "string" else F.when(F.size(c) > 0, c) if kind.startswith("array") else c).alias(name))
    return entries.select(*out)


def meta_row(entries: DataFrame, version: str, built: str, description: str = "") -> DataFrame:
    """One row: version, date, description, totals, and the counts of ``stats.meta`` as one map per metric."""
    from lexmill.operators.stats import meta

    counts = meta(entries).groupBy().pivot("metric", ["source", "pos", "lang", "confidence", "multi_source"]).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))))
    totals = entries.agg(F.count("*").alias("total_entries"), F.count_if(is_safe()).alias("safe_entries"), F.count_if(~is_safe()).alias("excluded_entries"))
    head = [F.lit(version).alias("version"), F.lit(built).alias("built"), F.lit(description).alias("description")]
    return totals.crossJoin(counts).select(*head, "total_entries", "safe_entries", "excluded_entries", "source", "pos", "lang", "confidence", "multi_source")


def write_artifacts(entries: DataFrame, path: str, version: str, built: str, locale: str = "hi_Latn") -> None:
    """The lexicon's files: full, compact, safe and safe compact JSON lines with a meta row each, the excluded list with its total, keyboard dictionary and word list.

    Every file is a folder of part files written in parallel; nothing is
    gathered into one document.
    """
    safe, excluded = split_safe(entries)
    for name, df in (("full", entries), ("safe", safe)):
        write_json(df, f"{path}/{name}", compact=False)
        write_json(without_empty(df), f"{path}/{name}_compact")
        meta_row(df, version, built, name).write.mode("overwrite").json(f"{path}/{name}_meta")
    excluded_rows(entries).write.mode("overwrite").json(f"{path}/excluded")
    excluded.agg(F.count("*").alias("total_excluded")).write.mode("overwrite").json(f"{path}/excluded_meta")
    write_keyboard(keyboard_rows(entries, "ord" if "ord" in entries.columns else "rec_id", locale), f"{path}/keyboard")
    write_words(word_list(entries), f"{path}/words")


def write_words(words: DataFrame, path: str) -> None:
    """The word list in code point order, as ranges of it over the part files."""
    words.orderBy("word").select(F.col("word").alias("value")).write.mode("overwrite").text(path)


def export_rows(entries: DataFrame, columns: list[str]) -> DataFrame:
    """Rows for a full-text table: entries of a severity below 0.5, arrays as comma-separated text, null texts as ''."""
    types = dict(entries.dtypes)
    return entries.where(is_safe()).select(*[(flat(c) if types[c].startswith("array") else F.coalesce(F.col(c), F.lit("")) if types[c] == "string" else F.col(c)).alias(c) for c in columns])


def export_searchable(entries: DataFrame, path: str, columns: list[str], ord_col: str = "rec_id", id_col: str = "id") -> int:
    """Write the last row of each id that is safe as a searchable index at ``path``; how many. What was there is replaced."""
    from lexmill.operators.index import SearchIndex

    last = upsert(entries.limit(0), entries, ord_col, id_col).where(is_safe())
    types = dict(last.dtypes)
    rows = last.select(*[flat(c).alias(c) if types[c].startswith("array") else F.col(c) for c in last.columns])
    return SearchIndex.build(rows, path, columns, ord_col).n


def html_escape(c: Column) -> Column:
    """&, <, > and both quotes as entities; null stays."""
    for x, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(x), F.lit(name))
    return c


def write_enriched(entries: DataFrame, relations: DataFrame, path: str) -> None:
    """Entries with their related ones (entry_id, relation_type, related_entry_id, rank) as lists by type, 20 each at most; whole and compact."""
    names = entries.groupBy(F.col("id").alias("related_entry_id")).agg(F.min(F.struct("word_hindi", "word_hinglish_roman")).alias("n"))
    one = F.struct("rank", F.struct(F.col("related_entry_id").alias("id"), "n.word_hindi", "n.word_hinglish_roman").alias("e"))
    lists = relations.join(names, "related_entry_id").groupBy("entry_id").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("relation_type") == t, one))), lambda x: x["e"]).alias(name) for t, name in (("same_synset", "same_synset"), ("broader", "broader_terms"), ("narrower", "narrower_terms"))])
    out = entries.join(lists.withColumnRenamed("entry_id", "id"), "id", "left")
    write_json(out, f"{path}/enriched", compact=False)
    write_json(without_empty(out), f"{path}/enriched_min")


def seed_tables(entries: DataFrame, relations: DataFrame, path: str, ord_col: str = "rec_id") -> dict[str, int]:
    """Write ``entries`` (the last row of each id, all columns) and ``related_words`` (clean edges) as tables, replacing what was there; their counts, read back."""
    from lexmill.operators.graph import clean_relations

    last = upsert(entries.limit(0), entries, ord_col)
    last.write.mode("overwrite").parquet(f"{path}/entries")
    clean_relations(relations, last).write.mode("overwrite").parquet(f"{path}/related_words")
    spark = entries.sparkSession
    return {t: spark.read.parquet(f"{path}/{t}").count() for t in ("entries", "related_words")}
