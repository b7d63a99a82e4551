"""Readers of the dictionary formats. Each gives the columns of ENTRY, missing ones null."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import strip

#: Header names of CSV files that stand for a field; the first that is there counts.
HEADERS = {
    "word_hindi": ("hindi", "word_hindi", "hindi_word", "word"),
    "definition": ("english", "definition", "meaning", "eng"),
    "word_hinglish_roman": ("roman", "hinglish", "romanized", "transliteration"),
    "part_of_speech": ("pos", "part_of_speech", "type"),
}
#: Names of JSON fields that stand for a field; the first that isn't empty counts.
NAMES = {
    "word_hindi": ("word_hindi", "hindi", "word"),
    "definition": ("definition", "meaning", "english"),
    "word_hinglish_roman": ("word_hinglish_roman", "roman", "hinglish"),
    "part_of_speech": ("part_of_speech", "pos", "type"),
}
#: What every supplemental row has besides.
SUPPLEMENT = {"example_sentence": "''", "all_examples": "cast(array() as array<string>)", "synsets": "cast(array() as array<string>)", "confidence_score": "0.7D", "severity_score": "0.0D"}
SENSES = "array<struct<glosses:array<string>,raw_glosses:array<string>,examples:array<string>,tags:array<string>,synonyms:array<struct<word:string>>,antonyms:array<struct<word:string>>>>"
LINE = f"word string, lang string, lang_code string, pos string, redirect string, forms array<struct<form:string,tags:array<string>>>, senses {SENSES}"


def split_gloss(raw: Column) -> tuple[Column, Column]:
    """(gloss, examples) of 'gloss:"example"  /  "example"'."""
    at = F.instr(raw, ':"')
    gloss = F.when(at > 0, F.substr(raw, F.lit(1), at - 1)).otherwise(raw)
    rest = F.when(at > 0, F.substr(raw, at + 1)).otherwise(F.lit(""))
    parts = F.filter(F.transform(F.split(rest, '"  /  "'), lambda x: strip(x)), lambda x: x != "")
    return strip(gloss), F.transform(parts, lambda x: F.regexp_replace(x, '^"+|"+$', ""))


def parse_synsets(lines: DataFrame, column: str = "value") -> DataFrame:
    """(synset_id, words, gloss, examples, pos) of tab-separated lines.

    Blank lines, lines of fewer than four fields and such without a whole number
    in front are left out; the line's outer white space goes first, so an empty
    last field counts as missing.
    """
    f = F.split(strip(F.col(column)), "\t")
    rows = lines.where(strip(F.col(column)) != "").select(f.alias("f")).where(F.size("f") >= 4).withColumn("synset_id", F.expr("try_cast(trim(get(f, 0)) as int)")).where("synset_id is not null")
    gloss, examples = split_gloss(F.get("f", 2))
    words = F.filter(F.transform(F.split(F.get("f", 1), ","), lambda w: strip(w)), lambda w: w != "")
    return rows.select("synset_id", words.alias("words"), gloss.alias("gloss"), examples.alias("examples"), strip(F.get("f", 3)).alias("pos"))


def synset_entries(synsets: DataFrame) -> DataFrame:
    """One row per word of each synset."""
    return synsets.select(
        "synset_id", F.posexplode("words").alias("pos_in_synset", "word_hindi"), F.coalesce("gloss", F.lit("")).alias("definition"), F.coalesce("pos", F.lit("")).alias("part_of_speech"),
        F.coalesce(F.try_element_at("examples", F.lit(1)), F.lit("")).alias("example_sentence"), F.col("examples").alias("all_examples"),
        F.array(F.concat(F.lit("iwn-"), F.col("synset_id").cast("string"))).alias("synsets"), F.try_element_at("words", F.lit(1)).alias("head_word"),
    ).withColumns({"id": F.concat(F.lit("WN-"), F.col("synset_id").cast("string")), "word_hinglish_roman": F.lower("word_hindi"), "source": F.lit("WordNet"), "confidence_score": F.lit(1.0)})


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none if there is no such folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(path) if f.isFile())


def read_synsets(spark: SparkSession, path: str) -> DataFrame:
    return synset_entries(parse_synsets(spark.read.text(path)))


def read_synset_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The synset file of a folder: ``all.hindi``, else the first ``all.*``, in ``synsets`` or ``iwn_data/synsets``."""
    for sub in ("synsets", "iwn_data/synsets"):
        names = [n for n in _files(spark, f"{folder}/{sub}") if n.startswith("all.")]
        if names:
            return read_synsets(spark, f"{folder}/{sub}/{'all.hindi' if 'all.hindi' in names else names[0]}")
    raise FileNotFoundError(f"no synset file in {folder}")


def read_dictionary_folder(spark: SparkSession, folder: str, lang: str = "hi") -> DataFrame:
    """The first ``*.jsonl`` file of a folder, by name."""
    names = [n for n in _files(spark, folder) if n.endswith(".jsonl")]
    if not names:
        raise FileNotFoundError(f"no .jsonl file in {folder}")
    return read_dictionary(spark, f"{folder}/{names[0]}", lang)


def parse_dictionary_lines(lines: DataFrame, column: str = "line", lang: str = "hi") -> DataFrame:
    """Words (with forms and senses) of raw JSON lines in one language.

    Blank and broken lines, lines that have a redirect and other languages are
    left out. Examples keep their raw text: they are objects or strings.
    """
    text = F.col(column)
    parsed = lines.where(strip(F.coalesce(text, F.lit(""))) != "").withColumn("_v", F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))).withColumn("_j", F.from_json(text, LINE))
    has_redirect = F.coalesce(F.array_contains(F.json_object_keys(text), "redirect"), F.lit(False))
    one = F.col("_v").isNotNull() & F.expr("try_variant_get(_v, '$[1]', 'variant') is null")  # one value and nothing behind it
    return parsed.where(one & (F.col("_j.lang_code") == lang) & ~has_redirect).select(*[c for c in lines.columns if c != column], "_j.word", "_j.pos", "_j.forms", "_j.senses")


def form_roman(forms: Column) -> Column:
    """First form tagged as a romanization (even an empty one), else the first that is ASCII, else ''."""
    tagged = F.filter(forms, lambda f: F.coalesce(F.arrays_overlap(f["tags"], F.array(F.lit("romanization"), F.lit("roman"))), F.lit(False)))
    plain = F.filter(forms, lambda f: F.coalesce(f["form"].rlike("^[\\x00-\\x7f]+$"), F.lit(False)))
    return F.when(F.size(tagged) > 0, F.coalesce(F.try_element_at(tagged, F.lit(1))["form"], F.lit(""))).otherwise(F.coalesce(F.try_element_at(plain, F.lit(1))["form"], F.lit("")))


def sense_definition(sense: Column) -> Column:
    """First gloss, else the first raw gloss without its remarks in brackets, else ''."""
    raw = F.regexp_replace(F.try_element_at(sense["raw_glosses"], F.lit(1)), "\\([^)]*\\)\\s*", "")
    return F.coalesce(F.try_element_at(sense["glosses"], F.lit(1)), raw, F.lit(""))


def sense_example(sense: Column) -> Column:
    """First example with a text: 'text (translation)' of an object, a string as it is, else ''."""

    def one(x: Column) -> Column:
        text, translation = F.get_json_object(x, "$.text"), F.get_json_object(x, "$.translation")
        whole = F.when(F.coalesce(translation, F.lit("")) != "", F.concat(text, F.lit(" ("), translation, F.lit(")"))).otherwise(text)
        return F.when(F.startswith(x, F.lit("{")), F.when(F.coalesce(text, F.lit("")) != "", whole)).otherwise(x)

    return F.coalesce(F.try_element_at(F.filter(F.transform(sense["examples"], one), lambda x: x.isNotNull()), F.lit(1)), F.lit(""))


def dictionary_entries(words: DataFrame) -> DataFrame:
    """One row per sense that has a definition; id WK-word-pos-index."""
    x = words.select(*[c for c in words.columns if c not in ("forms", "senses")], form_roman(F.col("forms")).alias("word_hinglish_roman"), F.posexplode("senses").alias("i", "s"))
    s = F.col("s")
    out = x.select(
        *[c for c in x.columns if c not in ("i", "s", "word", "pos")], F.format_string("WK-%s-%s-%d", F.coalesce("word", F.lit("")), F.coalesce("pos", F.lit("")), "i").alias("id"), F.col("word").alias("word_hindi"), F.coalesce("pos", F.lit("")).alias("part_of_speech"),
        sense_definition(s).alias("definition"), sense_example(s).alias("example_sentence"), s["tags"].alias("tags"), _named(s["synonyms"]).alias("synonyms"), _named(s["antonyms"]).alias("antonyms"), F.lit("Wiktionary").alias("source"), F.lit(0.85).alias("confidence_score"),
        F.col("i").cast("long").alias("sense"), F.array().cast("array<string>").alias("synsets"),
    )
    return out.where("definition <> ''").withColumn("all_examples", F.when(F.col("example_sentence") != "", F.array("example_sentence")).otherwise(F.array().cast("array<string>")))


def _named(words: Column) -> Column:
    """The words of a list of objects, without empty ones."""
    return F.filter(F.transform(words, lambda w: w["word"]), lambda w: F.coalesce(w, F.lit("")) != "")


def read_dictionary(spark: SparkSession, path: str, lang: str = "hi") -> DataFrame:
    return dictionary_entries(parse_dictionary_lines(spark.read.text(path).withColumnRenamed("value", "line"), "line", lang))


def _normal_names(df: DataFrame) -> dict[str, str]:
    return {c.strip().lower(): c for c in reversed(df.columns)}


def aliased(df: DataFrame) -> DataFrame:
    """The supplemental fields of a table with any of their header names (case and outer blanks don't matter)."""
    there = _normal_names(df)
    fields = [next((strip(F.coalesce(F.col(f"`{there[n]}`").cast("string"), F.lit(""))) for n in names if n in there), F.lit("")).alias(field) for field, names in HEADERS.items()]
    return df.select(*fields).where("word_hindi <> '' or definition <> ''")


def named(df: DataFrame) -> DataFrame:
    """The supplemental fields of JSON objects with any of their names."""
    fields = [F.coalesce(*[F.nullif(strip(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in df.columns], F.lit("")).alias(field) for field, names in NAMES.items()]
    return df.select(*fields).where("word_hindi <> '' or definition <> ''")


def read_supplemental(spark: SparkSession, path: str) -> DataFrame:
    """A CSV, JSON array or JSON lines file, in its order (``place``); other suffixes are refused. source: supplemental/<name>.

    JSON text of several lines whose first one is an object is read line by
    line, broken lines being left out; anything else must be one array, else there are no rows.
    """
    name, suffix = re.fullmatch(r"(?:.*/)?([^/]*?)\.([^.]+)", path).groups()
    suffix = suffix.lower()
    if suffix == "csv":
        rows = aliased(spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path))
    elif suffix in ("json", "jsonl"):
        head = spark.read.text(path).where(F.trim("value") != "").limit(2).collect()
        if len(head) > 1 and head[0][0].strip().startswith("{") and head[0][0].strip().endswith("}"):
            df = spark.read.option("mode", "DROPMALFORMED").json(path)
        elif head and head[0][0].strip().startswith("["):
            df = spark.read.option("multiLine", True).json(path)
        else:
            df = spark.createDataFrame([], "word_hindi string, definition string")
        rows = named(df)
    else:
        raise ValueError(f"no reader for .{suffix}")
    return rows.withColumn("place", F.monotonically_increasing_id()).withColumn("source", F.lit(f"supplemental/{name}")).withColumns({c: F.expr(x) for c, x in SUPPLEMENT.items()})


def read_supplemental_folder(spark: SparkSession, folder: str) -> DataFrame | None:
    """All files of a folder that have a reader, by name; ids SUP-<name>-<running number>; None if there are none."""
    from lexmill.sinks.writers import number_rows

    out = None
    for i, name in enumerate(n for n in _files(spark, folder) if n.rpartition(".")[2].lower() in ("csv", "json", "jsonl")):
        part = read_supplemental(spark, f"{folder}/{name}").withColumn("file", F.lit(i))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return None
    numbered = number_rows(out, [F.col("file"), F.col("place")], "_n")
    return numbered.withColumn("id", F.concat(F.lit("SUP-"), F.regexp_replace("source", "^supplemental/", ""), F.lit("-"), (F.col("_n") - 1).cast("string"))).withColumn("place", F.col("_n")).drop("_n", "file")


def read_linkage(spark: SparkSession, path: str) -> DataFrame:
    """(synset_id, english): the last line of each synset; # lines and short ones are left out."""
    from pyspark.sql.functions import monotonically_increasing_id

    rows = spark.read.text(path).withColumn("o", monotonically_increasing_id()).where("trim(value) <> '' and not startswith(trim(value), '#')").select("o", F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    rows = rows.select("o", F.expr("try_cast(trim(get(f, 1)) as int)").alias("synset_id"), strip(F.get("f", 2)).alias("english")).where("synset_id is not null")
    return rows.groupBy("synset_id").agg(F.max(F.struct("o", "english")).alias("m")).select("synset_id", F.col("m.english").alias("english"))


def read_hypernymy(spark: SparkSession, *paths: str) -> DataFrame:
    """(child_synset, parent_synset) of lines with exactly two fields."""
    f = spark.read.text(list(paths)).select(F.split(strip(F.col("value")), "\t").alias("f")).where(F.size("f") == 2)
    return f.selectExpr("try_cast(trim(get(f, 0)) as int) child_synset", "try_cast(trim(get(f, 1)) as int) parent_synset").where("child_synset is not null and parent_synset is not null")


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """(term) of a {"words": [...]} document."""
    return spark.read.schema("words array<string>").option("multiLine", True).json(path).select(F.explode("words").alias("term"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(word_hindi, roman) of one JSON object of words."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("word_hindi", "roman"))
