"""One surviving record per group of duplicates, the best value field by field.

The fields are unpivoted to long rows. Every usable value gets votes: each
source row votes with its source's trust, halved for each half-life of its age.
Votes are summed per normalised value, the winner of each field is taken by
max_by, and the winners are pivoted back to one row per group.

Scale: votes are cast where a value's rows of one moment meet (placed by group,
field, value and moment, which spreads a value that a third of all rows hold),
then summed per value with partial sums. Values are placed for this by ranges
of (group, field, value), so a hot group spreads over as many tasks as it
needs, and stand sorted: the beginning of a fuller text stands right before a
text that begins with it, so one look at the next row finds every cut-off text,
however short, without a window over the group. The rows at the edges of
partitions, two of each, are compared once more. Winners have partial results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.visual import canonical_values, looks_plain
from lexmill.plans.runtime import durable

#: Trust of a source; sources not named have OTHER_TRUST. Parameters of best_records.
TRUST = {"WordNet": 1.0, "Wiktionary": 0.85}
OTHER_TRUST = 0.7
#: Seconds in which a vote loses half its weight, and half-lives by source; 1,000 half-lives (19 years) weigh as more do.
HALF_LIFE = 7 * 86_400
HALF_LIVES: dict[str, int] = {}
OLDEST = 1_000.0
#: Texts that stand for "no value" (lower case).
PLACEHOLDERS = ("n/a", "na", "n.a.", "none", "(none)", "null", "nil", "nan", "tbd", "todo", "fixme", "xxx", "unknown", "undefined", "missing", "no definition", "no value", "not available", "empty", "(empty)", "#n/a")
#: A text that says itself that it is cut off: a trailing ellipsis or open bracket.
CUT_MARK = "(…|\\.\\.+|[\\[(]|\\[(…|\\.\\.+)\\]?)\\s*$"
_STRIP = "^[\\s\\x{85}\\p{Z}]+|[\\s\\x{85}\\p{Z}]+$"


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, _STRIP, "")


def _usable_text(stripped: Column) -> Column:
    return (stripped != "") & ~F.lower(stripped).isin(*PLACEHOLDERS) & stripped.rlike("[\\p{L}\\p{N}]") & ~stripped.rlike(CUT_MARK)


def _code(field: str) -> Column:
    return F.lit(("definition_en", "confidence_score", "word_hindi").index(field)).cast("byte")


def duplicate_key(c: Column) -> Column:
    """Lower case without outer blanks; blank and null give null (no group)."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def _by_source(values: dict[str, float], other: float) -> Column:
    if not values:
        return F.lit(float(other))
    return F.coalesce(F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))])[F.trim(F.col("source"))], F.lit(float(other)))


def _cut_off(values: DataFrame) -> DataFrame:
    """``values`` (dup_key, field, norm, ...), sorted in ranges, without those that begin another one of their group and field."""
    names = values.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for b in batches:
            if held is not None:
                b = pa.concat_batches([held, b])
            n = b.num_rows
            if not n:
                continue
            key, field, norm = (b.column(names.index(c)).to_pylist() for c in ("dup_key", "field", "norm"))
            same = [norm[i + 1].startswith(norm[i]) and field[i] == field[i + 1] and key[i] == key[i + 1] for i in range(n - 1)]
            yield flagged(b.slice(0, n - 1), same, first, False)
            first, held = first and n == 1, b.slice(n - 1, 1)
        if held is not None:
            yield flagged(held, [False], first, True)

    def flagged(b: pa.RecordBatch, cut: list[bool], first: bool, last: bool) -> pa.RecordBatch:
        edge = [last or (first and i == 0) for i in range(len(cut))]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(cut, pa.bool_()), pa.array(edge, pa.bool_()), pa.array([last] * len(cut), pa.bool_())], names=[*names, "cut", "edge", "last"])

    schema = ", ".join(f"{n} {t}" for n, t in values.dtypes)
    marked = durable(values.mapInArrow(mark, f"{schema}, cut boolean, edge boolean, last boolean").where("not cut or edge"))
    # two rows of each partition at most: the last one meets the next partition's first
    after = F.lead(F.struct("dup_key", "field", "norm")).over(Window.orderBy("dup_key", "field", "norm"))
    edges = marked.where("edge").select("dup_key", "field", "norm", "last", after.alias("after")).where("last")
    late = edges.where((F.col("after.dup_key") == F.col("dup_key")) & (F.col("after.field") == F.col("field")) & F.startswith(F.col("after.norm"), F.col("norm"))).select("dup_key", "field", "norm")
    return marked.where("not cut").drop("cut", "edge", "last").join(F.broadcast(late), ["dup_key", "field", "norm"], "left_anti")


def best_records(df: DataFrame, key: Column, trust: dict[str, float] | None = None, other_trust: float = OTHER_TRUST, half_life: int = HALF_LIFE, half_lives: dict[str, int] | None = None) -> DataFrame:
    """(dup_key, word_hindi, definition_en, confidence_score, sources) of each group of two or more rows.

    ``df`` needs word_hindi, definition_en, confidence_score, source, sources
    and updated_at; other columns are not read. Rows without a key form no
    group. A field without a usable value is null; ``sources`` is then an empty
    array. Rows sent again count as rows of the group and vote once. A null
    updated_at is older than any other. ``half_lives``: of single sources, in
    seconds; ages count from the table's newest row. Ties: the newer value, then
    the higher trust of its newest row's source, then the longer text, then the
    greater.
    """
    trust, half_lives = TRUST if trust is None else trust, HALF_LIVES if half_lives is None else half_lives
    us = F.coalesce(F.unix_micros("updated_at") if dict(df.dtypes)["updated_at"] == "timestamp" else F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(0))
    newest = df.agg(F.max(us)).first()[0] or 0
    base = df.select(
        key.alias("dup_key"), F.col("word_hindi"), F.col("definition_en"), F.col("confidence_score"), F.col("source"), F.col("sources"),
        _by_source(trust, other_trust).alias("trust"), _by_source(half_lives, half_life).alias("half"), us.alias("us"),
    ).where(F.col("dup_key").isNotNull())

    # fields by number; the stored text travels only where it differs from the normalised one
    score = F.when((F.col("confidence_score") >= 0) & (F.col("confidence_score") <= 1) & ~F.isnan("confidence_score"), F.format_string("%.4f", F.col("confidence_score")))
    definition = strip(F.col("definition_en"))
    stored = F.when(definition != F.col("definition_en"), F.col("definition_en"))
    plain = F.col("word_hindi").isNotNull() & looks_plain(F.col("word_hindi"))
    none = F.lit(None).cast("string")
    vote = (F.col("trust") * F.pow(F.lit(2.0), F.greatest((F.col("us") - newest) / 1e6 / F.col("half"), F.lit(-OLDEST)))).alias("vote")
    long = base.select(
        "dup_key", "trust", "us", vote,
        F.explode(F.array(
            F.struct(_code("definition_en").alias("field"), definition.alias("norm"), stored.alias("stored")),
            F.struct(_code("confidence_score").alias("field"), score.alias("norm"), none.alias("stored")),
            F.struct(_code("word_hindi").alias("field"), F.when(plain, F.col("word_hindi")).alias("norm"), none.alias("stored")),
        )).alias("x"),
    ).select("dup_key", "trust", "us", "vote", "x.*").where(F.col("norm").isNotNull())
    odd = base.where(F.col("word_hindi").isNotNull() & ~plain & (F.col("word_hindi") != "")).select("dup_key", "trust", "us", vote, F.col("word_hindi").alias("value"))
    forms = canonical_values(base.select(F.col("word_hindi").alias("value")))
    odd = odd.join(forms, "value").select("dup_key", "trust", "us", "vote", _code("word_hindi").alias("field"), F.col("form").alias("norm"), none.alias("stored"))
    long = long.unionByName(odd).where((F.col("field") == _code("confidence_score")) | _usable_text(F.col("norm")))

    # rows sent again (same value and moment) meet by a number made of the moment, and vote once; the votes
    # of one such place are summed before they are placed by value
    placed = long.withColumn("place", F.pmod(F.xxhash64("us"), F.lit(1 << 16)).cast("int")).repartition("dup_key", "field", "norm", "place")
    once = placed.groupBy("dup_key", "field", "norm", "place", "us").agg(F.max("vote").alias("vote"), F.max(F.struct("trust", "stored")).alias("x"))
    parts = once.groupBy("dup_key", "field", "norm", "place").agg(F.sum("vote").alias("vote"), F.max(F.struct("us", "x")).alias("newest"))
    ranged = parts.repartitionByRange("dup_key", "field", "norm")
    values = ranged.groupBy("dup_key", "field", "norm").agg(F.sum("vote").alias("vote"), F.max("newest").alias("newest")).select("dup_key", "field", "norm", "vote", F.col("newest.us").alias("us"), F.col("newest.x.trust").alias("trust"), F.col("newest.x.stored").alias("stored"))
    usable = _cut_off(values.sortWithinPartitions("dup_key", "field", "norm"))

    rank = F.struct("vote", "us", "trust", F.length("norm").alias("n"), F.col("norm").alias("v"))

    def best(field: str) -> Column:
        return F.max_by(F.coalesce("stored", "norm"), F.when(F.col("field") == _code(field), rank)).alias(field)

    # max_by passes over null ranks, so a field without a usable value comes out null
    winners = usable.groupBy("dup_key").agg(best("word_hindi"), best("definition_en"), best("confidence_score"))
    # the group's size and its sources (few by nature) in one pass
    named = F.when(F.col("sources").isNull(), F.array("source")).otherwise(F.col("sources"))
    rows = base.select("dup_key", F.posexplode_outer(named).alias("pos", "s"))
    groups = rows.groupBy("dup_key").agg(F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0)).alias("rows"), F.sort_array(F.collect_set(F.nullif(strip(F.col("s")), F.lit("")))).alias("sources"))
    return groups.where("rows > 1").join(winners, "dup_key", "left").select("dup_key", "word_hindi", "definition_en", "confidence_score", "sources")


def survivor_items(records: DataFrame) -> DataFrame:
    """best_records as (dup_key, field, item): one row per value kept; none for null fields."""
    one = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("item")) for f in ("word_hindi", "definition_en", "confidence_score")])
    many = F.transform("sources", lambda s: F.struct(F.lit("sources").alias("field"), s.alias("item")))
    return records.select("dup_key", F.explode(F.concat(one, many)).alias("x")).select("dup_key", "x.field", "x.item").where(F.col("item").isNotNull())
