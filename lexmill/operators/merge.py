"""Merging a second dictionary into a first, and fuzzy matching."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.fuzzy import CELL_ROWS, EXACT_LETTERS, near_pairs, ratio
from lexmill.functions.text import definition_hash, normalize_hindi


def merge_dictionaries(primary: DataFrame, secondary: DataFrame, ord_col: str = "rec_id") -> DataFrame:
    """All primary rows, then the secondary rows that match none, with all their columns, ``origin`` and ``n_merged``.

    A secondary row is matched to the first primary row of equal normalised
    headword and definition, and dropped; that row takes its synsets and
    examples (distinct, its own first, then in order of the secondaries) and, if
    it has no example sentence, the first that begins a secondary's list of examples. Columns of
    one side only are null on the other. The first row per key is found, and
    what the matched rows give is aggregated, before anything is joined, so no
    key is collected but for the distinct items a row takes.
    """

    def keyed(df: DataFrame) -> DataFrame:
        for c, kind in (("synsets", "array<string>"), ("all_examples", "array<string>"), ("example_sentence", "string")):
            df = df if c in df.columns else df.withColumn(c, F.lit(None).cast(kind))
        return df.withColumns({"_h": normalize_hindi(F.coalesce("word_hindi", F.lit(""))), "_d": definition_hash(F.coalesce("definition", F.lit(""))), "_o": F.col(ord_col)})

    p, s = keyed(primary), keyed(secondary)
    firsts = p.groupBy("_h", "_d").agg(F.min("_o").alias("_o"))
    example = F.nullif(F.try_element_at("all_examples", F.lit(1)), F.lit(""))
    given = s.groupBy("_h", "_d").agg(F.count("*").alias("n_merged"), F.min(F.when(example.isNotNull(), F.struct(F.col("_o").alias("o"), example.alias("e")))).alias("_e"))
    gains = firsts.join(given, ["_h", "_d"]).select(F.col("_o").alias("_p"), "n_merged", F.col("_e.e").alias("_x"))
    items = s.select("_h", "_d", "_o", F.explode(F.array(F.struct(F.lit(0).alias("f"), F.col("synsets").alias("v")), F.struct(F.lit(1).alias("f"), F.col("all_examples").alias("v")))).alias("x"))
    items = items.select("_h", "_d", "_o", "x.f", F.posexplode("x.v").alias("i", "v")).where((F.col("f") == 0) | (F.coalesce("v", F.lit("")) != ""))
    once = items.join(firsts.select("_h", "_d"), ["_h", "_d"], "left_semi").groupBy("_h", "_d", "f", "v").agg(F.min(F.struct("_o", "i")).alias("at"))
    lists = once.groupBy("_h", "_d").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("f") == f, F.struct("at", "v")))), lambda x: x["v"]).alias(c) for f, c in ((0, "_s"), (1, "_xs"))])
    lists = firsts.join(lists, ["_h", "_d"]).select(F.col("_o").alias("_q"), "_s", "_xs")
    none = F.array().cast("array<string>")
    kept = p.join(gains, F.col("_o") == F.col("_p"), "left").join(lists, F.col("_o") == F.col("_q"), "left").withColumns({
        "origin": F.lit("primary"), "n_merged": F.coalesce("n_merged", F.lit(0)).cast("long"),
        "synsets": F.array_union(F.coalesce("synsets", none), F.coalesce("_s", none)), "all_examples": F.array_union(F.coalesce("all_examples", none), F.coalesce("_xs", none)),
        "example_sentence": F.coalesce(F.nullif("example_sentence", F.lit("")), "_x", F.lit("")),
    }).drop("_p", "_q", "_s", "_xs", "_x")
    rest = s.join(firsts.select("_h", "_d"), ["_h", "_d"], "left_anti").withColumns({"origin": F.lit("secondary"), "n_merged": F.lit(0).cast("long"), "example_sentence": F.coalesce("example_sentence", F.lit(""))})
    return kept.drop("_h", "_d", "_o").unionByName(rest.drop("_h", "_d", "_o"), allowMissingColumns=True)


def fuzzy_best(targets: DataFrame, candidates: DataFrame, threshold: float = 85.0, ord_col: str = "rec_id", cell_rows: int = CELL_ROWS) -> DataFrame:
    """(target, candidate, score): for each target the best candidate of a score of at least ``threshold``.

    score is the greatest of the headwords' ratio h, the romans' ratio r, and
    0.7 h + 0.3 r. Ratios count insertions and deletions only; an empty spelling is like none. Ties: the lower
    candidate. A mean is no more than the greater of its two (but for the last bit where
    they are equal), so the best candidate is one of the best by headword alone or by roman
    alone. Spellings meet in cells of (length of the target's, length of the candidate's),
    large ones cut into ``cell_rows`` rows of each side, and a cell's near pairs are found in
    numpy (``near_pairs``). No pair is lost, a spelling goes to as many cells as there are lengths near
    its own, and nothing goes through the driver but the lengths that fill more than one cell.
    """

    def distinct(df: DataFrame) -> DataFrame:
        return df.select(normalize_hindi(F.coalesce("word_hindi", F.lit(""))).alias("h"), F.lower(F.trim(F.coalesce("word_hinglish_roman", F.lit("")))).alias("r"), F.col(ord_col).cast("long").alias("o"))

    def by_field(df: DataFrame) -> DataFrame:
        """(f, w, *columns): each row once by its headword and once by its roman, if it has one."""
        return df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("w")) for i, c in enumerate("hr")])).alias("x"), "*").select("x.f", "x.w", *df.columns).where("w <> ''")

    t = distinct(targets)
    spelled, cand = t.select("h", "r").distinct(), distinct(candidates).groupBy("h", "r").agg(F.min("o").alias("o"))
    loss = 1 - threshold / 100
    reach = (1 + loss) / (1 - loss)  # the greatest quotient of the two lengths

    def band(n: Column) -> Column:
        """The length; of long spellings, a range of lengths."""
        return F.when(n <= EXACT_LETTERS, n).otherwise(EXACT_LETTERS + 1 + F.floor(F.log(n / EXACT_LETTERS) * 4)).cast("int")

    words = [by_field(df.select("h", "r")).select("f", "w", F.length("w").alias("n")).distinct().withColumn("b", band(F.col("n"))) for df in (spelled, cand)]
    sizes = [df.groupBy("f", "b").agg(F.count("*").alias("k")).where(F.col("k") > cell_rows).select(F.lit(i).alias("side"), "*") for i, df in enumerate(words)]
    full = {(x.side, x.f, x.b): -(-x.k // cell_rows) for x in sizes[0].unionByName(sizes[1]).collect()}

    def slices(side: int, b: str) -> Column:
        """Number of parts of a side's spellings of one field and band."""
        out = F.lit(1)
        for (s, f, k), n in full.items():
            if s == side:
                out = F.when((F.col("f") == f) & (F.col(b) == k), n).otherwise(out)
        return out

    def cells(side: int, own: str, other: str, part: str, parts: str) -> DataFrame:
        n = F.col("n")
        near = F.sequence(band(F.greatest(F.ceil(n / reach - 1e-9), F.lit(1))), band(F.floor(n * reach + 1e-9)))
        x = words[side].select("f", "w", F.col("b").alias(own), F.pmod(F.xxhash64("w"), slices(side, "b")).cast("int").alias(part), F.explode(near).alias(other))
        return x.withColumn(parts, F.explode(F.sequence(F.lit(0), slices(1 - side, other) - 1)))

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lengths: list[dict[int, list[str]]] = [{}, {}]
        for side, words in zip(lengths, (left, right), strict=True):
            for w in words.column("w").to_pylist():
                side.setdefault(len(w), []).append(w)
        got = [x for a in lengths[0].values() for z in lengths[1].values() for x in near_pairs(a, z, threshold)]
        return pa.table([pa.array([key[0].as_py()] * len(got), pa.int32()), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.float64())], ["f", "w", "z", "s"])

    key = ["f", "n", "m", "i", "j"]
    met = cells(0, "n", "m", "i", "j").groupBy(*key).cogroup(cells(1, "m", "n", "j", "i").groupBy(*key)).applyInArrow(meet, "f int, w string, z string, s double")
    top = met.withColumn("most", F.max("s").over(Window.partitionBy("f", "w"))).where("s = most").select("f", "w", "z")
    # merge joins: a broadcast would go through the driver
    pairs = top.hint("merge").join(by_field(spelled), ["f", "w"]).select("f", "z", "h", "r")
    pairs = pairs.hint("merge").join(by_field(cand).select("f", F.col("w").alias("z"), F.col("h").alias("zh"), F.col("r").alias("zr"), "o"), ["f", "z"])
    sh, sr = (F.when(F.col(a) != "", ratio(F.col(a), F.col(z))).otherwise(0.0) for a, z in (("h", "zh"), ("r", "zr")))
    scored = pairs.select("h", "r", "o", sh.alias("sh"), sr.alias("sr")).withColumn("s", F.greatest("sh", "sr", F.col("sh") * 0.7 + F.col("sr") * 0.3)).where(F.col("s") >= threshold)
    best = scored.groupBy("h", "r").agg(F.max(F.struct("s", -F.col("o"))).alias("m")).select("h", "r", F.col("m.s").alias("score"), (-F.col("m.col2")).alias("candidate"))
    return t.hint("merge").join(best, ["h", "r"]).select(F.col("o").alias("target"), "candidate", "score")
