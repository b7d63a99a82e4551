import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.operators.dedup import dedup_by_definition, dedup_by_roman
from lexmill.operators.merge import fuzzy_best, merge_dictionaries
from lexmill.sinks.writers import assign_ids, upsert

SCHEMA = "rec_id long, word_hindi string, word_hinglish_roman string, definition string, part_of_speech string, example_sentence string, source string, sources array<string>, confidence_score double"


def lang(s):
    dev, lat = re.search("[ऀ-ॿ]", s), re.search("[A-Za-z]", s)
    return "mixed" if dev and lat else "hi" if dev else "en"


def fold(rows):
    """Row by row: the leader is replaced by a better row; the kept one takes over what it lacks."""
    score = lambda e: {"en": 200, "mixed": 100, "hi": 0}[lang(e["d"])] + len(e["d"]) + 100 * (e["src"][0] == "WordNet") + 50 * bool(e["ex"]) - 500 * (not e["d"])
    out = {}
    for r in rows:
        if not r[2]:
            continue
        e = {"ord": r[0], "d": r[3] or "", "pos": r[4] or "", "ex": r[5] or "", "src": [r[6]], "all": r[7] or [r[6]], "n": 1}
        old = out.get(r[2])
        if old is None:
            out[r[2]] = e
            continue
        a, b = (e, old) if score(e) > score(old) else (old, e)
        a.update(ex=a["ex"] or b["ex"], pos=a["pos"] or b["pos"], all=list(dict.fromkeys(a["all"] + b["all"])), n=old["n"] + 1)
        out[r[2]] = a
    return {k: (e["ord"], e["n"], e["ex"], e["pos"], e["all"]) for k, e in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_fold_is_exact_and_needs_no_order(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["घर", None]), r.choice(["a", "b", "c", "", None]), r.choice(["", None, "घर", "x" * r.randint(1, 60), "घर x" * r.randint(1, 9)]), r.choice(["noun", "", None]), r.choice(["", None, f"ex{i}"]) if r.random() < 0.4 else "", r.choice(["WordNet", "Wiktionary"]), r.choice([None, ["s1"], ["s1", "s2"]]), 0.5) for i in range(300)]
    for parts in (1, 7):
        df = spark.createDataFrame(r.sample(rows, len(rows)), SCHEMA).repartition(parts)
        got = {x.roman: (x.leader, x.n_rows, x.example_sentence, x.part_of_speech, x.sources) for x in dedup_by_roman(df).collect()}
        assert got == fold(rows)


def test_empty_and_single(spark):
    assert dedup_by_roman(spark.createDataFrame([], SCHEMA)).count() == 0
    one = dedup_by_roman(spark.createDataFrame([(1, "घर", "ghar", "", None, None, "s", None, None)], SCHEMA)).collect()[0]
    assert (one.leader, one.definition_lang, one.definition_en, one.definition_hi, one.sources) == (1, "en", "", None, ["s"])


def test_definition_dedup_joins_sources(spark):
    rows = [(1, "घर", "g", "A  house", "", "", "WordNet", None, 0.2), (2, "घर", "g", "a house", "", "ex", "Wiktionary", None, 0.9), (3, "घर", "g", "a house", "", "e2", "Word", None, None)]
    x = dedup_by_definition(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.leader, r.n_rows, r.sources, r.example_sentence, r.confidence) for r in x] == [(1, 3, "WordNet+Wiktionary", "ex", 0.9)]


def test_merge_first_match(spark):
    p = spark.createDataFrame([(1, "घर", "", "a", "", "", "p", None, 0.0), (2, "घर", "", "a", "", "own", "p", None, 0.0)], SCHEMA)
    s = spark.createDataFrame([(5, "घर", "", "A ", "", "x", "s", None, 0.0), (6, "घर", "", "b", "", None, "s", None, 0.0), (7, "घर", "", "a", "", "y", "s", None, 0.0)], SCHEMA)
    lists = lambda df, x: df.withColumns({"synsets": F.array(F.lit("s1"), F.concat(F.lit("s"), F.col("rec_id").cast("string"))), "all_examples": F.when(F.col("rec_id") == 1, F.array(F.lit("own"))).otherwise(F.array(F.lit(x), F.lit("")))})
    m = merge_dictionaries(lists(p, "o"), lists(s, "x").withColumn("tags", F.lit("t")))
    got = sorted((r.rec_id, r.origin, r.n_merged, r.example_sentence, r.synsets, r.all_examples, r.tags) for r in m.collect())
    assert got == [
        (1, "primary", 2, "x", ["s1", "s5", "s7"], ["own", "x"], None), (2, "primary", 0, "own", ["s1", "s2"], ["o", ""], None), (6, "secondary", 0, "", ["s1", "s6"], ["x", ""], "t"),
    ]
    assert merge_dictionaries(p.limit(0), s.limit(0)).count() == 0


def test_fuzzy_best(spark):
    t = spark.createDataFrame([(1, "कंबल", "kanbal"), (2, "xyzxyz", "q"), (3, None, None)], "rec_id long, word_hindi string, word_hinglish_roman string")
    c = spark.createDataFrame([(7, "कंबल", "kambal"), (8, "कंबल", "kambal"), (9, "पानी", "paani")], "rec_id long, word_hindi string, word_hinglish_roman string")
    assert [tuple(r)[:2] for r in fuzzy_best(t, c).collect()] == [(1, 7)]


def test_fuzzy_query_reads_every_source(spark, tmp_path):
    from lexmill.queries import QUERIES

    rows = [(1, "कंबल", "kanbal", "WordNet"), (2, "कंबल", "kambal", "Wiktionary"), (3, "कंबल", "kambal", None), (4, "कंबल", "kambal", "supplemental_a")]
    spark.createDataFrame(rows, "rec_id long, word_hindi string, word_hinglish_roman string, source string").write.parquet(f"{tmp_path}/entries.parquet")
    assert sorted(tuple(r)[:2] for r in QUERIES["e02_fuzzy_best"](spark, str(tmp_path)).collect()) == [(2, 1), (3, 1), (4, 1)]


def test_ids_and_upsert(spark):
    df = spark.range(0, 1000).selectExpr("id * 3 as rec_id").repartition(5)
    got = {r.rec_id: r.id for r in assign_ids(df).collect()}
    assert got == {i * 3: f"HIN-{i + 1:05d}" for i in range(1000)}
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, rec_id long, v string")
    new = spark.createDataFrame([("a", 1, "z"), ("c", 3, None)], "id string, rec_id long, v string")
    assert sorted(map(tuple, upsert(old, new, "rec_id").collect())) == [("a", 1, "z"), ("b", 2, "y"), ("c", 3, None)]


def test_fuzzy_loses_no_pair(spark):
    from lexmill.functions.fuzzy import indel_ratio

    r = random.Random(1)
    word = lambda: "".join(r.choice("aghrkl") for _ in range(r.randint(1, 11)))
    a = [(i, word(), word()) for i in range(60)]
    b = [(100 + i, word(), word()) for i in range(60)] + [(200 + i, a[i][1][:2] + "x" + a[i][1][2:], word()) if i % 2 else (200 + i, word(), a[i][2][:-1] or "q") for i in range(40)]
    want = {}
    for o, h, s in a:
        scored = [(-max(x, y, 0.7 * x + 0.3 * y), p) for p, h2, s2 in b for x, y in [(indel_ratio(h, h2), indel_ratio(s, s2))]]
        best, p = min(scored)
        if -best >= 85:
            want[o] = (p, round(-best, 6))
    schema = "rec_id long, word_hindi string, word_hinglish_roman string"
    got = {x.target: (x.candidate, round(x.score, 6)) for x in fuzzy_best(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    assert got == want and len(got) > 10


def test_fuzzy_broadcasts_nothing(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("aghrkl") for _ in range(r.randint(5, 20)))
    rows = [(i, word(), word()) for i in range(200)]
    more = [(1000 + i, h[:3] + h[4:], s) for i, h, s in rows]
    a, b = (spark.createDataFrame(x, "rec_id long, word_hindi string, word_hinglish_roman string") for x in (rows, more))
    got = fuzzy_best(a, b)
    want = sorted(map(tuple, got.collect()))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString() and len(want) == 200
    # cells of a few rows give the same
    assert sorted(map(tuple, fuzzy_best(a, b, cell_rows=7).collect())) == want


def test_near_pairs_loses_none():
    from lexmill.functions.fuzzy import indel_ratio, near_pairs

    r, found = random.Random(3), 0
    for n, m, threshold in ((1, 1, 85), (8, 10, 85), (11, 14, 85), (16, 16, 85), (20, 21, 85), (14, 14, 70), (30, 27, 85), (70, 71, 85)):
        a = list({"".join(r.choice("abcdefgh") for _ in range(n)) for _ in range(160)})
        z = list({w[:2] + "i" * (m - n if m != n else 1) + w[2 + (n - m if m < n else m == n) :] for w in a if n > 2} | {"".join(r.choice("abcdefgh") for _ in range(m)) for _ in range(10)})
        want = set()
        for v in a:
            scored = [(indel_ratio(v, w), w) for w in z]
            want |= {(v, w, s) for s, w in scored if s == max(scored)[0] >= threshold}
        got = near_pairs(a, z, threshold)
        assert set(got) == want and len(got) == len(want)
        found += len(want)
    assert found > 500
