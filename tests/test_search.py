from lexmill.operators import graph, search, stats

SCHEMA = "rec_id long, id string, word_hindi string, word_hinglish_roman string, definition string, part_of_speech string, source string, confidence_score double, severity_score double"


def lexicon(spark):
    rows = [
        (1, "a", "घर", "ghar", "a house", "noun", "W", 0.9, 0.0), (2, "b", "घरेलू", "gharelu", "of the ghar", "adj", "W", 0.8, None), (3, "c", "x", "test_name", "100% sure", "noun", "V", 0.5, float("nan")),
        (4, "d", "y", "testAname", "else", "", "V", None, 0.9), (5, "e", None, None, None, None, None, None, None), (6, "f", "घर", "ghar", "old house house", "noun", "V", 0.9, 0.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return [r.id for r in df.collect()]


def test_tiers_and_filters(spark):
    e = lexicon(spark)
    assert [(r.id, r.tier) for r in search.tier_search(e, "GHAR").collect()] == [("a", 95), ("f", 95), ("b", 75)]
    assert [(r.id, r.tier) for r in search.tier_search(e, "घर").collect()] == [("a", 100), ("f", 100), ("b", 80)]
    assert ids(search.tier_search(e, "test_n")) == ["c"] and ids(search.tier_search(e, "100%")) == ["c"]
    assert ids(search.tier_search(e, "testa", safe=True)) == [] and ids(search.tier_search(e, " ")) == []
    assert ids(search.tier_search(e, "ghar", min_confidence=0.85)) == ["a", "f"] and ids(search.tier_search(e, "ghar", limit=1)) == ["a"]


def test_lookup_falls_back(spark):
    e = lexicon(spark)
    assert ids(search.lookup(e, "Ghar")) == ["a", "f"] and ids(search.lookup(e, "hous")) == ["a", "f"] and ids(search.lookup(e, "none such")) == []
    assert ids(search.best_match(e, "घरे")) == ["b"] and ids(search.best_match(e, "")) == []


def test_suggest_and_index(spark):
    e = lexicon(spark)
    assert [(r.roman, r.tier) for r in search.suggest(e, "ghar").collect()] == [("ghar", 0), ("gharelu", 2)]
    assert {r.key: r.id for r in search.hash_index(e).collect()}["ghar"] == "f"
    assert {(r.facet, r.value): r.n for r in search.facets(e).collect()}[("pos", "noun")] == 3


def test_full_text(spark):
    e = lexicon(spark)
    assert ids(search.full_text(e, "house old", ["definition"])) == ["f"]
    assert set(ids(search.full_text(e, "hou", ["definition"], prefix=True))) == {"a", "f"}
    assert ids(search.full_text(e, "", ["definition"])) == [] and ids(search.full_text(e.limit(0), "x", ["definition"])) == []
    assert ids(search.full_text(e, "else", ["definition"], limit=1, safe=True, edge_parity=True)) == []


def test_same_synset_caps_and_order(spark):
    rows = [(i, f"n{i:02d}", ["s"]) for i in range(30)] + [(40, "z", ["t", "t"]), (41, "z", ["t"]), (42, "q", None)]
    got = graph.same_synset(spark.createDataFrame(rows, "rec_id long, id string, synsets array<string>")).collect()
    per = {}
    for r in got:
        per.setdefault(r.entry_id, []).append((r["rank"], r.related_entry_id))
    assert len(per) == 30 and all(len(v) == 20 for v in per.values())
    assert [x for _, x in sorted(per["n03"])] == [f"n{i:02d}" for i in range(21) if i != 3]


def test_relations(spark):
    e = spark.createDataFrame([(1, "a", ["iwn-1"]), (2, "b", ["iwn-2"]), (3, "c", ["iwn-2"])], "rec_id long, id string, synsets array<string>")
    h = spark.createDataFrame([(1, 2), (1, 2), (None, 1)], "child_synset int, parent_synset int")
    got = sorted((r.entry_id, r.related_entry_id, r.relation_type) for r in graph.broader_narrower(e, h).collect())
    assert got == [("a", "b", "broader"), ("a", "c", "broader"), ("b", "a", "narrower"), ("c", "a", "narrower")]
    r = spark.createDataFrame([("a", "b", " Broader"), ("b", "a", "narrower"), ("a", "a", "broader"), ("a", "zz", "broader"), ("a", "c", "broader"), (None, "a", None)], "entry_id string, related_entry_id string, relation_type string")
    clean = graph.clean_relations(r, e)
    assert clean.count() == 3 and [x.related_entry_id for x in graph.one_sided(clean).collect()] == ["c"]
    assert [x.id for x in graph.orphans(r, e).collect()] == ["zz"]


def test_stats(spark):
    e = lexicon(spark)
    assert {r.metric: r.n for r in stats.stats(e, e.limit(0)).collect()} == {"total": 6, "safe": 5, "toxic": 1, "relations": 0}
    bars = {r.value: len(r.bar) for r in stats.histogram_bars(e.groupBy(e.source.alias("value")).count().withColumnRenamed("count", "n")).collect()}
    assert bars["V"] == 20 and bars[None] == 6
