"""The front door end to end: build from files, write, read, look up, search, audit."""

import json

import pytest
from pyspark.sql import functions as F

from lexmill import __main__ as cli
from lexmill.lexicon import Lexicon
from lexmill.operators import search, stats
from lexmill.operators.graph import clean_relations
from lexmill.operators.index import SearchIndex
from lexmill.sinks import writers


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    at = tmp_path_factory.mktemp("raw")
    for d in ("synsets", "lines", "more"):
        (at / d).mkdir()
    (at / "synsets" / "all.hindi").write_text('12\tघर,मकान\ta place to live:"ghar bada hai"\tnoun\n13\tचोर\ta thief\tnoun\n', encoding="utf-8")
    word = {"word": "घर", "lang_code": "hi", "pos": "noun", "forms": [{"form": "ghar", "tags": ["romanization"]}], "senses": [{"glosses": ["A place  to live"], "examples": ["naya ghar"]}, {"glosses": ["house, home"]}]}
    (at / "lines" / "a.jsonl").write_text(json.dumps(word, ensure_ascii=False) + "\nbroken\n", encoding="utf-8")
    (at / "more" / "x.csv").write_text("hindi,english,roman\nआम,mango,aam\n", encoding="utf-8")
    (at / "overrides.json").write_text(json.dumps({"मकान": "makaan"}), encoding="utf-8")
    (at / "terms.json").write_text(json.dumps({"words": ["chor"]}), encoding="utf-8")
    return at


@pytest.fixture(scope="module")
def lex(spark, sources):
    return Lexicon.from_sources(spark, str(sources / "synsets"), str(sources / "lines"), str(sources / "more"), str(sources / "overrides.json"), str(sources / "terms.json")).build()


def test_build(lex):
    rows = {r.word_hinglish_roman: r for r in lex.entries.collect()}
    assert set(rows) == {"ghar", "makaan", "chor", "aam"}
    g = rows["ghar"]
    # the second dictionary's equal definition was merged and dropped; its other sense joined by roman; the leader's source counts
    assert (g.id, g.source, g.sources, g.definition, g.definition_hi) == ("HIN-00001", "WordNet", ["WordNet", "Wiktionary"], "a place to live", "घर")
    assert g.confidence_score == round(0.95 * 0.75 * 1.03 * 1.05, 4) and rows["makaan"].confidence_score == round(0.95 * 1.03, 4)
    assert rows["chor"].severity_score == 1.0 and rows["chor"].confidence_score == 0.3 and rows["aam"].source == "supplemental/x"
    assert lex.excluded.count() == 1 and lex.safe.count() == 3


def test_search_by_scan_and_index(lex, tmp_path):
    indexed = lex.indexed(str(tmp_path / "i"))
    for one in (lex, indexed):
        assert [r.word_hinglish_roman for r in one.lookup("GHAR ").collect()] == ["ghar"] and one.lookup("nothing").count() == 0
        assert [r.word_hinglish_roman for r in one.lookup("aka").collect()] == ["makaan"]
        assert [r.word_hinglish_roman for r in one.search("place live", "fts").collect()] == [r.word_hinglish_roman for r in lex.search("place live", "fts").collect()]
        assert {r.word_hinglish_roman for r in one.search("ma", "prefix").collect()} == {"makaan", "aam"}
        assert one.search("chor", "fts", safe=True).count() == 0 and one.lookup("chor", safe=True).count() == 0
        with pytest.raises(ValueError):
            one.lookup("x", limit=0)
    assert [r.word_hinglish_roman for r in indexed.lookup("chor", mode="last").collect()] == ["chor"]
    assert indexed.search("", "fts").count() == 0 and lex.best_match("ghar").first().exact
    with pytest.raises(ValueError):
        lex.search("x", "typo")


def test_index_prunes(spark, lex, tmp_path):
    index = SearchIndex.build(lex.entries, str(tmp_path / "i"), ["definition"], "ord")
    plan = index.exact("ghar")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(b" in plan and "EqualTo(key,ghar)" in plan
    empty = SearchIndex.build(lex.entries.limit(0), str(tmp_path / "e"), ["definition"], "ord")
    assert empty.search("house").count() == 0 and empty.lookup("ghar").count() == 0


def test_artifacts(spark, lex, tmp_path):
    lex.write_all(str(tmp_path), "1", "2024-01-01")
    read = lambda n: spark.read.json(f"{tmp_path}/{n}")
    assert read("full").count() == 4 and read("safe").count() == 3 and read("excluded_meta").first().total_excluded == 1
    m = read("full_meta").first()
    assert (m.total_entries, m.safe_entries, m.excluded_entries, m.source["WordNet"]) == (4, 3, 1, 3)
    text = "".join(p.read_text() for p in sorted((tmp_path / "words").glob("part-*")))
    assert text.split() == ["aam", "ghar", "makaan"]
    compact = "".join(p.read_text() for p in (tmp_path / "full_compact").glob("part-*"))
    assert '""' not in compact and "[]" not in compact
    assert writers.export_searchable(lex.entries, str(tmp_path / "x"), ["definition"], "ord") == 3


def test_enriched_and_seed(spark, tmp_path):
    e = spark.createDataFrame([("a", 1, "घर", "ghar", ["iwn-1"]), ("b", 2, "मकान", "makaan", ["iwn-1"]), ("b", 3, "मकान", "makan", ["iwn-1"])], "id string, rec_id long, word_hindi string, word_hinglish_roman string, synsets array<string>")
    edges = spark.createDataFrame([(1, 2)], "child_synset int, parent_synset int")
    rel = Lexicon(e, ord_col="rec_id").enrich(edges)
    writers.write_enriched(e, rel, str(tmp_path))
    got = {r.id: r for r in spark.read.json(f"{tmp_path}/enriched").collect()}
    assert [x.id for x in got["a"].same_synset] == ["b"]
    links = spark.createDataFrame([("a", "b", "same_synset"), ("a", "zz", "broader"), ("a", "a", "broader")], "entry_id string, related_entry_id string, relation_type string")
    assert writers.seed_tables(e, links, str(tmp_path / "s")) == {"entries": 2, "related_words": 1}
    best, related = Lexicon(e, ord_col="rec_id").word_page("ghar", clean_relations(links, e))
    assert best.count() == 1 and [r.related_entry_id for r in related.collect()] == ["b"]


def test_audits_and_notes(lex):
    tables = lex.audit()
    assert tables["transliteration.summary"].first().covered == 1 and tables["merge.summary"].first().merged == 1
    assert set(lex.audit("merge")) == {"merge.summary", "merge.source_sets"}
    with pytest.raises(ValueError):
        lex.audit("nothing")
    notes = [r.line for r in stats.release_notes(lex.meta(), "T").orderBy("place").collect()]
    assert notes[0].startswith("# T") and notes[1] == "- WordNet: 3" and "Parts of speech" in notes[3] and len(notes) == 5


def test_edge_lookup(spark):
    e = spark.createDataFrame([(1, "घर", "ghar", "Noun", "a"), (2, "घरवाला", "ghar", None, "a"), (3, "x", "gharana", " ", "b")], "rec_id long, word_hindi string, word_hinglish_roman string, part_of_speech string, source string")
    assert [r.rec_id for r in search.edge_lookup(e, "GHAR").collect()] == [1, 2] and [r.rec_id for r in search.edge_lookup(e, "harA").collect()] == [3] and search.edge_lookup(e, " ").count() == 0
    got = {(r.facet, r.value): r.n for r in search.edge_facets(e, "NOUN").collect()}
    assert got == {("pos", "noun"): 1, ("pos", "other"): 2, ("source", "a"): 1}


def test_command_line(spark, sources, tmp_path, capsys):
    out = str(tmp_path / "lex")
    cli.main(["build", "--synset", str(sources / "synsets"), "--jsonl", str(sources / "lines"), "--overrides", str(sources / "overrides.json"), "--out", out])
    cli.main(["lookup", out, "ghar"])
    cli.main(["search", out, "thief"])
    cli.main(["stats", out])
    cli.main(["audit", out, "--audits", "confidence"])
    said = capsys.readouterr().out
    assert "HIN-00001" in said and "# confidence.buckets" in said and "a thief" in said
    with pytest.raises(SystemExit):
        cli.main(["nothing"])


def test_severity_of_all_texts(spark):
    from lexmill.operators.safety import score_severity

    rows = spark.createDataFrame([("a", "b", ["x bad."]), ("a", None, None), ("badly", "b", [])], "w string, g string, e array<string>")
    assert [r.s for r in rows.select(score_severity(F.col("w"), F.col("g"), F.array_join("e", " "), ["bad"]).alias("s")).collect()] == [1.0, 0.0, 0.0]
