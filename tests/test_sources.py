import json

import pytest

from lexmill.operators import safety
from lexmill.operators.safety import flag_entries, score_texts
from lexmill.sinks import writers
from lexmill.sources import dictionaries as d
from lexmill.streaming.upserts import _versions, latest, stream_upserts


def test_synsets(spark, tmp_path):
    (tmp_path / "all.hindi").write_text('12\tघर, मकान\trehne ki jagah:"e one"  /  "e two"\tnoun\n\nbad\n x\ta\tb\tc\n13\tआम\tfruit\tnoun\n14\tजल\tpani\t\n', encoding="utf-8")
    rows = d.read_synsets(spark, str(tmp_path / "all.hindi")).orderBy("synset_id", "pos_in_synset").collect()
    assert [(r.synset_id, r.word_hindi, r.definition, r.all_examples, r.head_word, r.id) for r in rows] == [
        (12, "घर", "rehne ki jagah", ["e one", "e two"], "घर", "WN-12"), (12, "मकान", "rehne ki jagah", ["e one", "e two"], "घर", "WN-12"), (13, "आम", "fruit", [], "आम", "WN-13"),
    ]


def test_dictionary_lines(spark):
    lines = [
        {"word": "घर", "lang_code": "hi", "pos": "noun", "forms": [{"form": "x", "tags": []}, {"form": "ghar", "tags": ["romanization"]}], "senses": [{"glosses": ["house"], "examples": [{"text": "t", "translation": "u"}], "tags": ["masc"], "synonyms": [{"word": "मकान"}]}, {"glosses": []}, {"raw_glosses": ["(old) home"], "examples": ["plain"]}]},
        {"word": "x", "lang_code": "mr", "senses": [{"glosses": ["y"]}]}, {"word": "r", "lang_code": "hi", "redirect": "q", "senses": [{"glosses": ["y"]}]}, {"word": "n", "lang_code": "hi"},
    ]
    df = spark.createDataFrame([(i, json.dumps(x, ensure_ascii=False)) for i, x in enumerate(lines)] + [(8, "{broken"), (9, ""), (10, None), (11, json.dumps(lines[0]) + ","), (12, json.dumps(lines[0]) + " {}")], "line_no long, line string")
    e = d.dictionary_entries(d.parse_dictionary_lines(df)).orderBy("id").collect()
    assert [(r.id, r.word_hinglish_roman, r.definition, r.example_sentence, r.synonyms) for r in e] == [("WK-घर-noun-0", "ghar", "house", "t (u)", ["मकान"]), ("WK-घर-noun-2", "ghar", "home", "plain", None)]


@pytest.mark.parametrize(("name", "body"), [("a.csv", "Hindi,English,Roman\nघर,house,ghar\n,,\n"), ("b.json", '[{"word_hindi": "घर", "definition": "house", "word_hinglish_roman": "ghar"}, {"word_hindi": " "}]'), ("c.jsonl", '{"hindi": "घर", "meaning": "house", "roman": "ghar"}\n{"hindi": ""}\n')])
def test_supplemental(spark, tmp_path, name, body):
    (tmp_path / name).write_text(body, encoding="utf-8")
    r = d.read_supplemental(spark, str(tmp_path / name)).collect()
    assert [(x.word_hindi, x.definition, x.word_hinglish_roman, x.source) for x in r] == [("घर", "house", "ghar", f"supplemental/{name[0]}")]


def test_header_and_name_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("word, HINDI ,definition,english,eng\nx,घर,d,house,z\n", encoding="utf-8")
    assert [(r.word_hindi, r.definition) for r in d.read_supplemental(spark, str(tmp_path / "a.csv")).collect()] == [("घर", "house")]
    (tmp_path / "b.json").write_text('[{"word_hindi": "", "hindi": "घर", "english": "house", "meaning": "home"}]', encoding="utf-8")
    assert [(r.word_hindi, r.definition) for r in d.read_supplemental(spark, str(tmp_path / "b.json")).collect()] == [("घर", "home")]
    (tmp_path / "c.json").write_text('{"word": "one"}', encoding="utf-8")
    assert d.read_supplemental(spark, str(tmp_path / "c.json")).count() == 0


def test_folders(spark, tmp_path):
    (tmp_path / "s").mkdir(), (tmp_path / "iwn_data" / "synsets").mkdir(parents=True)
    (tmp_path / "s" / "b.csv").write_text("hindi,english\nक,k\nख,kh\n", encoding="utf-8")
    (tmp_path / "s" / "a.jsonl").write_text('{"word": "घर", "meaning": "house"}\nbroken\n{"word": "आम", "meaning": "mango"}\n', encoding="utf-8")
    (tmp_path / "s" / "c.txt").write_text("no")
    got = [(r.id, r.word_hindi, r.source) for r in d.read_supplemental_folder(spark, str(tmp_path / "s")).orderBy("place").collect()]
    assert got == [("SUP-a-0", "घर", "supplemental/a"), ("SUP-a-1", "आम", "supplemental/a"), ("SUP-b-2", "क", "supplemental/b"), ("SUP-b-3", "ख", "supplemental/b")]
    assert d.read_supplemental_folder(spark, str(tmp_path / "none")) is None
    (tmp_path / "iwn_data" / "synsets" / "all.noun").write_text("12\tGhar\tg\tnoun\n", encoding="utf-8")
    assert [(r.word_hindi, r.word_hinglish_roman) for r in d.read_synset_folder(spark, str(tmp_path)).collect()] == [("Ghar", "ghar")]
    with pytest.raises(FileNotFoundError):
        d.read_dictionary_folder(spark, str(tmp_path))


def test_small_readers(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("# c\n1\t7\thome\tघर\n2\t7\thouse\tघर\nx\n", encoding="utf-8")
    assert [tuple(r) for r in d.read_linkage(spark, str(tmp_path / "l.tsv")).collect()] == [(7, "house")]
    (tmp_path / "h.tsv").write_text("1\t2\n1\n3\t4\t5\n", encoding="utf-8")
    assert [tuple(r) for r in d.read_hypernymy(spark, str(tmp_path / "h.tsv")).collect()] == [(1, 2)]
    (tmp_path / "w.json").write_text('{"words": ["a", "b"]}')
    assert [r.term for r in d.read_terms(spark, str(tmp_path / "w.json")).collect()] == ["a", "b"]
    (tmp_path / "o.json").write_text('{"घर": "ghar"}', encoding="utf-8")
    assert [tuple(r) for r in d.read_overrides(spark, str(tmp_path / "o.json")).collect()] == [("घर", "ghar")]


def test_keyboard_file(spark, tmp_path):
    rows = [(1, " Ghar ", 0.5, 0.0, "noun"), (2, "ghar", 0.9, 0.0, "verb"), (3, "bad", 0.9, 0.9, ""), (4, "घर", 0.9, 0.0, ""), (5, None, None, None, None)]
    e = spark.createDataFrame(rows, "rec_id long, word_hinglish_roman string, confidence_score double, severity_score double, part_of_speech string")
    k = writers.keyboard_rows(e)
    assert [(r.word, r.freq, r.pos, r.ord) for r in k.collect()] == [("ghar", 218, "noun", 1)]
    writers.write_keyboard(k.coalesce(1), str(tmp_path / "k"))
    body = b"".join(p.read_bytes() for p in (tmp_path / "k").glob("part-*"))
    assert body == b"ghar\t218\thi_Latn\t\t\tnoun\r\n"
    safe, out = writers.split_safe(e)
    assert safe.count() + out.count() == 5


def test_sql_dump_quotes(spark, tmp_path):
    e = spark.createDataFrame([(f"i{n}", "it's") for n in range(25)], "id string, v string")
    got = [r.stmt for r in writers.sql_dump(e, ["id", "v"], "t", ["id"]).orderBy("n").collect()]
    assert [s.count("'it''s'") for s in got] == [10, 10, 5] and got[0].startswith("INSERT INTO t (id,v) VALUES ('i0','it''s'),('i1',") and got[2].endswith(");")
    writers.write_dump(writers.sql_dump(e, ["id", "v"], "t", ["id"]), str(tmp_path / "dump"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "dump").glob("part-*"))).splitlines() == got


def test_flags_and_model(spark):
    e = spark.createDataFrame([(1, "a Bad"), (2, "good"), (3, None)], "rec_id long, word_hinglish_roman string")
    t = spark.createDataFrame([(" bad ",), ("",), (None,)], "term string")
    assert {r.rec_id: (r.profanity, r.severity_score) for r in flag_entries(e, t).collect()} == {1: (True, 1.0), 2: (False, 0.0), 3: (False, 0.0)}

    before, safety.INLINE_TERMS = safety.INLINE_TERMS, 0  # a longer list is joined, with the same result
    try:
        assert {r.rec_id: (r.profanity, r.severity_score) for r in flag_entries(e, t).collect()} == {1: (True, 1.0), 2: (False, 0.0), 3: (False, 0.0)}
    finally:
        safety.INLINE_TERMS = before
    assert not any(r.profanity for r in flag_entries(e, t.limit(0)).collect())

    def load():
        def model(texts):
            if "good" in texts and len(texts) > 1:
                raise ValueError("batch")
            return [0.9 if "Bad" in x else 0.1 for x in texts]

        return model

    assert {r.rec_id: (r.score, r.toxic) for r in score_texts(e, "rec_id", "word_hinglish_roman", load).collect()} == {1: (0.9, True), 2: (0.1, False), 3: (0.0, False)}


def test_stream(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "t")
    for batch in ([("a", 1, "x"), ("b", 2, "y")], [("a", 3, "z")], [("a", 4, "v")], [("a", 5, "z")]):
        spark.createDataFrame(batch, "id string, rec_id long, v string").coalesce(1).write.mode("append").parquet(str(src))
        q = stream_upserts(spark.readStream.schema("id string, rec_id long, v string").parquet(str(src)), out, str(tmp_path / "c"))
        q.awaitTermination(60)
        assert q.exception() is None
    assert sorted(map(tuple, latest(spark, out).select("id", "v").collect())) == [("a", "z"), ("b", "y")]
    # a batch writes the parts it changes, and old versions go
    assert sorted(len(v) for v in _versions(spark, out).values()) == [1, 2]
