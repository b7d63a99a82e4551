"""Corpus operators on small tables: defined results for odd input, and brute force or round trips."""

import base64
import itertools
import pickle
import random
import re
import unicodedata
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import bpe, content, langid, packing, reading, survivor, visual

TOKENIZERS = Path(bpe.TOKENIZER_DIR)
needs_vocabulary = pytest.mark.skipif(not (TOKENIZERS / "byte_bpe_50k.tiktoken").exists(), reason="no vocabulary files")


# --- 1: survivors -------------------------------------------------------------------
ENTRY = "word_hinglish_roman string, word_hindi string, definition_en string, confidence_score double, source string, sources array<string>, updated_at timestamp, field string"
T0 = datetime(2024, 1, 1)


def best(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], ENTRY)
    return {r.dup_key: r for r in survivor.best_records(df, survivor.duplicate_key(F.col("word_hinglish_roman"))).collect()}


def test_survivor_fields(spark):
    d = lambda h: T0 + timedelta(hours=h)
    rows = [
        ("Ghar ", "घर", "a small house by", 0.2, "Wiktionary", None, d(0)), (" ghar", "घ‍र", " a small house by the river", 0.5, "WordNet", ["WordNet", "x"], d(5)),
        ("ghar", None, "a small hou …", 79.0, "WordNet", None, d(9)), ("ghar", "", "TODO", float("nan"), "WordNet", None, d(9)), ("ghar", "घर", "a small house by", None, "WordNet", None, d(10)),
        ("one", "एक", "x y", 0.5, "s", None, d(0)), ("", "दो", "x", 0.5, "s", None, d(0)), (None, "दो", "x", 0.5, "s", None, d(0)), ("  ", "दो", "x", 0.5, "s", None, d(0)),
        ("none", None, None, -1.0, "a", None, d(0)), ("none", " ", "n/a", 2.0, "b", [], None),
    ]
    got = best(spark, rows)
    assert set(got) == {"ghar", "none"}
    g = got["ghar"]
    assert (g.word_hindi, g.definition_en, g.confidence_score, g.sources) == ("घर", " a small house by the river", "0.5000", ["Wiktionary", "WordNet", "x"])
    n = got["none"]
    assert (n.word_hindi, n.definition_en, n.confidence_score, n.sources) == (None, None, None, ["a"])
    items = survivor.survivor_items(spark.createDataFrame(list(got.values()), "dup_key string, word_hindi string, definition_en string, confidence_score string, sources array<string>"))
    assert items.where("dup_key = 'none'").count() == 1 and items.where("dup_key = 'ghar'").count() == 6


def test_survivor_votes_decide(spark):
    d = lambda h: T0 + timedelta(hours=h)
    # an old value sent again often does not outvote a new one of the same trust
    rows = [("k", "अ", "old text", 0.1, "WordNet", None, d(0))] * 50 + [("k", "आ", "new text", 0.9, "WordNet", None, d(2.5))]
    assert best(spark, rows)["k"].definition_en == "new text"
    # agreement outweighs a newer single vote, trust outweighs two hours, and weeks outweigh trust
    rows = [("k", None, "one text", None, "Wiktionary", None, d(2)), ("k", None, "two text", None, "Wiktionary", None, d(0)), ("k", None, "two text", None, "Wiktionary", None, d(1))]
    assert best(spark, rows)["k"].definition_en == "two text"
    five = [("k", None, "trusted text", None, "WordNet", None, d(i / 10)) for i in range(5)] + [("k", None, "newer text", None, "unnamed", None, d(2))]
    assert best(spark, five)["k"].definition_en == "trusted text"
    one = [("k", None, "trusted text", None, "WordNet", None, d(0)), ("k", None, "newer text", None, "unnamed", None, d(2))]
    late = [one[0], ("k", None, "newer text", None, "unnamed", None, d(24 * 30))]
    assert best(spark, one)["k"].definition_en == "trusted text" and best(spark, late)["k"].definition_en == "newer text"
    df = spark.createDataFrame([(*r, "clash") for r in late], ENTRY)
    slow = survivor.best_records(df, survivor.duplicate_key(F.col("word_hinglish_roman")), half_lives={"WordNet": 10 * 365 * 86_400}).first()
    assert slow.definition_en == "trusted text"
    # votes older than the oldest that are told apart: the newer value
    old = [("k", None, "first text", None, "WordNet", None, datetime(1971, 1, 1)), ("k", None, "second text", None, "WordNet", None, datetime(1972, 1, 1)), ("k", None, None, None, "WordNet", None, T0)]
    assert best(spark, old)["k"].definition_en == "second text"


def test_survivor_cut_offs_of_any_length(spark):
    d = lambda h: T0 + timedelta(hours=h)
    for cut in ("s", "sta", "stat", "station by"):
        rows = [("k", None, "station by the river", None, "s", None, d(0)), ("k", None, cut, None, "s", None, d(900)), ("k", None, "other", None, "s", None, datetime(2020, 1, 1))]
        assert best(spark, rows)["k"].definition_en == "station by the river"
    # over many partitions: the neighbour may stand at the start of the next one
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(f"g{g:02d}", None, "abcdefghij"[:n], None, "s", None, d(20 - n)) for g in range(30) for n in range(1, 11)]
        got = best(spark, rows)
        assert len(got) == 30 and {r.definition_en for r in got.values()} == {"abcdefghij"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_survivor_hot_group_and_empty(spark):
    rows = [("hot", "घर", f"text number {i % 997:03d}", (i % 1000) / 1000, "WordNet", None, T0 + timedelta(minutes=i)) for i in range(6000)]
    got = best(spark, rows)["hot"]
    assert (got.definition_en, got.confidence_score) == (f"text number {5999 % 997:03d}", "0.9990")
    assert best(spark, []) == {}


# --- 2: languages -------------------------------------------------------------------
EN = ["the old house stands near the river", "a small boat came to the market", "people sell fruit in the village", "children play with a round stone"]
HI = ["वह पुराना घर नदी के पास है", "एक छोटी नाव बाज़ार में आई", "लोग गाँव में फल बेचते हैं", "बच्चे गोल पत्थर से खेलते हैं"]
RO = ["vah puraanaa ghar nadee ke paas hai", "ek chhotee naav baazaar mein aaee", "log gaanv mein phal bechate hain", "bachche gol patthar se khelate hain"]
MR = ["ते जुने घर नदीजवळ आहे", "एक लहान होडी बाजारात आली", "लोक गावात फळे विकतात", "मुले गोल दगडाशी खेळतात"]


@pytest.fixture(scope="module")
def cnn():
    return langid.train([(t, y) for y, ts in (("en", EN), ("hi", HI), ("hi-Latn", RO), ("mr", MR)) for t in ts] * 3)


def test_languages_and_stretches(spark, cnn):
    rows = [(1, EN[0], "x"), (2, HI[0] + ". " + EN[1], "x"), (3, RO[1] + " — " + MR[2] + "\n" + EN[3], "x"), (4, None, "x"), (5, "  ", "x"), (6, "123 …", "x"), (7, "people sell फल in the village", "x"), (7, HI[1], "x")]
    df = spark.createDataFrame(rows, "rec_id long, definition string, lang string")
    got = {}
    for r in langid.label_languages(df, "rec_id", "definition", cnn).orderBy("rec_id", "seg").collect():
        got.setdefault(r.rec_id, []).append((r.seg, r.lang))
        assert 0 <= r.confidence <= 1
    assert got[1] == [(0, "en")] and got[2] == [(0, "mixed"), (1, "hi"), (2, "en")] and got[3] == [(0, "mixed"), (1, "hi-Latn"), (2, "mr"), (3, "en")]
    assert got[4] == got[5] == got[6] == [(0, None)] and got[7] == [(0, "en"), (0, "hi")]
    assert langid.label_languages(df.limit(0), "rec_id", "definition", cnn).count() == 0


def test_short_cut_keeps_stretches_with_a_shared_word():
    # "to" votes for English by a little, its two neighbours for romanised Hindi by much
    en, hi = np.log(np.array([0.97, 0.01, 0.01, 0.01], np.float32)), np.log(np.array([0.001, 0.001, 0.997, 0.001], np.float32))
    known = {"house": en, "to": np.log(np.array([0.5, 0.01, 0.48, 0.01], np.float32)), "ham": hi, "chale": hi}
    words = ["house"] * 5 + ["to", "ham", "chale"]
    assert langid.single(words, known) is None and langid.single(["house"] * 5 + ["to"], known)[1:3] == (6, 0)
    runs = langid.stretches([np.array([known[w] for w in words])], [[4.0] * 8])[0]
    assert [r[:3] for r in runs] == [(0, 5, 0), (5, 3, 2)]
    # two stretches, neither in the language of the greatest total, and neither gaining a whole switch
    a, b = np.array([0, -1.2, -0.9, -9], np.float32), np.array([-1.2, 0, -0.9, -9], np.float32)
    a[2] = b[2] = -0.59
    assert langid.single(list("aaabbb"), {"a": a, "b": b}) is None and len(langid.stretches([np.array([a] * 3 + [b] * 3)], [[3.0] * 6])[0]) == 2
    # whatever it takes for single, the full search does, too
    r, took = np.random.default_rng(1), 0
    for _ in range(600):
        scores = np.log(r.dirichlet([0.3] * 4 if r.random() < 0.5 else [2.0, 0.3, 0.3, 0.3], int(r.integers(1, 12)))).clip(-9).astype(np.float32)
        one = langid.single([str(i) for i in range(len(scores))], {str(i): x for i, x in enumerate(scores)})
        costs = r.choice([3.0, 4.0, 5.5], len(scores)).tolist()
        if one is not None:
            took += 1
            assert [x[:3] for x in langid.stretches([scores], [costs])[0]] == [one[:3]]
    assert took > 100


def test_other_scripts(spark, cnn):
    rows = [(1, "старый дом стоит у реки"), (2, EN[0] + ". старый дом стоит у реки"), (3, EN[0] + " старый")]
    got = [(r.rec_id, r.seg, r.lang) for r in langid.label_languages(spark.createDataFrame(rows, "rec_id long, definition string"), "rec_id", "definition", cnn).collect()]
    assert (1, 0, langid.OTHER) in got and (3, 0, "en") in got


def test_training_takes_labelled_rows_only(spark):
    rows = [(EN[i % 4] + f" {i}", "en" if i % 50 == 0 else None) for i in range(2000)]
    assert len(langid.training_sample(spark.createDataFrame(rows, "t string, y string"), "t", "y", 40)) == 40


def test_label_ways(spark):
    ways = {"hi": "hi", " HIN ": "hi", "Hindi": "hi", "hi-Deva": "hi", "hi_IN": "hi", "hi_Latn": "hi-Latn", "Hinglish": "hi-Latn", "hin-Latn-IN": "hi-Latn", "EN-in": "en", "eng": "en", "MAR": "mr", "Mixed": "mixed", "fr": "other", "und": None, "": None, "N/A": None}
    rows = spark.createDataFrame(list(ways), "string").select("value", langid.canonical_label(F.col("value")).alias("y")).collect()
    assert {r.value: r.y for r in rows} == ways


def test_gradients_match_differences():
    m = langid.ByteCNN.fresh(4, 3)
    x = langid.windows(["ghar", "house", "घर"])
    y, w = np.eye(4, dtype=np.float32)[[1, 0, 2]], np.ones(3, np.float32)

    def loss():
        return -float((y * m.scores(x)).sum() / 3)

    for p, g in zip(m.parameters(), m.gradients(x, y, w), strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[i], 2e-3
        p[i] = old + e
        up = loss()
        p[i] = old - e
        down = loss()
        p[i] = old
        assert g[i] == pytest.approx((up - down) / (2 * e), rel=0.1, abs=5e-3)


def test_untrained_and_long_texts(cnn):
    assert langid.train([]) is not None
    runs = langid.stretches([np.tile(langid.word_scores(cnn, ["house"])["house"], (5000, 1))], [[4.0] * 5000])
    assert len(runs[0]) == 1 and runs[0][0][1] == 5000


# --- 4: content ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def judge():
    good = ["the house is near the river", "people sell fruit here", "the boat came home", "a dog guards the house", "the doctor saw her arm"]
    bad = {"abuse": ["you are a filthy zarbol and a fool", "shut your mouth zarbol fool"], "hate": ["all velkans must be driven out", "never trust the velkans"], "sexual": ["they undressed on the bed naked", "naked girls on the bed tonight"]}
    labelled = [(None, [t], "none") for t in good] * 4 + [(None, [good[0] + ". " + t], y) for y, ts in bad.items() for t in ts] * 4
    return content.train(labelled, [(None, [t]) for t in good], [(" Zarbol", "abuse"), ("मूरझी", "hate"), (None, None), ("", "abuse")])


def every_reading(token, lm):
    """The cheapest of all paths through the lattice."""
    best = []
    for path in itertools.product(*content.readings(token, lm.alphabet)):
        text = "".join(x for x, _ in path)
        s, cost = "^" + text + "$", sum(c for _, c in path)
        best.append((cost - sum(np.log(lm.p(s[max(0, i - lm.order + 1) : i], s[i])) for i in range(1, len(s))), text))
    return min(best)[1]


@pytest.mark.parametrize("token", ["h**s*", "*i*e*", "h0u5e", "r1v3r", "ri**er", "b-o-a-t", "b00aat", "****", "hooouse"])
def test_decoding_is_exact(token):
    lm = content.CharLM({"house": 3.0, "river": 2.0, "boat": 2.0, "horse": 1.5, "rice": 1.0, "hive": 1.0})
    lm.alphabet = lm.alphabet[:6] if token.count("*") > 3 else lm.alphabet
    want = every_reading(token, lm)
    assert content.decode(token, lm) == want
    before = content.BEAM
    try:
        content.BEAM = 1  # the first pass only bounds the second
        assert content.decode(token, lm) == want
    finally:
        content.BEAM = before


def test_long_tokens_are_decoded_whole(judge):
    lm = content.CharLM({"house": 3.0, "river": 2.0})
    assert content.decode("h0use" * 400, lm) == "house" * 400
    assert content.decode("r1ver" + "r" * 5000, lm).startswith("river") and content.decode("h" + "*" * 3000 + "e", lm)


def test_restores_disguises(judge):
    r = content.Restorer(judge.lm, judge.headword_terms)
    for raw in ("z@rb0l", "z-a-r-b-o-l", "zaaarbol", "z*rbol", "ｚarbol", "zаrbol", "zar​bol", "ZARBOL", "zarbol!", "z.arbol"):
        assert r.token(raw) == "zarbol", raw
    assert r.words("the house") == ["the", "house"] and r.sentences("z a r b o l here") == [["zarbol", "here"]]
    assert r.token("मू*झी") == "मूरझी" and r.token("​") == ""


def test_content_scores(spark, judge):
    rows = [(1, "x", "the boat came home", None, "s"), (2, "z*rbol ghar", None, "", "s"), (3, None, "people sell fruit here. you are a filthy z@rb0l and a fool", None, "s"), (4, None, None, None, None), (5, "y", None, "all velkans must be driven out", "s"), (5, "y", "", "they undressed on the bed naked", "s")]
    df = spark.createDataFrame(rows, "rec_id long, word_hindi string, definition string, example_sentence string, category string")
    got = sorted((r.rec_id, r.category) for r in content.score_content(df, "rec_id", "word_hindi", ["definition", "example_sentence"], judge).collect())
    assert got == [(1, "none"), (2, "abuse"), (3, "abuse"), (4, "none"), (5, "hate"), (5, "sexual")]
    assert content.score_content(df.limit(0), "rec_id", "word_hindi", ["definition"], judge).count() == 0


def test_sentences_together_score_as_alone(judge):
    r = content.Restorer(judge.lm, judge.headword_terms)
    sentences = [ws for t in ("You are a stupid dog. The house is old", "gh4r is here; a b c", "x") for ws in r.sentences(t)] + [[]]
    assert np.allclose(judge.probs(sentences), [judge.prob(ws) for ws in sentences])


def test_no_labels_leaves_terms():
    m = content.train([], [], [("zarbol", None)])
    r = content.Restorer(m.lm, m.headword_terms)
    assert [x[0] for x in m.judge(r, [("Zarbol", []), ("x", ["long " * 5000]), (None, [None, ""])], {})] == ["abuse", "none", "none"]


def test_corpus_counts_cover_every_row(spark):
    # rare words, pairs and a slot of one unlisted term, spread over more rows than any sample held
    good = ["the house is near the river", "people sell fruit here", "the boat came home", "a dog guards the house"]
    bad = ["you are a filthy zarbol and a fool", "shut your mouth zarbol fool", "get lost you zarbol fool"]
    texts = [f"{good[i % 4]} number{i // 2}x" for i in range(13_000)] + [t.replace("zarbol", "drimlot") for t in bad] + [good[0] + ". " + t for t in bad] * 4
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "rec_id long, word_hindi string, definition string").repartition(4)
    reviewed = [(i, "none") for i in range(16)] + [(i, "abuse") for i in range(13_003, len(texts))]
    labels = spark.createDataFrame(reviewed, "rec_id long, label string")
    m = content.content_model(df, "rec_id", "word_hindi", ["definition"], labels, spark.createDataFrame([("zarbol", "abuse")], "term string, category string"))
    want = content.train(sorted(((None, [texts[i]], y) for i, y in reviewed), key=lambda r: (str(r[0]), str(r[1]), r[2])), [(None, [t]) for t in texts], [("zarbol", "abuse")])
    words = content.SparkCorpus(df.select(F.col("word_hindi").alias("h"), F.array("definition").alias("ts"))).words({"river."})
    assert words["house"] == 6_512 and all(words[w] == 3_250 for w in ("people", "boat")) and words["drimlot"] == 3
    assert m.headword_terms == want.headword_terms == {"zarbol": "abuse", "drimlot": "abuse"}
    assert np.array_equal(m.lm.grams, want.lm.grams) and np.allclose(m.lm.weights, want.lm.weights) and m.weights.keys() == want.weights.keys()
    assert all(np.allclose(m.weights[i], want.weights[i]) for i in m.weights)


# --- 5: look-alikes -----------------------------------------------------------------
SAME = [("घ‍र", "घर"), ("ज़मीन", "ज़मीन"), ("ज़मीन", "ज़मीन"), ("काेट", "कोट"), ("अाम", "आम"), ("आॅफ़िस", "ऑफ़िस"), ("प्रात:", "प्रातः"), ("प्रात：", "प्रातः"), ("कंंबल", "कंबल"), ("profilе", "profile"), ("ｇｈａｒ", "ghar"), ("pānī", "pānī"), ("ﬁn", "fin"), ("a　b", "a b"), (" घर\xa0", "घर"), ("घर   वाला", "घर वाला"), ("café", "café"), ("ग\xadघर", "गघर"), ("​", ""), ("\xa0", "")]


@pytest.mark.parametrize("with_vocabulary", [True, False])
def test_forms(spark, with_vocabulary):
    rows = [(i, a, None, "c") for i, (a, _) in enumerate(SAME)]
    if with_vocabulary:
        rows += [(100 + i, None, b, "c") for i, (_, b) in enumerate(SAME)]
    df = spark.createDataFrame(rows, "rec_id long, word_hindi string, head_word string, field string")
    got = {r.rec_id: r.form for r in visual.visual_forms(df, "rec_id", ["word_hindi", "head_word"]).collect()}
    assert got == {i: b for i, (a, b) in enumerate(SAME) if a != b}


def test_plain_values_and_repeats(spark):
    rows = [(1, "ghar", None), (1, "घर वाला", ""), (2, "प्रातः", None), (3, "क्या?", None), (4, "घ‍र", "घ‍र"), (4, "घ‍र", None)]
    got = sorted(tuple(r) for r in visual.visual_forms(spark.createDataFrame(rows, "rec_id long, word_hindi string, head_word string"), "rec_id", ["word_hindi", "head_word"]).collect())
    assert got == [(4, "head_word", "घर"), (4, "word_hindi", "घर"), (4, "word_hindi", "घर")]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aghrघरािेाैंः़ज़फ़अआ:é") + ["‍", "́", "а", "ｈ", "﻿"]), max_size=8))
def test_form_is_stable(token):
    once = visual.table_form(token)
    assert visual.table_form(once) == once and unicodedata.is_normalized("NFC", once)


def test_automaton_takes_the_frequent_spelling():
    a = visual.Automaton()
    a.add("ghar", 3)
    a.add("gharа"[:4], 1)
    assert a.canonical("gh‍aг"[:4] + "r") == "ghar" and a.canonical("ghaar") is None
    b = visual.Automaton()
    for w, n in (("café", 2), ("cafe", 9), ("cafes", 1), ("कोट", 1)):
        b.add(w, n)
    # what can be seen has a weight, so it takes a higher cut-off; a mark weighs less than a letter
    assert b.canonical("сafè") is None and b.canonical("сafè", 0.8) == "cafe" and b.canonical("caf") is None and b.canonical("caf", 1.5) == "cafe"
    assert b.canonical("cafe\u0301") == "café" and b.canonical("काेट") == "कोट" and b.canonical("") is None


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aghrघरािेाैंः़ज़फ़अआउऊए:é") + ["‍", "́", "а", "ｈ", "﻿", "ﬁ", "𝐚"]), max_size=8))
def test_like_looking_tokens_share_their_head(token):
    assert visual.head(token) == visual.head(visual.table_form(token))


def test_compatible_letters_come_from_unicode():
    assert [visual.table_form(c) for c in "ｇ𝒢ℊⓖﬂⅣﾊ"] == ["g", "G", "g", "g", "fl", "IV", "ハ"] and [visual.table_form(c) for c in ("²", "½", "ำ", "ª")] == ["²", "½", "ำ", "ª"]


def test_plain_values_keep_their_form(spark):
    ordinary = [c for c in map(chr, range(0x21, 0x980)) if re.fullmatch(f"[{visual._ORDINARY}]", c)]
    faults = re.compile(visual._FAULTS)
    few = [c for c in "aAé:कनरळअआउए" if c in ordinary] + [c for c in ordinary if "ऀ" <= c and not c.isalnum()]
    for v in itertools.chain(ordinary, map("".join, itertools.product(ordinary, repeat=2)), map("".join, itertools.product(few, repeat=3))):
        if not faults.search(v):
            assert visual.table_form.__wrapped__(v) == v, ascii(v)
    odd = ["न\u093cद", "क\u094d\u093c", "क\u0951\u0952", "र\u093c", "ı"]
    got = {r.rec_id: r.form for r in visual.visual_forms(spark.createDataFrame(list(enumerate(odd)) + [(9, "\u0931"), (10, "क़")], "rec_id long, word_hindi string"), "rec_id", ["word_hindi"]).collect()}
    assert got == {0: "\u0929द", 1: "क\u093c\u094d", 2: "क\u0952\u0951", 3: "\u0931", 4: "i"}


def test_very_long_value(spark):
    long = "घर " * 20_000
    got = visual.visual_forms(spark.createDataFrame([(1, long)], "rec_id long, word_hindi string"), "rec_id", ["word_hindi"]).collect()
    assert got[0].form == long.strip()


# --- 6: encoding --------------------------------------------------------------------
def slow_bpe(word, ranks):
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        r, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if r == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@needs_vocabulary
def test_encoding_equals_the_library():
    import tiktoken

    ranks = bpe.vocabulary("byte_bpe_50k")
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    texts = ["", " ", "aaaaaaa", "it's we'LL", "<|endoftext|>", "घर में  पानी\n\n है", "👩‍👩‍👧 日本", " " * 40 + "a" * 3000] + ["".join(r.choice(" \n\tabcे क1!é' \x1d") for _ in range(80)) for _ in range(300)]
    got = bpe.Encoder("byte_bpe_50k").encode_batch(texts)
    assert [list(x) for x in got] == [lib.encode_ordinary(t) for t in texts]
    words = [t.encode() for t in texts if len(t) < 100]
    assert bpe.merge_words(words, bpe._tables("byte_bpe_50k", bpe.TOKENIZER_DIR)) == [slow_bpe(w, ranks) if w else [] for w in words]


@needs_vocabulary
def test_encoding_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "x"), (3, None, "x"), (None, "a b", "x"), (1, "a b", "x")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, r.ids) for r in bpe.encode_corpus(df, "doc_id", "text").collect())
    back = {v: k for k, v in bpe.vocabulary("byte_bpe_50k").items()}
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and got[3][1] == got[4][1] == [] and b"".join(back[i] for i in got[0][1]) == b"a b"
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        bpe.vocabulary("no_such")


@needs_vocabulary
def test_vocabulary_is_the_file():
    line = (TOKENIZERS / "byte_bpe_50k.tiktoken").read_bytes().split(b"\n")[0].split()
    assert bpe.vocabulary("byte_bpe_50k")[base64.b64decode(line[0])] == int(line[1])


# --- 7: containers ------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=60), st.integers(100, 250))
def test_fill_is_complete_and_within_capacity(sizes, capacity):
    boxes = packing.fill(sizes, capacity)
    assert sorted(i for b in boxes for i in b) == [i for i, s in enumerate(sizes) if s]
    assert all(0 < sum(sizes[i] for i in b) <= capacity for b in boxes)


def test_differencing_balances():
    r = np.random.default_rng(2)
    sizes = r.integers(1, 1000, 400)
    loads = [sizes[b].sum() for b in packing.differencing(sizes, 7)]
    assert max(loads) - min(loads) <= 2 and sum(loads) == sizes.sum()
    assert packing.differencing([5, 5, 5], 4).count([]) == 1 and packing.differencing([], 2) == [[], []]


def slow_differencing(sizes, k):
    """Imbalance in the end, merging one pair of partial partitions at a time; None if the choice of a pair was open."""
    nodes = [[0] * (k - 1) + [s] for s in sizes]
    while len(nodes) > 1:
        nodes.sort(key=lambda n: n[-1] - n[0])
        if len(nodes) > 2 and nodes[-3][-1] - nodes[-3][0] == nodes[-2][-1] - nodes[-2][0]:
            return None
        a, b = nodes.pop(), nodes.pop()
        nodes.append(sorted(x + y for x, y in zip(a, b[::-1], strict=True)))
    return nodes[0][-1] - nodes[0][0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100_000), min_size=1, max_size=40, unique=True), st.integers(2, 6))
def test_runs_of_single_items_change_nothing(sizes, k):
    bins = packing.differencing(sizes, k)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    loads = sorted(sum(sizes[i] for i in b) for b in bins)
    want = slow_differencing(sizes, k)
    assert want is None or loads[-1] - loads[0] == want


@needs_vocabulary
def test_packing_holds_for_any_partitioning(spark):
    texts = [(i, "word " * (i * 7 % 300)) for i in range(400)]
    fills = []
    for parts in (1, 3, 8):
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)
        packed = packing.pack_documents(df, "doc_id", "text", [(1, "byte_bpe_50k", 512)], containers_per_block=20, items_per_block=150)
        assert packed.where("container <> 'none'").groupBy("container").agg(F.sum("n_tokens").alias("n")).where("n > 512").count() == 0
        assert packed.count() == 400 and packed.select("doc_id").distinct().count() == 400
        fills.append(packing.packing_report(packed).first().fill)
    assert min(fills) > 0.9


def test_fill_wastes_little():
    r = np.random.default_rng(3)
    for top in (60, 250):
        sizes = r.integers(1, top, 2000)
        assert len(packing.fill(sizes, 256)) <= np.ceil(sizes.sum() / 256) * 1.03


@needs_vocabulary
def test_documents_are_cut_only_if_too_large(spark):
    texts = [(i, "house " * n, "c") for i, n in enumerate([3, 700, 64, 65, 0, 1, 1])] + [(9, None, "c"), (9, "house", "c")]
    df = spark.createDataFrame(texts, "doc_id long, text string, container string").repartition(1)
    rows = packing.pack_documents(df, "doc_id", "text", [(1, "byte_bpe_50k", 64), (2, "byte_bpe_50k", 8192)]).collect()
    want = bpe.Encoder("byte_bpe_50k").encode_batch([t for _, t, _ in texts])
    for spec, capacity in ((1, 64), (2, 8192)):
        mine = [r for r in rows if r.spec_id == spec]
        boxes = {}
        for r in mine:
            boxes[r.container] = boxes.get(r.container, 0) + r.n_tokens
            assert (r.container == "none") == (r.n_tokens == 0)
        assert all(n <= capacity for n in boxes.values())
        assert sum(r.n_tokens for r in mine) == sum(map(len, want))
        for i, ids in ((j, x) for (j, _, _), x in zip(texts, want, strict=True) if j != 9):
            parts = sorted((r.piece, r.start, r.n_tokens) for r in mine if r.doc_id == i)
            assert len(parts) == max(1, -(-len(ids) // capacity)) and sum(p[2] for p in parts) == len(ids)
            assert all(a[1] + a[2] == b[1] for a, b in zip(parts, parts[1:], strict=False))
    assert packing.packing_report(packing.pack_documents(df, "doc_id", "text", [(2, "byte_bpe_50k", 8192)])).collect()[0].containers == 1
    assert packing.pack_documents(df, "doc_id", "text", []).count() == 0 and packing.pack_documents(df.limit(0), "doc_id", "text", [(1, "byte_bpe_50k", 64)]).count() == 0


# --- 8: reading level ---------------------------------------------------------------
def prose(words, r, n=8):
    return " ".join("the " + " ".join(r.choice(words) for _ in range(5)) + "." for _ in range(n))


def test_reading_levels(spark):
    r = random.Random(5)
    vocabulary = {g: [f"{w}{c}" for c in "abcdefgh"] for g, w in ((1, "cat"), (2, "market"), (3, "generally"), (4, "paradigmatic"))}
    docs, labels = [], []
    for i in range(160):
        g = i % 4 + 1
        docs.append((i, prose(vocabulary[g], r) + (" " + prose(vocabulary[5 - g], r, 1) if i % 3 == 0 else ""), 9))
        if i < 80:
            labels.append((i, g if i != 7 else 1))
    words = ", ".join(f"w{i}" for i in range(50))
    docs += [(900, None, 9), (901, "", 9), (902, "  \n ", 9), (903, words, 9), (904, "\n".join(words.split(", ")), 9), (905, "\n".join(f"row {i} {i * 7} {i / 3:.2f}" for i in range(30)), 9), (906, "the cata market.", 9), (None, prose(vocabulary[1], r), 9)]
    d = spark.createDataFrame(docs, "doc_id long, text string, grade int")
    lab = spark.createDataFrame(labels, "doc_id long, grade int")
    got = {x.doc_id: x.grade for x in reading.reading_levels(d, "doc_id", "text", lab).collect()}
    assert not [i for i in range(900, 907) if i in got]
    assert sum(got[i] == i % 4 + 1 for i in range(80, 160)) >= 78
    assert reading.reading_levels(d, "doc_id", "text", lab.limit(0)).count() == 0 and reading.reading_levels(d.limit(0), "doc_id", "text", lab).count() == 0


def test_running_text(spark):
    rows = [("one two three. " * 6, True), ("a b c d e f g h i j k l m n o p", False), ("The cat sat here\nThe dog ran home\nWe saw them all day\nThey came back late", True), ("<p>the cat sat.</p>" * 6, True), (None, False)]
    got = spark.createDataFrame(rows, "t string, y boolean").select("y", reading.running_text(F.col("t")).alias("z")).collect()
    assert [r.y for r in got] == [r.z for r in got]


def test_document_without_a_telling_word_gets_the_middle(spark):
    r = random.Random(9)
    docs = [(i, prose(["cat", "dog", "hen"] if i % 2 else ["syntax", "lexeme", "morpheme"], r)) for i in range(40)] + [(99, "zig zag zog zug zeg. " * 4)]
    lab = spark.createDataFrame([(i, 1 if i % 2 else 4) for i in range(20)], "doc_id long, grade int")
    got = {x.doc_id: (x.grade, x.level) for x in reading.reading_levels(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", lab).collect()}
    assert len(got) == 41 and all(got[i][0] == (1 if i % 2 else 4) for i in range(40)) and 1 < got[99][1] < 4


def test_reading_shuffles_no_words_and_broadcasts_only_ratings(spark):
    """The plans of every job: no exchange or broadcast of texts or words but the count of words and their sums."""
    seen = []
    real = reading.durable
    reading.durable = lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), real(df))[1]
    try:
        docs = spark.createDataFrame([(i, "the cat sat on the mat and saw a dog. " * 3) for i in range(8)], "doc_id long, text string")
        reading.reading_levels(docs, "doc_id", "text", spark.createDataFrame([(1, 1), (2, 2)], "doc_id long, grade int")).count()
    finally:
        reading.durable = real
    joins = [p for p in seen if "Join" in p]
    assert len(joins) == 1 and sum("Exchange" in p for p in seen[2:]) == sum("s0" in p and "Exchange" in p for p in seen[2:])


def test_decoding_gives_the_text_back(spark):
    if not (TOKENIZERS / "byte_bpe_50k.tiktoken").exists():
        pytest.skip("no vocabulary files")
    texts = [(1, "घर is a house 😀\n"), (2, ""), (3, None)]
    ids = bpe.encode_corpus(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    assert {r.doc_id: r.text for r in bpe.decode_corpus(ids, "doc_id", "ids").collect()} == {1: texts[0][1], 2: "", 3: ""}


@pytest.mark.parametrize("name", ["p1_values", "p6_roundtrip", "p7_checks", "p8_graded"])
def test_against_sql(spark, name):
    import duckdb

    from lexmill.llm import queries

    sf = Path("/root/testdata/sf0.001")
    if not sf.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for p in sf.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    df = queries.queries()[name](spark, str(sf))
    cur = con.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in cur.description)
    assert sorted(df.columns) == columns
    assert sorted(map(str, df.select(columns).collect())) == sorted(str(row) for row in df.sparkSession.createDataFrame(con.execute(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall(), df.select(columns).schema).collect())


def test_learned_terms_come_in_parts(spark):
    import numpy as np

    from lexmill.llm import content

    # "zorka" and others stand where the listed "badword" stands, in sentences that look bad
    texts = [f"{w} sits {x}" for w in ("badword", "zorka", "mirgul", "tolvan", "pelshu") for x in ("there", "here")]
    dense = np.zeros((content.DIMS, len(content.CATEGORIES)), np.float32)
    dense[0, 1] = 5
    got = []
    for rows in (1, 2, content.TERM_ROWS):
        corpus = content.SparkCorpus(spark.createDataFrame([("x", [t]) for t in texts], "h string, ts array<string>"), rows)
        corpus.restore(content.CharLM({"sits": 1.0}), {"badword": "abuse"}, {"badword": "abuse"}, [], [])
        got.append(corpus.slots(dense, {"badword": "abuse"}))
    assert got[0] == got[1] == got[2] and set(got[0]) == {"badword", "zorka", "mirgul", "tolvan", "pelshu"}


def test_decoding_looks_each_context_up_once(monkeypatch):
    # F1 p4_found: CPU seconds; each character that might follow was looked up by a hash of its own
    lm = content.CharLM({"house": 3.0, "river": 2.0, "boat": 2.0, "horse": 1.5, "rice": 1.0, "hive": 1.0})
    asked = []
    digest = content.xxh64_intdigest
    monkeypatch.setattr(content, "xxh64_intdigest", lambda text: asked.append(text) or digest(text))
    assert content.decode("h**s*", lm) == "house"
    assert len(asked) == len(set(asked)) <= len(lm.contexts)
    for state in ("", "^", "^h", "ho", "ive"):
        for c in "aehirvxz^$":
            p, to = lm.step(state, c)
            assert p == np.log(lm.p(state, c)) and to == lm.state(state + c)


def test_a_worker_keeps_what_it_restored(judge):
    # F1 p4_found: CPU seconds; every task began with nothing known
    m = pickle.loads(pickle.dumps(judge))
    restore, kept = m.looked_at()
    m.judge(restore, [("x", ["the h0use is near"])], kept)
    assert m.looked_at()[0] is restore and "h0use" in restore.kept and kept
    again = pickle.loads(pickle.dumps(m))
    assert again.kept is None and again.lm.known is m.lm.known and m.lm.known
    other = pickle.loads(pickle.dumps(content.CharLM({"river": 2.0})))
    assert content.decode("r1ver", other) == "river" and other.known is not m.lm.known and set(content.CharLM.here) == {other.key}


def test_plain_tokens_are_their_own_form():
    letters = [chr(i) for i in [*range(0x21, 0x250), *range(0x300, 0x320), *range(0x900, 0x980), 0x200B, 0x200D, 0x430, 0x3BF, 0xFF41]]
    rng = np.random.default_rng(5)
    tokens = letters + ["".join(rng.choice(letters[:0x80] if i % 3 == 0 else letters[-133:-5] if i % 3 == 1 else letters, rng.integers(1, 6))) for i in range(20_000)]
    plain = [t for t in tokens if visual.is_plain(t)]
    assert len(plain) > 2_000 and all(visual.table_form(t) == t for t in plain)


@pytest.mark.parametrize("text", ["one two", " \t", "one. two", "one.two", "a - b", "a-b", "(x)", "क। ख", "x", "", None, "a\nb", "end."])
def test_sentences_without_an_end_are_whole(text):
    assert content.split_sentences(text) == [s for s in content._SENTENCE.split(text or "") if s and not s.isspace()]
