import pytest
from pyspark.sql import functions as F

from lexmill.functions import score, text, translit
from lexmill.functions.fuzzy import indel_ratio


def values(spark, rows, f, schema="a string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(f).collect()]


# fixed values: words no override table needs, and their spelling by rule
ANCHORS = {"अंगूठा": "angootha", "कोशिश": "koshish", "गधा": "gadha", "कछुआ": "kachhua", "अन्याय": "anyaay", "गर्मी": "garmi", "घंटा": "ghanta", "ऊँचा": "ooncha", "कश्ती": "kashti", "जलेबी": "jalebi", "ओले": "ole", "खजूर": "khajoor", "जांघ": "jaangh", "संभव": "sambhw", "कंगन": "kangn"}


def test_romanize_anchors(spark):
    assert values(spark, [(w,) for w in ANCHORS], translit.romanize(F.col("a"))) == list(ANCHORS.values())


def test_romanize_keeps_other_tokens(spark):
    rows = [("पानी, घर-बार (जल)!",), ("कि'ताब abc १२",), ("",), (None,)]
    assert values(spark, rows, translit.romanize(F.col("a"), {"घर": "GHAR"})) == ["paani, GHAR-baar (jal)!", "कि'ताब abc 12", "", ""]


def test_backend_falls_back(spark):
    translit.register_backend("shout", F.upper)
    assert values(spark, [("घर",)], translit.transliterate(F.col("a"), "missing")) == ["ghar"]
    assert values(spark, [("ab",)], translit.transliterate(F.col("a"), "shout")) == ["AB"]


def test_iso(spark):
    assert values(spark, [("pānī",), ("cāy",), ("havā",), (None,)], text.iso_to_common(F.col("a"))) == ["paani", "chai", "hawa", None]
    assert values(spark, [("bahan",)], text.iso_to_common(F.col("a"), fixes={"bahan": "behen"})) == ["behen"]


def test_language_and_normal_forms(spark):
    assert values(spark, [("घर",), ("घर x",), ("x",), ("…",), ("",), (None,)], text.definition_lang(F.col("a"))) == ["hi", "mixed", "en", "en", "en", "en"]
    assert values(spark, [("क़लम",), ("क़लम",), (" जगत् ",), (None,)], text.normalize_hindi(F.col("a"))) == ["कलम", "कलम", "जगत", None]
    assert values(spark, [(" A-b  C! ",), ("élan",)], text.normalize_roman(F.col("a"))) == ["ab c", "élan"]
    assert values(spark, [("a-b Ā!",)], text.normalize_safety(F.col("a"))) == ["ab a"]


def test_terms_match_whole_tokens(spark):
    terms = F.array(F.lit("bad"))
    assert values(spark, [("a bad one",), ("badly",), ("",), (None,)], text.contains_term(F.col("a"), terms)) == [True, False, False, False]


@pytest.mark.parametrize(("a", "b", "kind"), [("ghara", "ghar", "trailing_schwa"), ("gh", "ghar", "missing_chars"), ("gharxx", "gxar", "extra_chars"), ("ghar", "ghaar", "length_mismatch"), ("vo", "wo", "v_w"), ("va", "wo", "v_w_and_vowel"), ("ka", "ko", "vowel_length"), ("ka", "ga", "other_consonant"), ("ka", "ka", "none")])
def test_diff_class(spark, a, b, kind):
    assert values(spark, [(a, b)], text.diff_class(F.col("a"), F.col("b")), "a string, b string") == [kind]


def test_frequency_truncates(spark):
    assert values(spark, [(1.0,), (0.3,), (0.65,), (0.0,)], score.frequency(F.col("a")), "a double") == [255, 1, 128, 1]


def test_confidence_caps_severe(spark):
    t, f = F.lit(True), F.lit(False)
    full = score.confidence(F.lit("WordNet"), F.lit("common_word"), F.lit(2), t, t, t, F.col("a"))
    assert [round(x, 4) for x in values(spark, [(0.0,), (0.5,)], full, "a double")] == [1.0, 0.3]
    low = score.confidence(F.lit("x"), F.lit("rule"), F.lit(1), f, f, f, F.col("a"))
    assert round(values(spark, [(None,)], low, "a double")[0], 4) == 0.525


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_indel_ratio_is_lcs():
    words = ["", "a", "ghar", "ghara", "kanbal", "kambal", "xyz", "ab" * 40]
    for a in words:
        for b in words:
            assert indel_ratio(a, b) == pytest.approx(100.0 if not a and not b else 200 * lcs(a, b) / (len(a) + len(b)))
