import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.operators.packed import parse_packed, split_packed


@pytest.mark.parametrize(
    ("raw", "items"),
    [
        (None, []), ("", []), ("  ", []), ("a", ["a"]), ("a b", ["a b"]), ("a, b;c", ["a", "b", "c"]), (";a;;b;", ["a", "b"]), ("a | b / c", ["a", "b", "c"]),
        ('["a, b", "c"]', ["a, b", "c"]), ("['a', 'b c']", ["a", "b c"]), ("{a,b}", ["a", "b"]), ('"x ""y"" z", w', ['x "y" z', "w"]), ("“a”, “b, c”", ["a", "b, c"]), ("“so \"b\" c”, d", ['so "b" c', "d"]),
        ("1. a; 2. b", ["a", "b"]), ("(1) a\n(2) b", ["a", "b"]), ("1) a 2) b c", ["a", "b c"]), ("a\tb\nc", ["a", "b", "c"]), ("घर । आम", ["घर", "आम"]), ("a、b，c；d", ["a", "b", "c", "d"]),
        ('["\\u0918\\u0930", "b"]', ["घर", "b"]), ("a, a", ["a", "a"]), ("it's, b", ["it's", "b"]), ('"a, b"', ["a, b"]), ("'a','b'", ["a", "b"]),
    ],
)
def test_forms(raw, items):
    assert parse_packed(raw) == (items, "")


@pytest.mark.parametrize(("raw", "items", "flag"), [('"a, b', ["a", "b"], "malformed_quote"), ('a", b', ["a", "b"], "malformed_quote"), ("[a, b", ["a", "b"], "unbalanced_bracket"), ("a, b]", ["a", "b"], "unbalanced_bracket")])
def test_backtracks_and_flags(raw, items, flag):
    assert parse_packed(raw) == (items, flag)


@pytest.mark.parametrize(
    ("raw", "items", "flags"),
    [
        ("a (b, c), d", ["a (b, c)", "d"], "inner_separator"), ("[a, [b, c], d]", ["a", "[b, c]", "d"], "inner_separator"), ("(a, b), (c, d)", ["(a, b)", "(c, d)"], "inner_separator"),
        ('a "b, c" d', ['a "b, c" d'], "inner_separator"), ("[a], [b]", ["[a]", "[b]"], ""), ("(a, b)", ["a", "b"], ""), ("1) a (x, {y; z}) 2) b", ["a (x, {y; z})", "b"], "inner_separator"),
        ("x (y, z", ["x (y", "z"], "unbalanced_bracket"), ("x) y, z", ["x) y", "z"], "unbalanced_bracket"), ("a (b [c, d), e", ["a (b [c, d)", "e"], "inner_separator"), ('["x", null, "null"]', ["x", "null"], ""), ("[x, null]", ["x", "null"], ""), ("a 'b, c", ["a 'b", "c"], ""),
    ],
)
def test_brackets_and_inner_quotes_keep_their_separators(raw, items, flags):
    assert parse_packed(raw) == (items, flags)


def test_many_open_brackets_take_linear_time():
    assert len(parse_packed("(a, " * 50_000)[0]) == 50_000


def test_words_split_at_blanks():
    assert parse_packed("a b ,c", True)[0] == ["a", "b", "c"]
    assert parse_packed("1) a 2) b", True)[0] == ["a", "b"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters='"\\', exclude_categories=["Cs", "Cc", "Z"]), min_size=1, max_size=8).filter(lambda s: s == s.strip()), min_size=2, max_size=6))
def test_quoted_lists_come_back(items):
    assert parse_packed(";".join(f'"{x}"' for x in items))[0] == items


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_never_fails_or_gives_blanks(raw):
    out, _ = parse_packed(raw)
    assert all(x and x == x.strip() for x in out)


def test_long_text():
    assert len(parse_packed(",".join(["x"] * 50_000))[0]) == 50_000


def test_split(spark):
    rows = [(1, "a,b", None, "dup"), (1, "a,b", "x", "dup"), (None, "c|d", "slur dated", "dup"), (2, "", " ", "dup"), (3, None, "y", "dup")]
    df = spark.createDataFrame(rows, "rec_id long, tags string, flags string, item string")  # item clashes with an output name
    got = sorted(split_packed(df, "rec_id", ["tags", "flags"], ["flags"], 2).select("rec_id", "field", "pos", "item").collect(), key=str)
    want = [(1, "tags", 1, "a"), (1, "tags", 2, "b")] * 2 + [(None, "tags", 1, "c"), (None, "tags", 2, "d"), (None, "flags", 1, "slur"), (None, "flags", 2, "dated")]
    assert got == sorted(map(lambda r: r, want), key=lambda r: str(__import__("pyspark").sql.Row(rec_id=r[0], field=r[1], pos=r[2], item=r[3])))
    assert split_packed(df.limit(0), "rec_id", ["tags"]).count() == 0
    assert split_packed(df, "rec_id", ["flags"]).where("rec_id = 3").count() == 1


def test_words_parted_by_a_fixed_blank_are_found(spark):
    from lexmill.operators.packed import split_packed

    df = spark.createDataFrame([(1, "abuse\u00a0hate"), (2, "abuse")], "rec_id long, toxicity_flags string")
    got = split_packed(df, "rec_id", ["toxicity_flags"], ["toxicity_flags"], min_values=2).collect()
    assert sorted((r.rec_id, r.pos, r.item) for r in got) == [(1, 1, "abuse"), (1, 2, "hate")]
