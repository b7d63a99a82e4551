"""Queries of the core: one per operator, each over its whole tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import score, text, translit
from lexmill.operators import dedup, graph, lookup, merge, safety, search, stats
from lexmill.operators.index import SearchIndex
from lexmill.operators.packed import split_packed
from lexmill.plans.runtime import shared_folder, spread, table
from lexmill.sinks import writers
from lexmill.sources import dictionaries

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL of the same result if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


@query()
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of the packed fields that hold two or more."""
    entries = table(spark, sf, "entries").select("rec_id", "synonyms", "tags", "toxicity_flags")
    return split_packed(spread(entries), "rec_id", ["synonyms", "tags", "toxicity_flags"], ["toxicity_flags"], min_values=2).select("rec_id", "field", "pos", "item")


@query()
def p3_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of the packed fields, with the parser's flags."""
    entries = table(spark, sf, "entries").select("rec_id", "synonyms", "tags", "toxicity_flags")
    return split_packed(spread(entries), "rec_id", ["synonyms", "tags", "toxicity_flags"], ["toxicity_flags"])


# --- scalar functions -------------------------------------------------------------
def _entries(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = table(spark, sf, "entries")
    return df.select(*columns) if columns else df


def _long(c) -> object:
    return c.cast("long")


_SQ = "trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"  # squashed lower case
_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_SAFE = "coalesce(case when isnan(severity_score) then 0 else severity_score end, 0) < 0.5"
_CONF = "coalesce(case when isnan(confidence_score) then 0 else confidence_score end, 0)"
_LANG = "case when regexp_matches(coalesce({c},''), '[ऀ-ॿ]') and regexp_matches({c}, '[A-Za-z]') then 'mixed' when regexp_matches(coalesce({c},''), '[ऀ-ॿ]') then 'hi' else 'en' end"
_FOLD = "regexp_replace(translate(lower(" + _STRIP + "), 'āīūēōṛṇṣḥṁ', 'aiueornshm'), '[^a-z0-9\\s]', '', 'g')"


def _sql_hindi(c: str) -> str:
    for whole, base in text.NUKTA.items():
        c = f"replace({c}, '{whole}', '{base}')"
    return _STRIP.format(c="regexp_replace(" + _STRIP.format(c=f"replace({c}, '़', '')") + ", '्+$', '')")


_HINDI = _sql_hindi("coalesce(word_hindi, '')")
_HASH = "md5(" + _SQ.format(c="coalesce(definition, '')") + ")"
_QUALITY = f"(case {_LANG.format(c='definition')} when 'en' then 200 when 'mixed' then 100 else 0 end + length(coalesce(definition,'')) + case when source='WordNet' then 100 else 0 end + {{ex}} - case when coalesce(definition,'')='' then 500 else 0 end)::BIGINT"


_TERMS = "select distinct trim(" + _FOLD.format(c="term") + ") term from blocklist where trim(" + _FOLD.format(c="term") + ") <> ''"


@query(f"select {_LANG.format(c='definition')} lang, regexp_matches(coalesce(definition,''), '[ऀ-ॿ]') devanagari, count(*)::BIGINT n from entries group by all")
def c01_script_class(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf, "definition")
    return e.groupBy(text.definition_lang(F.col("definition")).alias("lang"), text.has_devanagari(F.col("definition")).alias("devanagari")).agg(F.count("*").alias("n"))


@query(f"select rec_id, {_sql_hindi('word_hindi')} hindi from entries")
def c03_norm_hindi(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", text.normalize_hindi(F.col("word_hindi")).alias("hindi"))


@query(r"select rec_id, trim(regexp_replace(regexp_replace(lower(word_hinglish_roman), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) roman from entries")
def c04_norm_roman(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", text.normalize_roman(F.col("word_hinglish_roman")).alias("roman"))


@query("select rec_id, md5(" + _SQ.format(c="definition") + ") h from entries")
def c05_def_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", text.definition_hash(F.col("definition")).alias("h"))


@query(f"select count(*)::BIGINT pairs, count(*) filter (where {_sql_hindi('word_hindi')} = {_sql_hindi('head_word')})::BIGINT variants from entries where word_hindi is not null and head_word is not null")
def c06_variants(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf, "word_hindi", "head_word").where("word_hindi is not null and head_word is not null")
    return e.agg(F.count("*").alias("pairs"), F.count_if(text.is_variant(F.col("word_hindi"), F.col("head_word"))).alias("variants"))


_SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _map(d: dict[str, str]) -> str:
    return "map {" + ", ".join(f"'{k}': '{v}'" for k, v in d.items()) + "}"


def _roman_ctes(texts: str) -> str:
    """CTEs that end in ``roman`` (x, r): the distinct Devanagari texts of the query ``texts`` (x), romanized character by character."""
    pairs = list(translit.NUKTA_CONSONANTS.items())
    word = "nfc_normalize(w)"
    for i, (pair, _) in enumerate(pairs):
        word = f"replace({word}, '{pair}', '{chr(0xE000 + i)}')"
    plain, signs, vowels = "".join(translit.CONSONANTS), "".join(translit.SIGNS), "".join(translit.VOWELS)
    any_ = plain + "".join(chr(0xE000 + i) for i in range(len(pairs)))
    letters = translit.CONSONANTS | {chr(0xE000 + i): v for i, (_, v) in enumerate(pairs)}
    thrice = "w4"
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        thrice = f"regexp_replace({thrice}, '{c}{{3,}}', '{c}{c}', 'g')"
    has = lambda chars, c: f"({c} <> '' and contains('{chars}', {c}))"
    return f"""txt as (select distinct x from ({texts}) where regexp_matches(x, '[ऀ-ॿ]')),
tok as (select x, i, t[i] w from (select x, regexp_extract_all(x, '[{_SPACE}]+|[,.?!;:\\-()+]|[^{_SPACE},.?!;:\\-()+]+') t from txt), unnest(range(1, len(t) + 1)) u(i)),
wrd as (select w, {word} s, nfc_normalize(w) n from (select distinct w from tok where regexp_full_match(w, '[ऀ-ॿ]+'))),
chr as (select w, i, substr(s, i, 1) c, case when i > 1 then substr(s, i - 1, 1) else '' end p, case when i < length(s) then substr(s, i + 1, 1) else '' end q from wrd, unnest(range(1, length(s) + 1)) u(i)),
syl as (select w, i, case when {has(any_, 'c')} then {_map(letters)}[c] || case when {has(signs + '्', 'q')} then '' when {has(plain, 'c')} and (p = '' or {has(vowels, 'p')}) or not {has(any_, 'q')} then 'a' else '' end
 when {has(signs, 'c')} then case when {has(any_, 'p')} then {_map(translit.SIGNS)}[c] else '' end when c in ('ं', 'ँ') then '\ue100' else coalesce({_map(translit.VOWELS | translit.OTHERS)}[c], '') end o from chr),
lat as (select w, n, replace(replace(regexp_replace(string_agg(o, '' order by i), '\ue100([pbm])', 'm\\1', 'g'), '\ue100', 'n'), 'jny', 'gy') l from syl join wrd using (w) group by w, n),
fin as (select w, case when regexp_matches(n, '[{plain}][।॥॰]*$') then regexp_replace(v, 'a$', '') else v end w1 from (select *, substr(l, 1, 1) || replace(substr(l, 2), 'v', 'w') v from lat)),
rom as (select w, trim({thrice}) r from (select w, regexp_replace(regexp_replace(regexp_replace(w1, 'aa$', 'a'), 'ee$', 'i'), 'oo$', 'u') w4 from fin)),
roman as (select x, string_agg(coalesce(r, w), '' order by i) r from tok left join rom using (w) group by x)"""


def _iso_sql(c: str) -> str:
    for pattern, to in text.ISO_STEPS:
        pattern, to = pattern.replace("(?=[aeiou])", "([aeiou])"), to + "\\1" if "(?=" in pattern else to
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    c = f"array_to_string(list_transform(string_split({c}, ' '), lambda w: case when lower(w) in ('vakeel','vyapaari','vyaapaar') then w else substr(w,1,1) || replace(substr(w,2), 'v', 'w') end), ' ')"
    for pattern, to in text.ISO_ENDS:
        pattern, to = pattern.replace("(?=[^aeiou])", "([^aeiou])"), to + "\\1" if "(?=" in pattern else to
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    return c


def _iso_fixed(c: str) -> str:
    """SQL of the corrected spelling, for a column that holds _iso_sql's result."""
    return f"coalesce({_map(text.ISO_FIXES)}[lower({c})], regexp_replace(regexp_replace({c}, '\\s+', ' ', 'g'), '^ | $', '', 'g'))"


@query(f"with {_roman_ctes('select word_hindi x from entries union all select word_hindi from overrides')} select rec_id, word_hindi, coalesce(r, word_hindi, '') by_rule, coalesce(r, word_hindi, '') by_fallback from (select rec_id, word_hindi from entries union all select null, word_hindi from overrides) left join roman on x = word_hindi")
def c08_translit(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords of entries and overrides by rule; a back end that isn't there falls back to the rules."""
    words = _entries(spark, sf, "rec_id", "word_hindi").unionByName(table(spark, sf, "overrides").select(F.lit(None).cast("long").alias("rec_id"), "word_hindi"))
    return words.select("rec_id", "word_hindi", translit.romanize(F.col("word_hindi")).alias("by_rule"), translit.transliterate(F.col("word_hindi"), "no such engine").alias("by_fallback"))


@query("select rec_id, list_aggregate(list_transform(string_split(word_hinglish_roman, ' '), lambda w: case when lower(w) in ('vakeel','vyapaari','vyaapaar') then w else substr(w,1,1) || replace(substr(w,2), 'v', 'w') end), 'string_agg', ' ') r from entries where word_hinglish_roman is not null")
def c09_v_to_w(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).where("word_hinglish_roman is not null").select("rec_id", text.v_to_w(F.col("word_hinglish_roman")).alias("r"))


@query(f"select rec_id, x word_hindi, {_iso_fixed('i')} roman from (select rec_id, word_hindi x, {_iso_sql('word_hindi')} i from entries where regexp_matches(word_hindi, '[a-zāīūśṭḍṇ]'))")
def c10_iso_roman(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords in scholarly Latin, in common spelling."""
    return _entries(spark, sf).where(F.col("word_hindi").rlike("[a-zāīūśṭḍṇ]")).select("rec_id", "word_hindi", text.iso_to_common(F.col("word_hindi")).alias("roman"))


@query("select rec_id, " + _FOLD.format(c="definition") + " t from entries")
def c12_norm_text(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", text.normalize_safety(F.col("definition")).alias("t"))




@query(f"with t as ({_TERMS}) select rec_id, coalesce(list_has_any(string_split_regex(trim({_FOLD.format(c='word_hinglish_roman')}), '\\s+'), (select list(term) from t)), false) profane from entries")
def c13_token_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = safety.flag_entries(_entries(spark, sf, "rec_id", "word_hinglish_roman"), table(spark, sf, "blocklist"))
    return flagged.select("rec_id", F.col("profanity").alias("profane"))


@query("select rec_id, lower(" + _STRIP.format(c="word_hinglish_roman") + ") w, case when c >= 1.0 then 255 when c <= 0.30::DOUBLE then 1 else trunc(1 + (c - 0.3::DOUBLE) / 0.7::DOUBLE * 254) end::BIGINT freq from (select *, confidence_score c from entries) where c between 0 and 1")
def c15_freq(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).where("confidence_score between 0 and 1").select("rec_id", text.keyboard_word(F.col("word_hinglish_roman")).alias("w"), score.frequency(F.col("confidence_score")).alias("freq"))


@query(f"select rec_id, coalesce(len(list_filter(string_split_regex({_STRIP.format(c='definition')}, '\\s+'), lambda t: t <> '')), -1)::BIGINT n from entries")
def c16_query_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", F.coalesce(F.size(text.query_tokens(F.col("definition"))).cast("long"), F.lit(-1)).alias("n"))


@query("select rec_id, coalesce(contains(lower(tags), 'loan w'), false) literal, coalesce(tags ilike '%of_persons%', false) pattern, coalesce(contains(lower(tags), 'of_persons'), false) escaped from entries")
def c18_like_literal(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("tags")
    return _entries(spark, sf).select("rec_id", text.contains_literal(c, "Loan W").alias("literal"), F.coalesce(c.ilike("%of_persons%"), F.lit(False)).alias("pattern"), text.contains_literal(c, "of_persons").alias("escaped"))


_DIFF = """with o as (select word_hindi, min(roman) e from overrides where trim(roman) <> '' group by 1),
p as (select lower(trim(coalesce(word_hinglish_roman,''))) a, e from entries join o using (word_hindi)),
d as (select a, e, list_filter(list_transform(range(1, least(length(a), length(e)) + 1), lambda i: case when substr(a, i, 1) <> substr(e, i, 1) then substr(a, i, 1) || substr(e, i, 1) else '' end), lambda x: x <> '') ds from p),
k as (select *, len(list_filter(ds, lambda x: x in ('vw','wv'))) > 0 vw, len(list_filter(ds, lambda x: regexp_matches(x, '^[aeiou][aeiou]$'))) > 0 vo from d)
select case when length(a) = length(e) then case when len(ds) = 0 then 'none' when vw and vo then 'v_w_and_vowel' when vw then 'v_w' when vo then 'vowel_length' else 'other_consonant' end
 when rtrim(a, 'a') = rtrim(e, 'a') then 'trailing_schwa' when length(a) < length(e) - 1 then 'missing_chars' when length(a) > length(e) + 1 then 'extra_chars' else 'length_mismatch' end kind, count(*)::BIGINT n from k group by 1"""


@query(_DIFF)
def c21_diff_class(spark: SparkSession, sf: str) -> DataFrame:
    return stats.romanization_audit(_entries(spark, sf, "word_hindi", "word_hinglish_roman"), table(spark, sf, "overrides"))


@query("select rec_id, " + _QUALITY.format(ex="case when coalesce(example_sentence,'') <> '' then 50 else 0 end") + " q from entries")
def c22_quality(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", score.quality(F.col("definition"), F.col("source"), F.col("example_sentence")).alias("q"))


@query("""select rec_id, round(least(greatest(case when sev >= 0.5 then least(s, 0.3::DOUBLE) else s end, 0), 1), 6) c from (select rec_id, coalesce(case when isnan(severity_score) then 0 else severity_score end, 0) sev,
 (case source when 'WordNet' then 0.95::DOUBLE when 'Wiktionary' then 0.85::DOUBLE else 0.70::DOUBLE end) * (case when regexp_matches(coalesce(word_hindi,''), '[ऀ-ॿ]') then 0.75::DOUBLE else 0.92::DOUBLE end)
 * (1.0::DOUBLE + 0.03::DOUBLE * (greatest(len(list_distinct(coalesce(sources, [source]))), 1) - 1))
 * (case when coalesce(definition_hi,'') <> '' and coalesce(definition_en,'') <> '' then 1.05::DOUBLE when coalesce(definition_en,'') <> '' then 1.03::DOUBLE when coalesce(definition_hi,'') <> '' and coalesce(example_sentence,'') <> '' then 1.02::DOUBLE else 1.0::DOUBLE end) s from entries)""")
def c23_confidence(spark: SparkSession, sf: str) -> DataFrame:
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    method = F.when(text.has_devanagari(F.col("word_hindi")), "rule").otherwise("iso")
    c = score.confidence(F.col("source"), method, stats.n_sources(), filled("definition_hi"), filled("definition_en"), filled("example_sentence"), stats.severity())
    return _entries(spark, sf).select("rec_id", F.round(c, 6).alias("c"))


@query("select doc_id, least((contains(t,'hate')::INT + contains(t,'kill')::INT + contains(t,'die')::INT + contains(t,'stupid')::INT + contains(t,'idiot')::INT) * 0.3::DOUBLE, 1.0) s from (select doc_id, lower(coalesce(text,'')) t from documents)")
def c25_heuristic(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", score.heuristic_toxicity(F.col("text"), ("hate", "kill", "die", "stupid", "idiot")).alias("s"))


@query("select rec_id, coalesce(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|'), '') examples from (select rec_id, list_concat(coalesce(all_examples, []), case when coalesce(example_sentence,'') = '' then [] else [example_sentence] end) l from entries)")
def c27_ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    empty = F.array().cast("array<string>")
    own = F.when(F.coalesce("example_sentence", F.lit("")) == "", empty).otherwise(F.array("example_sentence"))
    return _entries(spark, sf).select("rec_id", F.array_join(F.array_union(F.coalesce("all_examples", empty), own), "|").alias("examples"))


@query(f"with t as ({_TERMS}) select rec_id, case when coalesce(list_has_any(string_split_regex(regexp_replace({_FOLD.format(c="concat_ws(' ', word_hindi, definition, array_to_string(all_examples, ' '))")}, '^ +| +$', '', 'g'), '\\s+'), (select list(term) from t)), false) then 1.0::DOUBLE else 0.0::DOUBLE end severity from entries")
def c24_severity(spark: SparkSession, sf: str) -> DataFrame:
    """Severity of headword, gloss and examples together."""
    terms = [r.term for r in safety.term_set(table(spark, sf, "blocklist")).limit(safety.INLINE_TERMS + 1).collect()]
    if len(terms) > safety.INLINE_TERMS:
        raise ValueError("a list this long must be joined")
    return _entries(spark, sf).select("rec_id", safety.score_severity(F.col("word_hindi"), F.col("definition"), F.array_join("all_examples", " "), terms).alias("severity"))


@query("select rec_id, replace(replace(replace(replace(replace(definition, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;') escaped, coalesce(array_to_string(all_examples, ', '), '') examples, printf('%.2f', floor(confidence_score * 100) / 100) score from entries")
def c26_formats(spark: SparkSession, sf: str) -> DataFrame:
    """HTML escapes, lists as text, scores to two places."""
    c = _entries(spark, sf)
    return c.select("rec_id", writers.html_escape(F.col("definition")).alias("escaped"), writers.flat("all_examples").alias("examples"), F.when(F.col("confidence_score").isNotNull(), F.format_string("%.2f", F.floor(F.col("confidence_score") * 100).cast("double") / 100)).alias("score"))


@query("select rec_id, coalesce(nullif(definition_en,''), nullif(definition_hinglish,''), nullif(definition,''), '') p, regexp_replace(definition, '(market)', '<mark>\\1</mark>', 'gi') h from entries")
def c28_preview(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("rec_id", text.preview(F.col("definition_en"), F.col("definition_hinglish"), F.col("definition")).alias("p"), text.highlight(F.col("definition"), "Market").alias("h"))


# --- sources ----------------------------------------------------------------------
@query("""select synset_id::BIGINT synset_id, array_to_string(list_filter(list_transform(words, lambda w: trim(w)), lambda w: w <> ''), '|') words, coalesce(gloss,'') gloss, array_to_string(coalesce(examples, []), '|') examples, trim(pos) pos
 from synsets where coalesce(trim(pos), '') <> ''""")
def a01_synset_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Synsets written as tab-separated lines and parsed again; lines without a part of speech are dropped by the parser."""
    s = table(spark, sf, "synsets")
    quoted = F.array_join(F.transform(F.coalesce("examples", F.array().cast("array<string>")), lambda x: F.concat(F.lit('"'), x, F.lit('"'))), "  /  ")
    gloss = F.concat(F.coalesce("gloss", F.lit("")), F.when(F.size(F.coalesce("examples", F.array())) > 0, F.concat(F.lit(":"), quoted)).otherwise(""))
    line = F.concat_ws("\t", F.col("synset_id").cast("string"), F.array_join("words", ","), gloss, F.coalesce("pos", F.lit("")))
    p = dictionaries.parse_synsets(s.select(line.alias("value")))
    return p.select(_long(F.col("synset_id")).alias("synset_id"), F.array_join("words", "|").alias("words"), "gloss", F.array_join("examples", "|").alias("examples"), "pos")


@query("select synset_id::BIGINT synset_id, (i - 1)::BIGINT place, words[i] word, words[1] head from (select synset_id, words, unnest(range(1, len(words) + 1)) i from synsets)")
def a03_explode(spark: SparkSession, sf: str) -> DataFrame:
    e = dictionaries.synset_entries(table(spark, sf, "synsets"))
    return e.select(_long(F.col("synset_id")).alias("synset_id"), _long(F.col("pos_in_synset")).alias("place"), F.col("word_hindi").alias("word"), F.col("head_word").alias("head"))


_LINES = "(select line_no, line::JSON j from wiktionary_lines where json_valid(line) and trim(line) <> '')"


@query(f"select line_no, j->>'word' word, coalesce(len(j->'$.senses[*]'), 0)::BIGINT senses from {_LINES} where j->>'lang_code' = 'hi' and not list_contains(json_keys(j), 'redirect')")
def a05_json_filter(spark: SparkSession, sf: str) -> DataFrame:
    w = dictionaries.parse_dictionary_lines(table(spark, sf, "wiktionary_lines"))
    return w.select("line_no", "word", _long(F.greatest(F.coalesce(F.size("senses"), F.lit(0)), F.lit(0))).alias("senses"))


@query(f"""select line_no, (i - 1)::BIGINT place, d definition, len(coalesce(s->'$.synonyms[*]', []))::BIGINT synonyms from (select line_no, i, s, coalesce(s->>'$.glosses[0]', regexp_replace(s->>'$.raw_glosses[0]', '\\([^)]*\\)\\s*', '', 'g'), '') d from
 (select line_no, i, (j->'$.senses[*]')[i] s from (select line_no, j, unnest(range(1, len(j->'$.senses[*]') + 1)) i from {_LINES} where j->>'lang_code' = 'hi' and not list_contains(json_keys(j), 'redirect')))) where d <> ''""")
def a10_senses(spark: SparkSession, sf: str) -> DataFrame:
    e = dictionaries.dictionary_entries(dictionaries.parse_dictionary_lines(table(spark, sf, "wiktionary_lines")))
    return e.select("line_no", F.element_at(F.split("id", "-"), -1).cast("long").alias("place"), "definition", _long(F.greatest(F.coalesce(F.size("synonyms"), F.lit(0)), F.lit(0))).alias("synonyms"))


#: (line_no, i, word, pos, roman, definition, example, id) of every sense that has a definition.
_SENSES_SQL = f"""select line_no, i - 1 i, coalesce(j->>'word', '') word, coalesce(j->>'pos', '') pos, coalesce(roman, '') roman, d definition, coalesce(e, '') example, format('WK-{{}}-{{}}-{{}}', coalesce(j->>'word', ''), coalesce(j->>'pos', ''), i - 1) id from
 (select line_no, i, j, coalesce(s->>'$.glosses[0]', regexp_replace(s->>'$.raw_glosses[0]', '\\([^)]*\\)\\s*', '', 'g'), '') d,
 case when len(tagged) > 0 then tagged[1]->>'form' else list_filter(fs, lambda f: regexp_full_match(json_extract_string(f, '$.form'), '[\\x00-\\x7f]+'))[1]->>'form' end roman,
 list_filter(list_transform(json_extract(s, '$.examples[*]'), lambda x: case when json_type(x) = 'OBJECT' then case when coalesce(json_extract_string(x, '$.text'), '') <> '' then json_extract_string(x, '$.text') || case when coalesce(json_extract_string(x, '$.translation'), '') <> '' then ' (' || json_extract_string(x, '$.translation') || ')' else '' end end else json_extract_string(x, '$') end), lambda x: x is not null)[1] e
 from (select *, list_filter(fs, lambda f: list_has_any(coalesce(json_extract(f, '$.tags')::VARCHAR[], []), ['romanization', 'roman'])) tagged from
 (select line_no, i, j, (j->'$.senses[*]')[i] s, j->'$.forms[*]' fs from (select line_no, j, unnest(range(1, len(j->'$.senses[*]') + 1)) i from {_LINES} where j->>'lang_code' = 'hi' and not list_contains(json_keys(j), 'redirect'))))) where d <> ''"""


@query(f"select line_no, id, roman word_hinglish_roman, example example_sentence from ({_SENSES_SQL})")
def a08_roman_and_example(spark: SparkSession, sf: str) -> DataFrame:
    """Romanization, example and id of every sense."""
    e = dictionaries.dictionary_entries(dictionaries.parse_dictionary_lines(table(spark, sf, "wiktionary_lines")))
    return e.select("line_no", "id", "word_hinglish_roman", "example_sentence")


@query("select coalesce(trim(word_hindi), '') word_hindi, coalesce(trim(roman), '') roman from overrides where trim(coalesce(word_hindi, '')) <> ''")
def a11_alias_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose columns have other names, under the lexicon's."""
    odd = table(spark, sf, "overrides").select(F.col("word_hindi").alias(" Hindi "), F.col("roman").alias("ROMAN"))
    return dictionaries.aliased(odd).select("word_hindi", F.col("word_hinglish_roman").alias("roman"))


@query(_TERMS)
def a15_terms(spark: SparkSession, sf: str) -> DataFrame:
    return safety.term_set(table(spark, sf, "blocklist"))


# --- joins ------------------------------------------------------------------------
_KEYS = f"select *, {_HINDI} h, {_HASH} d from entries"


@query(f"""with k as ({_KEYS}), p as (select * from k where source = 'WordNet'), s as (select * from k where source <> 'WordNet'),
f as (select h, d, min(rec_id) rec_id from p group by 1, 2), g as (select h, d, count(*) n, arg_min(all_examples[1], rec_id) filter (where coalesce(all_examples[1],'') <> '') x from s group by 1, 2),
own as (select h, d, rec_id, 0 late from f union all select s.h, s.d, s.rec_id, 1 from s join f on f.h = s.h and f.d = s.d),
it as (select h, d, late, rec_id, field, vs[i] v, i from (select own.h, own.d, late, rec_id, field, case when field = 's' then synsets else all_examples end vs, unnest(range(1, len(case when field = 's' then synsets else all_examples end) + 1)) i from own join k using (rec_id), (values ('s'), ('x')) t(field))),
li as (select h, d, field, string_agg(v, '|' order by o) l from (select h, d, field, v, min([late, rec_id, i]) o from it where late = 0 or field = 's' or coalesce(v, '') <> '' group by 1, 2, 3, 4) group by 1, 2, 3)
select p.rec_id ord, p.id, p.definition, 'primary' origin, coalesce(g.n, 0)::BIGINT n_merged, coalesce(nullif(p.example_sentence, ''), g.x, '') example_sentence,
 case when f.rec_id is null then coalesce(array_to_string(list_filter(p.synsets, lambda y, i: list_position(p.synsets, y) = i), '|'), '') else coalesce(a.l, '') end synsets,
 case when f.rec_id is null then coalesce(array_to_string(list_filter(p.all_examples, lambda y, i: list_position(p.all_examples, y) = i), '|'), '') else coalesce(z.l, '') end all_examples
 from p left join f on f.rec_id = p.rec_id left join g on g.h = f.h and g.d = f.d left join li a on a.h = f.h and a.d = f.d and a.field = 's' left join li z on z.h = f.h and z.d = f.d and z.field = 'x'
union all select rec_id, id, definition, 'secondary', 0::BIGINT, coalesce(example_sentence,''), coalesce(array_to_string(synsets, '|'), ''), coalesce(array_to_string(all_examples, '|'), '') from s where not exists (select 1 from f where f.h = s.h and f.d = s.d)""")
def e01_merge_first_match(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf)
    m = merge.merge_dictionaries(e.where("source = 'WordNet'"), e.where("source <> 'WordNet'"))
    text_of = lambda c: F.coalesce(F.array_join(c, "|"), F.lit("")).alias(c)
    return m.select(F.col("rec_id").alias("ord"), "id", "definition", "origin", "n_merged", "example_sentence", text_of("synsets"), text_of("all_examples"))


@query()
def e02_fuzzy_best(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf, "rec_id", "word_hindi", "word_hinglish_roman", "source")
    return merge.fuzzy_best(e.where("not (source <=> 'WordNet')"), e.where("source = 'WordNet'"))


_ROMAN_VALUE = f"""case when o.r is not null then o.r when d then coalesce(k.r, word_hindi) when h and not regexp_matches(word_hinglish_roman, '[ऀ-ॿ]') then {_iso_fixed('i')} when h then coalesce(m.r, word_hinglish_roman) else coalesce(word_hinglish_roman, '') end"""


def _romanized_sql(columns: str, entries: str = "entries") -> str:
    """SQL of the headwords' romanization, with its method as ``how``, and other columns of the entries."""
    return f"""with {_roman_ctes(f'select word_hindi x from {entries} union all select word_hinglish_roman from {entries}')},
o as (select word_hindi w, min(roman) r from overrides where trim(roman) <> '' group by 1),
e as (select *, coalesce(regexp_matches(word_hindi, '[ऀ-ॿ]'), false) d, coalesce(trim(word_hinglish_roman), '') <> '' h, {_iso_sql('word_hinglish_roman')} i from {entries})
select {columns}, case when o.r is not null then 'common_word' when d then 'rule' when h and not regexp_matches(word_hinglish_roman, '[ऀ-ॿ]') then 'iso' else 'rule' end how, {_ROMAN_VALUE} r
 from e left join o on o.w = word_hindi left join roman k on k.x = word_hindi left join roman m on m.x = word_hinglish_roman"""


@query(_romanized_sql("rec_id"))
def e03_override_join(spark: SparkSession, sf: str) -> DataFrame:
    out = lookup.romanize_headwords(spread(_entries(spark, sf, "rec_id", "word_hindi", "word_hinglish_roman")), table(spark, sf, "overrides"))
    return out.select("rec_id", F.col("_romanization_method").alias("how"), F.col("word_hinglish_roman").alias("r"))


@query(f"""with {_roman_ctes('select definition x from entries union all select example_sentence from entries')}
select rec_id, case when regexp_matches(definition, '[ऀ-ॿ]') then d.r when definition <> '' then {_iso_fixed('i')} end definition_hinglish, e.r example_hinglish
 from (select *, {_iso_sql('definition')} i from entries) left join roman d on d.x = definition left join roman e on e.x = example_sentence""")
def p01_transliterate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Definitions and examples in Latin letters."""
    return lookup.romanize_texts(spread(_entries(spark, sf, "rec_id", "definition", "example_sentence"))).select("rec_id", "definition_hinglish", "example_hinglish")


_MEM = "select synset, id, min(rec_id) ord, min(pos) pos from (select id, rec_id, synsets[i] synset, i - 1 pos from (select id, rec_id, synsets, unnest(range(1, len(synsets) + 1)) i from entries)) group by 1, 2"


@query(f"""with m as ({_MEM}), p as (select a.id entry_id, b.id related_entry_id, min((a.pos, b.ord)) o from m a join m b using (synset) where a.id <> b.id group by 1, 2)
select entry_id, related_entry_id, rn::BIGINT rank from (select *, row_number() over (partition by entry_id order by o, related_entry_id) rn from p) where rn <= 20""")
def e05_same_synset(spark: SparkSession, sf: str) -> DataFrame:
    return graph.same_synset(_entries(spark, sf, "id", "rec_id", "synsets"))


@query(f"""with m as ({_MEM}), e as (select distinct 'iwn-' || child_synset child, 'iwn-' || parent_synset parent from hypernymy where child_synset is not null and parent_synset is not null),
b as (select child synset, parent other, 'broader' relation_type from e union all select parent, child, 'narrower' from e),
p as (select a.id entry_id, relation_type, z.id related_entry_id, min(z.ord) o from m a join b using (synset) join m z on z.synset = b.other where a.id <> z.id group by all)
select entry_id, related_entry_id, relation_type, rn::BIGINT rank from (select *, row_number() over (partition by entry_id, relation_type order by o, related_entry_id) rn from p) where rn <= 20""")
def e06_broader_narrower(spark: SparkSession, sf: str) -> DataFrame:
    return graph.broader_narrower(_entries(spark, sf, "id", "rec_id", "synsets"), table(spark, sf, "hypernymy"))


_EDGES = "select distinct entry_id, related_entry_id, lower(trim(relation_type)) relation_type from related_words where entry_id <> related_entry_id and entry_id in (select id from entries) and related_entry_id in (select id from entries)"


@query(f"""with c as ({_EDGES}), n as (select id, min(coalesce(word_hinglish_roman,'')) roman from entries group by 1)
select entry_id, relation_type, related_entry_id, roman, rn::BIGINT rank from (select c.*, roman, row_number() over (partition by entry_id, relation_type order by roman, related_entry_id) rn from c join n on n.id = related_entry_id) where rn <= 20""")
def e08_related_topk(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf, "id", "word_hinglish_roman")
    return graph.related_top(graph.clean_relations(table(spark, sf, "related_words"), e), e)


@query(_EDGES)
def e09_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return graph.clean_relations(table(spark, sf, "related_words"), _entries(spark, sf, "id"))


@query("select distinct x id from (select unnest([entry_id, related_entry_id]) x from related_words) where x is not null and x not in (select id from entries)")
def e10_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return graph.orphans(table(spark, sf, "related_words"), _entries(spark, sf, "id"))


@query(f"with c as ({_EDGES}) select * from c where not exists (select 1 from c r where r.entry_id = c.related_entry_id and r.related_entry_id = c.entry_id and r.relation_type = case c.relation_type when 'broader' then 'narrower' when 'narrower' then 'broader' else c.relation_type end)")
def e11_one_sided(spark: SparkSession, sf: str) -> DataFrame:
    return graph.one_sided(graph.clean_relations(table(spark, sf, "related_words"), _entries(spark, sf, "id")))


@query("select related_entry_id, relation_type from related_words where entry_id = (select min(entry_id) from related_words where relation_type = 'broader')")
def e12_scalar_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """The links of one entry, which a subquery names."""
    r = table(spark, sf, "related_words")
    first = r.where("relation_type = 'broader'").agg(F.min("entry_id")).scalar()
    return r.where(F.col("entry_id") == first).select("related_entry_id", "relation_type")


# --- aggregations -----------------------------------------------------------------
_BUCKET = "floor(confidence_score * 100 + 1e-9)::BIGINT"


@query(f"""with x as (select source, coalesce(part_of_speech,'') pos, {_LANG.format(c='definition')} lang, case when confidence_score between 0 and 1 then {_BUCKET}::VARCHAR else 'none' end bucket, case when len(list_distinct(coalesce(sources, [source]))) > 1 then 'true' else 'false' end multi from entries)
select metric, value, count(*)::BIGINT n from (select 'source' metric, source as value from x union all select 'pos', pos from x union all select 'lang', lang from x union all select 'confidence', bucket from x union all select 'multi_source', multi from x) group by all""")
def f01_meta_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.meta(_entries(spark, sf))


@query(f"select 'total' metric, count(*)::BIGINT n from entries union all select 'safe', count(*) filter (where {_SAFE}) from entries union all select 'toxic', count(*) filter (where not {_SAFE}) from entries union all select 'relations', count(*) from related_words")
def f02_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stats(_entries(spark, sf), table(spark, sf, "related_words"))


@query("select part_of_speech pos, count(*)::BIGINT n from entries where coalesce(part_of_speech,'') <> '' group by 1 order by 2 desc, 1 limit 15")
def f02_top_pos(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_pos(_entries(spark, sf))


@query("""select roman, hindi, tier::INT tier from (select *, case when lower(roman) = 'bha' then 0 when lower(hindi) = 'bha' then 1 when starts_with(lower(roman), 'bha') then 2 else 3 end tier from
 (select word_hinglish_roman roman, coalesce(arg_min(coalesce(word_hindi,''), rec_id), '') hindi from entries where (starts_with(lower(coalesce(word_hinglish_roman,'')), 'bha') or starts_with(lower(coalesce(word_hindi,'')), 'bha')) and coalesce(word_hinglish_roman,'') <> '' group by 1)) order by tier, length(roman), roman limit 8""")
def f03_suggest(spark: SparkSession, sf: str) -> DataFrame:
    return search.suggest(_entries(spark, sf), "Bha")


@query(f"""select bucket, count(*)::BIGINT n, round(count(*) / sum(count(*)) over (), 6) "share", round(avg((sev >= 0.5)::INT), 6) with_toxicity, round(avg(length(d)), 6) avg_definition, round(avg((coalesce(example_sentence,'') <> '')::INT), 6) with_example, round(avg(regexp_matches(d, '[ऀ-ॿ]')::INT), 6) with_devanagari,
 round(avg((coalesce(definition_hi,'') <> '' and coalesce(definition_en,'') <> '')::INT), 6) complete from (select *, {_BUCKET} bucket, coalesce(definition,'') d, coalesce(case when isnan(severity_score) then 0 else severity_score end, 0) sev from entries where confidence_score between 0 and 1) group by 1""")
def f05_conf_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return stats.confidence_audit(_entries(spark, sf))


@query(f"select bucket, source, n, rn::BIGINT rank from (select *, row_number() over (partition by bucket order by n desc, source) rn from (select {_BUCKET} bucket, source, count(*)::BIGINT n from entries where confidence_score between 0 and 1 group by 1, 2)) where rn <= 5")
def f05_bucket_sources(spark: SparkSession, sf: str) -> DataFrame:
    return stats.bucket_sources(_entries(spark, sf))


@query("select floor(coalesce(case when isnan(severity_score) then 0 else severity_score end, 0) * 10 + 1e-9)::BIGINT tenth, count(*)::BIGINT n from entries group by 1")
def f06_severity(spark: SparkSession, sf: str) -> DataFrame:
    return stats.severity_histogram(_entries(spark, sf))


@query(f"""with t as ({_TERMS}), w as (select rec_id, trim({_FOLD.format(c="coalesce(word_hinglish_roman,'')")}) head, unnest(list_distinct(string_split_regex(trim({_FOLD.format(c="concat_ws(' ', definition, example_sentence)")}), '\\s+'))) term from entries where {_SAFE})
select rec_id, min(w.term) term from w join t on w.term = t.term where w.term <> head group by 1""")
def f06_false_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return stats.false_negatives(_entries(spark, sf), table(spark, sf, "blocklist"))


@query(f"""with t as ({_TERMS}) select term, n from (select trim({_FOLD.format(c="coalesce(word_hinglish_roman,'')")}) term, count(*)::BIGINT n from entries where profanity group by 1) where term <> '' and n >= 2 and term not in (select term from t)""")
def f06_suggested_terms(spark: SparkSession, sf: str) -> DataFrame:
    return stats.suggested_terms(_entries(spark, sf), table(spark, sf, "blocklist"), 2)


@query("select count(*) filter (where trim(r) = '')::BIGINT missing, count(*) filter (where regexp_matches(r, '[À-ɏ\\x{300}-\\x{36f}]'))::BIGINT accented, count(*) filter (where regexp_matches(r, '[ऀ-ॿ]'))::BIGINT devanagari from (select coalesce(word_hinglish_roman,'') r from entries)")
def f07_roman_health(spark: SparkSession, sf: str) -> DataFrame:
    return stats.roman_health(_entries(spark, sf))


@query("""with w as (select word_hindi, min(roman) e from overrides where trim(roman) <> '' group by 1), g as (select e, lower(trim(coalesce(word_hinglish_roman,''))) a from entries left join w using (word_hindi)),
t as (select count(*)::BIGINT entries, count(e)::BIGINT covered, count(*) filter (where a = e)::BIGINT passed from g) select *, covered - passed failed, round(covered / entries, 6) coverage, round(passed / covered, 6) pass_rate from t""")
def f07_transliteration(spark: SparkSession, sf: str) -> DataFrame:
    return stats.romanization_summary(_entries(spark, sf, "word_hindi", "word_hinglish_roman"), table(spark, sf, "overrides"))


# the fold, row by row
_FOLD_CTES = f"""b as (select word_hinglish_roman roman, rec_id ord, coalesce(definition,'') d, coalesce(word_hindi,'') w, coalesce(example_sentence,'') ex, coalesce(part_of_speech,'') pos, {_QUALITY.format(ex='0')} u,
 list_filter(coalesce(sources, [source]), lambda x, i: list_position(coalesce(sources, [source]), x) = i) ss, row_number() over (partition by word_hinglish_roman order by rec_id) i from entries where coalesce(word_hinglish_roman,'') <> ''),
f as (select roman, i, ord leader, [ord] ls, ss, u, ex, pos, d, w, null::VARCHAR hi, null::VARCHAR en, 1 n from b where i = 1
 union all select f.roman, b.i, case when win then b.ord else f.leader end, case when win then list_concat([b.ord], f.ls) else f.ls end,
 case when win then list_concat(b.ss, list_filter(f.ss, lambda x: not list_contains(b.ss, x))) else list_concat(f.ss, list_filter(b.ss, lambda x: not list_contains(f.ss, x))) end, case when win then b.u else f.u end, case when win then coalesce(nullif(b.ex,''), f.ex) else coalesce(nullif(f.ex,''), b.ex) end, case when win then coalesce(nullif(b.pos,''), f.pos) else coalesce(nullif(f.pos,''), b.pos) end,
 case when win then b.d else f.d end, case when win then b.w else f.w end,
 case when win then {{hi_win}} else coalesce(f.hi, {{hi_stay}}) end, case when win then {{en_win}} else coalesce(f.en, {{en_stay}}) end, f.n + 1
 from f join b on b.roman = f.roman and b.i = f.i + 1, lateral (select b.u + case when b.ex <> '' then 50 else 0 end > f.u + case when f.ex <> '' then 50 else 0 end win)),
deduped as (select f.roman, leader, ls, n::BIGINT n_rows, w word_hindi, d definition, {_LANG.format(c='d')} definition_lang, ex example_sentence, pos part_of_speech, ss[1] source, array_to_string(ss, '|') sources,
 coalesce(hi, case when regexp_matches(d, '[ऀ-ॿ]') then d end) definition_hi, coalesce(en, case when {_LANG.format(c='d')} in ('en','mixed') then d end) definition_en
 from f join (select roman, max(i) i from f group by 1) l using (roman, i))"""


def _first_of(own: str, other: str, rx: str, word: str | None = None) -> str:
    return f"case when regexp_matches({own}, '{rx}') then {own} when regexp_matches({other}, '{rx}') then {other}" + (f" when regexp_matches({word}, '{rx}') then {word}" if word else "") + " end"


_DEV, _LAT = "[ऀ-ॿ]", "[A-Za-z]"
_FOLD_CTES = _FOLD_CTES.format(hi_win=_first_of("b.d", "f.d", _DEV, "b.w"), hi_stay=_first_of("f.d", "b.d", _DEV, "f.w"), en_win=_first_of("b.d", "f.d", _LAT), en_stay=_first_of("f.d", "b.d", _LAT))
_FOLD_SQL = f"with recursive {_FOLD_CTES} select * exclude (ls) from deduped"


def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_by_roman(_entries(spark, sf))


@query(_FOLD_SQL)
def f08_roman_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _dedup(spark, sf).withColumn("sources", F.array_join("sources", "|"))


@query(f"""with recursive {_FOLD_CTES}, x as (select word_hinglish_roman roman, rec_id, 'synsets' field, synsets v from entries union all select word_hinglish_roman, rec_id, 'all_examples', all_examples from entries),
y as (select roman, field, rec_id, v[i] item, (i - 1)::BIGINT pos from (select *, unnest(range(1, len(v) + 1)) i from x)),
z as (select roman, field, item, list_position(ls, rec_id) p, rec_id, pos from y join deduped using (roman) where coalesce(item, '') <> ''),
r as (select roman, field, item, min(case when p > 0 then [0, p::BIGINT, pos] else [1, rec_id, pos] end) o from z group by all)
select roman, field, item, o[1]::BIGINT late, o[2]::BIGINT as "at", o[3]::BIGINT pos from r""")
def f08_merged_lists(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.merged_lists(_entries(spark, sf), ["synsets", "all_examples"])


_DEDUPED = f"(select *, string_split(sources, '|') ss, len(string_split(sources, '|')) > 1 merged from ({_FOLD_SQL}))"


@query(f"""select count(*)::BIGINT total, count(*) filter (where merged)::BIGINT merged, count(*) filter (where merged and hi)::BIGINT with_hi, count(*) filter (where merged and en)::BIGINT with_en, count(*) filter (where merged and hi and en)::BIGINT with_both,
 count(*) filter (where merged and hi and en and definition_hi = definition_en)::BIGINT identical,
 count(*) filter (where merged and length(definition) < 20)::BIGINT thin, least(count(*) filter (where merged and length(definition) < 20), 30)::BIGINT thin_capped from (select *, coalesce(definition_hi,'') <> '' hi, coalesce(definition_en,'') <> '' en from {_DEDUPED})""")
def f04_merge_audit(spark: SparkSession, sf: str) -> DataFrame:
    return stats.merge_audit(_dedup(spark, sf))


@query(f"select array_to_string(list_sort(ss), ', ') sources, count(*)::BIGINT n from {_DEDUPED} where merged group by 1")
def f04_source_sets(spark: SparkSession, sf: str) -> DataFrame:
    return stats.source_sets(_dedup(spark, sf))


@query(f"""with recursive k as ({_KEYS}), g as (select h hindi, d def_hash, min(rec_id) leader, count(*)::BIGINT n_rows, max(confidence_score) confidence, coalesce(arg_min(example_sentence, rec_id) filter (where coalesce(example_sentence,'') <> ''), '') example_sentence from k group by 1, 2),
o as (select h, d, source, row_number() over (partition by h, d order by min(rec_id)) i from k where source is not null group by 1, 2, 3),
j as (select h, d, i, source sources from o where i = 1 union all select j.h, j.d, o.i, case when contains(j.sources, o.source) then j.sources else j.sources || '+' || o.source end from j join o on o.h = j.h and o.d = j.d and o.i = j.i + 1)
select g.*, coalesce(sources, '') sources from g left join (select h, d, arg_max(sources, i) sources from j group by 1, 2) x on x.h = g.hindi and x.d = g.def_hash""")
def f09_hash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_by_definition(_entries(spark, sf))


@query(f"""select w word, max(f)::BIGINT freq, 'hi_Latn' locale, arg_min(pos, rec_id) pos, min(rec_id) ord from (select rec_id, coalesce(part_of_speech,'') pos, lower({_STRIP.format(c="coalesce(word_hinglish_roman,'')")}) w,
 case when {_CONF} >= 1.0 then 255 when {_CONF} <= 0.30::DOUBLE then 1 else trunc(1 + ({_CONF} - 0.3::DOUBLE) / 0.7::DOUBLE * 254) end f from entries where {_SAFE}) where w <> '' and not regexp_matches(w, '[ऀ-ॿ]') group by 1""")
def f10_keyboard_dict(spark: SparkSession, sf: str) -> DataFrame:
    return writers.keyboard_rows(_entries(spark, sf))


_TIER = """(select *, case when lower(coalesce(word_hindi,'')) = '{q}' then 100 when lower(coalesce(word_hinglish_roman,'')) = '{q}' then 95 when contains(lower(word_hindi), '{q}') then 80 when contains(lower(word_hinglish_roman), '{q}') then 75 when contains(lower(definition), '{q}') then 50 end tier from entries)"""
_ORDER = f"order by tier desc, {_CONF} desc, rec_id"


@query(f"with p as (select * from {_TIER.format(q='market')} where tier is not null {_ORDER} limit 100) select 'pos' facet, part_of_speech as value, count(*)::BIGINT n from p where coalesce(part_of_speech,'') <> '' group by 2 union all select 'source', source, count(*)::BIGINT from p group by 2")
def f11_facets(spark: SparkSession, sf: str) -> DataFrame:
    return search.facets(search.tier_search(_entries(spark, sf), "market", 100))


@query(f"with e as ({_EDGES}) select count(distinct entry_id)::BIGINT entries, count(*)::BIGINT links from e")
def f12_enrichment_totals(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.clean_relations(table(spark, sf, "related_words"), _entries(spark, sf, "id"))
    return e.groupBy("entry_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("entries"), F.sum("n").alias("links"))


@query("select key, arg_max(id, rec_id) id, max(rec_id) ord from (select id, rec_id, unnest(list_distinct([lower(coalesce(word_hindi,'')), lower(coalesce(word_hinglish_roman,''))])) key from entries) where key <> '' group by 1")
def f13_hash_index(spark: SparkSession, sf: str) -> DataFrame:
    return search.hash_index(_entries(spark, sf))


@query(f"""with {_roman_ctes('select word_hindi x from overrides')}, p as (select string_split(r, ' ') a, string_split(lower(trim(o.roman)), ' ') e from overrides o join roman on x = word_hindi where trim(o.roman) <> '')
select r as "right", words, round(r / words, 6) accuracy from (select sum(len(list_filter(range(1, len(e) + 1), lambda i: a[i] = e[i])))::BIGINT r, sum(len(e))::BIGINT words from p)""")
def f14_word_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Romanization by rule against the given spellings, word by word."""
    o = table(spark, sf, "overrides").where((F.trim("roman") != "") & text.has_devanagari(F.col("word_hindi")))
    return stats.word_accuracy(o.select(translit.romanize(F.col("word_hindi")).alias("actual"), F.lower(F.trim("roman")).alias("expected")))


@query("select rec_id, 'HIN-' || printf('%05d', row_number() over (order by rec_id)) id from entries")
def g01_ids(spark: SparkSession, sf: str) -> DataFrame:
    return writers.assign_ids(_entries(spark, sf, "rec_id")).select("rec_id", "id")


# --- search -----------------------------------------------------------------------
@query(f"select rec_id, id, tier::INT tier from {_TIER.format(q='करना')} where tier is not null and {_SAFE} and confidence_score >= 0.5 {_ORDER} limit 20")
def h01_tier_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.tier_search(_entries(spark, sf), "करना", 20, safe=True, min_confidence=0.5).select("rec_id", "id", "tier")


def _lookup_sql(q: str) -> str:
    exact = f"(lower(coalesce(word_hindi,'')) = '{q}' or lower(coalesce(word_hinglish_roman,'')) = '{q}')"
    part = f"(contains(lower(coalesce(word_hindi,'')), '{q}') or contains(lower(coalesce(word_hinglish_roman,'')), '{q}') or contains(lower(coalesce(definition,'')), '{q}'))"
    return f"with h as (select *, case when {exact} then 1 when {part} then 2 end tier from entries), t as (select * from h where tier is not null order by tier, {_CONF} desc, rec_id limit 10) select rec_id, id, tier::INT tier from t where tier = (select min(tier) from t)"


@query(_lookup_sql("dhaantitaul"))
def h02_lookup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return search.lookup(_entries(spark, sf), "Dhaantitaul").select("rec_id", "id", "tier")


@query(_lookup_sql("aantit"))
def h02_lookup_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return search.lookup(_entries(spark, sf), "aantit").select("rec_id", "id", "tier")


@query("select rec_id, exact from (select rec_id, coalesce(word_hindi = 'aantit' or word_hinglish_roman = 'aantit', false) exact, coalesce(contains(word_hindi, 'aantit'), false) or coalesce(contains(lower(word_hinglish_roman), 'aantit'), false) part from entries) where exact or part order by exact desc, rec_id limit 1")
def m08_best_match(spark: SparkSession, sf: str) -> DataFrame:
    return search.best_match(_entries(spark, sf), "aantit").select("rec_id", "exact")


@query("""with h as (select *, case when word_hindi = 'aantit' or word_hinglish_roman = 'aantit' then 1 when word_hindi ilike '%aantit%' or word_hinglish_roman ilike '%aantit%' then 2 end tier from entries), t as (select * from h where tier is not null order by tier, rec_id limit 10)
select rec_id, id, tier::INT tier from t where tier = (select min(tier) from t)""")
def h07_edge_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return search.edge_lookup(_entries(spark, sf), " aantit").select("rec_id", "id", "tier")


@query(f"""with p as (select *, coalesce(nullif(lower(trim(part_of_speech)), ''), 'other') k from {_TIER.format(q='market')} where tier is not null {_ORDER} limit 100)
select 'pos' facet, k as value, count(*)::BIGINT n from p group by 2 union all select 'source', source, count(*)::BIGINT from p where k = 'noun' group by 2""")
def f11_edge_facets(spark: SparkSession, sf: str) -> DataFrame:
    return search.edge_facets(search.tier_search(_entries(spark, sf), "market", 100), "Noun")


_FTS = ["word_hindi", "word_hinglish_roman", "definition"]
_INDEXES: dict[tuple[str, str], SearchIndex] = {}


def _index(spark: SparkSession, sf: str) -> SearchIndex:
    """The index of a folder's entries, written to the shared folder once per session."""
    key = spark.sparkContext.applicationId, sf
    if key not in _INDEXES:
        _INDEXES[key] = SearchIndex.build(_entries(spark, sf), f"{shared_folder(spark)}/index-{uuid4().hex}", _FTS)
    return _INDEXES[key]


@query(_lookup_sql("dhaantitaul").replace(", tier::INT tier", ""))
def h02_lookup_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).lookup("Dhaantitaul").select("rec_id", "id")


@query("select rec_id, id from entries where lower(coalesce(word_hindi,'')) = 'dhaantitaul' or lower(coalesce(word_hinglish_roman,'')) = 'dhaantitaul' order by rec_id desc limit 1")
def m01_lookup_last(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).lookup("Dhaantitaul", mode="last").select("rec_id", "id")


def _bm25_sql(words: list[str], prefix: bool) -> str:
    tf = [f"len(list_filter(t, lambda x: {f'starts_with(x, {w!r})' if prefix else f'x = {w!r}'}))" for w in words]
    cols = ", ".join(f"{x} tf{i}" for i, x in enumerate(tf))
    sums = ", ".join(f"count(*) filter (where tf{i} > 0) df{i}" for i in range(len(words)))
    score = " + ".join(f"greatest(ln((n - df{i} + 0.5::DOUBLE) / (df{i} + 0.5::DOUBLE)), 1e-6::DOUBLE) * (tf{i} * 2.2::DOUBLE) / (tf{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(t) / a))" for i in range(len(words)))
    hit = " and ".join(f"tf{i} > 0" for i in range(len(words)))
    return f"""with x as (select *, regexp_extract_all(lower(concat_ws(' ', word_hindi, word_hinglish_roman, definition)), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') t from entries), y as (select *, {cols} from x), s as (select count(*) n, avg(len(t)) a, {sums} from y)
select rec_id, round({score}, 6) bm25 from y, s where {hit} order by bm25 desc, {_CONF} desc, rec_id limit 20"""




@query(_bm25_sql(["old", "market"], False))
def d06_bm25(spark: SparkSession, sf: str) -> DataFrame:
    return search.full_text(_entries(spark, sf), "old market", _FTS).select("rec_id", "bm25")


@query(_bm25_sql(["vill", "peo"], True))
def d06_prefix_and(spark: SparkSession, sf: str) -> DataFrame:
    return search.full_text(_entries(spark, sf), "vill peo", _FTS, prefix=True).select("rec_id", "bm25")


@query(_bm25_sql(["old", "market"], False))
def d06_bm25_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).search("old market").select("rec_id", "bm25")


@query(_bm25_sql(["vill", "peo"], True))
def d06_prefix_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).search("vill peo", prefix=True).select("rec_id", "bm25")


@query("""select token, count(distinct ord)::BIGINT docs, count(*)::BIGINT uses from (select rec_id ord, unnest(regexp_extract_all(lower(concat_ws(' ', definition)), '[\\p{L}\\p{M}\\p{N}]+')) token from entries) group by 1""")
def d06_inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return search.inverted_index(_entries(spark, sf), ["definition"]).groupBy("token").agg(F.count("*").alias("docs"), F.sum("tf").alias("uses"))


# --- sinks and sets ---------------------------------------------------------------
@query("select id, arg_max(word_hinglish_roman, rec_id) filter (where true) r, max(rec_id) rec_id from (select id, coalesce(word_hinglish_roman,'') word_hinglish_roman, rec_id from entries) group by 1")
def b03_upsert(spark: SparkSession, sf: str) -> DataFrame:
    e = _entries(spark, sf).select("id", "rec_id", F.coalesce("word_hinglish_roman", F.lit("")).alias("r"))
    return writers.upsert(e.where("rec_id % 2 = 0"), e.where("rec_id % 2 = 1"), "rec_id")


@query(f"""select distinct lower({_STRIP.format(c="coalesce(word_hinglish_roman,'')")}) word from entries where {_SAFE} and trim(coalesce(word_hinglish_roman,'')) <> '' and not regexp_matches(word_hinglish_roman, '[ऀ-ॿ]')""")
def b06_words(spark: SparkSession, sf: str) -> DataFrame:
    return writers.word_list(_entries(spark, sf))


@query(f"select coalesce(id,'') id, coalesce(word_hindi,'') word_hindi, coalesce(word_hinglish_roman,'') word_hinglish_roman, coalesce(definition,'') definition, severity_score, coalesce(source,'') source from entries where not {_SAFE}")
def b02_excluded(spark: SparkSession, sf: str) -> DataFrame:
    return writers.excluded_rows(_entries(spark, sf))


_Q = "'"
_QUOTED = f"{_Q * 4} || replace(coalesce({{c}}, {_Q * 2}), {_Q * 4}, {_Q * 6}) || {_Q * 4}"


@query(f"""with n as (select row_number() over (order by id nulls first, rec_id) - 1 i, '(' || {" || ',' || ".join(_QUOTED.format(c=c) for c in ("id", "word_hindi", "definition"))} || ')' r from entries)
select i // 10 n, 'INSERT INTO entries (id,word_hindi,definition) VALUES ' || string_agg(r, ',' order by i) || ';' stmt from n group by 1""")
def b09_sql_dump(spark: SparkSession, sf: str) -> DataFrame:
    return writers.sql_dump(_entries(spark, sf), ["id", "word_hindi", "definition"], "entries", ["id", "rec_id"])


@query("with c as (select coalesce(part_of_speech,'') as value, count(*)::BIGINT n from entries group by 1) select value, n, repeat('█', greatest(1, floor(n * 40 / (select sum(n) from c)))::INT) bar from c")
def b11_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.histogram_bars(_entries(spark, sf).groupBy(F.coalesce("part_of_speech", F.lit("")).alias("value")).agg(F.count("*").alias("n")))


@query("select 'synset' origin, count(*)::BIGINT n from (select unnest(words) from synsets) union all select 'entries', count(*)::BIGINT from entries")
def i01_union(spark: SparkSession, sf: str) -> DataFrame:
    a = dictionaries.synset_entries(table(spark, sf, "synsets")).select("id", "word_hindi", "definition", F.lit("synset").alias("origin"))
    b = _entries(spark, sf, "id", "word_hindi", "definition", "source").withColumn("origin", F.lit("entries"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("origin").agg(F.count("*").alias("n"))


@query(f"select count(*) filter (where {_SAFE})::BIGINT safe, count(*) filter (where not {_SAFE})::BIGINT excluded, count(*)::BIGINT total from entries")
def i05_partition(spark: SparkSession, sf: str) -> DataFrame:
    safe, excluded = writers.split_safe(_entries(spark, sf))
    x = safe.select(F.lit(1).alias("s")).unionByName(excluded.select(F.lit(0).alias("s")))
    return x.agg(F.count_if(F.col("s") == 1).alias("safe"), F.count_if(F.col("s") == 0).alias("excluded"), F.count("*").alias("total"))


_INDICATORS = ("hate", "kill", "die", "stupid", "idiot")


def _indicator_model():
    """A model as a worker loads it: 0.3 for each indicator a text contains."""
    return lambda texts: [min(0.3 * sum(i in t.lower() for i in _INDICATORS), 1.0) for t in texts]


@query("select doc_id, round(s, 6) score, s >= 0.7 toxic from (select doc_id, case when regexp_matches(coalesce(text, ''), '\\S') then least(0.3::DOUBLE * (contains(t,'hate')::INT + contains(t,'kill')::INT + contains(t,'die')::INT + contains(t,'stupid')::INT + contains(t,'idiot')::INT), 1.0) else 0 end s from (select doc_id, text, lower(coalesce(text,'')) t from documents))")
def l02_model_udf(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a pluggable model, one per worker."""
    scored = safety.score_texts(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", _indicator_model)
    return scored.select("doc_id", F.round("score", 6).alias("score"), "toxic")


@query(f"""with c as (select source as value, count(*)::BIGINT n from entries where coalesce(source, '') <> '' group by 1), p as (select part_of_speech as value, count(*)::BIGINT n from entries where coalesce(part_of_speech,'') <> '' group by 1 order by n desc, value limit 5)
select '# Lexicon' || chr(10) || chr(10) || '## Sources' || chr(10) line union all select format('- {{}}: {{:,}}', value, n) from c union all select chr(10) || '## Parts of speech' || chr(10) union all select format('- {{}}: {{:,}}', value, n) from p""")
def b10_release_notes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.release_notes(stats.meta(_entries(spark, sf)), "Lexicon").select("line")


_BUILD_SQL = f"""with recursive raw as (select 0 s, synset_id::BIGINT a, i - 1 b, words[i] word_hindi, lower(words[i]) roman, coalesce(gloss, '') definition, coalesce(pos, '') pos, coalesce(examples[1], '') ex, examples xs, 'WordNet' source from (select *, unnest(range(1, len(words) + 1)) i from synsets)
 union all select 1, line_no, i, word, roman, definition, pos, example, case when example <> '' then [example] else [] end, 'Wiktionary' from ({_SENSES_SQL})),
keyed as (select *, {_sql_hindi("coalesce(word_hindi, '')")} h, md5({_SQ.format(c="definition")}) dh from raw),
firsts as (select h, dh, min((a, b)) o from keyed where s = 0 group by 1, 2),
given as (select h, dh, arg_min(xs[1], (a, b)) filter (where coalesce(xs[1], '') <> '') x from keyed where s = 1 group by 1, 2),
merged as (select k.*, case when ex = '' and o is not null then coalesce(x, '') else ex end example from keyed k left join firsts f on s = 0 and f.h = k.h and f.dh = k.dh and f.o = (a, b) left join given g on g.h = f.h and g.dh = f.dh
 where s = 0 or not exists (select 1 from firsts z where z.h = k.h and z.dh = k.dh)),
numbered as (select row_number() over (order by s, a, b) rec_id, word_hindi, roman word_hinglish_roman, definition, pos part_of_speech, example example_sentence, source, null::VARCHAR[] sources from merged),
romanized as ({_romanized_sql("rec_id, word_hindi, definition, part_of_speech, example_sentence, source, sources", "numbered")}),
entries as (select rec_id, word_hindi, definition, part_of_speech, example_sentence, source, sources, how, r word_hinglish_roman from romanized),
{_FOLD_CTES},
terms as ({_TERMS}),
flagged as (select d.*, how, coalesce(list_has_any(string_split_regex(trim({_FOLD.format(c='roman')}), '\\s+'), (select list(term) from terms)), false) profane from deduped d join entries e on e.rec_id = leader)
select leader ord, 'HIN-' || printf('%05d', leader) id, word_hindi, roman word_hinglish_roman, definition, definition_hi, definition_en, definition_lang, example_sentence, part_of_speech, source, sources, profane profanity, how,
 round(least(greatest(case when profane then least(c, 0.3::DOUBLE) else c end, 0), 1), 6) confidence from (select *, (case source when 'WordNet' then 0.95::DOUBLE when 'Wiktionary' then 0.85::DOUBLE else 0.70::DOUBLE end) * (case how when 'common_word' then 1.0::DOUBLE when 'iso' then 0.92::DOUBLE else 0.75::DOUBLE end)
 * (1.0::DOUBLE + 0.03::DOUBLE * (len(string_split(sources, '|')) - 1))
 * (case when coalesce(definition_hi,'') <> '' and coalesce(definition_en,'') <> '' then 1.05::DOUBLE when coalesce(definition_en,'') <> '' then 1.03::DOUBLE when coalesce(definition_hi,'') <> '' and example_sentence <> '' then 1.02::DOUBLE else 1.0::DOUBLE end) c from flagged)"""


@query(_BUILD_SQL)
def build_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The whole build from the raw sources: parse, merge, romanize, number, deduplicate, flag, score (here without rounding to four decimals)."""
    from lexmill.plans import build

    merged = build.gather(table(spark, sf, "synsets"), dictionaries.parse_dictionary_lines(table(spark, sf, "wiktionary_lines")))
    rows = build.number_and_romanize(merged, table(spark, sf, "overrides"))
    lex = build.finish(rows.withColumn("tags", F.col("_romanization_method")), table(spark, sf, "blocklist"))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    exact = score.confidence(F.col("source"), F.col("tags"), F.size("sources"), filled("definition_hi"), filled("definition_en"), filled("example_sentence"), F.col("severity_score"))
    columns = ["ord", "id", "word_hindi", "word_hinglish_roman", "definition", "definition_hi", "definition_en", "definition_lang", "example_sentence", "part_of_speech", "source"]
    return lex.select(*columns, F.array_join("sources", "|").alias("sources"), "profanity", F.col("tags").alias("how"), F.round(exact, 6).alias("confidence"))
