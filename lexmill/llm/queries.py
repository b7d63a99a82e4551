"""Queries over the corpus tables, by problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import survivor
from lexmill.llm.bpe import decode_corpus, encode_corpus
from lexmill.llm.content import content_model, score_content
from lexmill.llm.langid import OTHER, canonical_label, label_languages, train, training_sample
from lexmill.llm.packing import pack_documents, packing_report
from lexmill.llm.reading import reading_levels
from lexmill.llm.survivor import best_records, duplicate_key, survivor_items
from lexmill.llm.visual import visual_forms
from lexmill.plans.runtime import spread, table

#: A spec table is a few rows of settings; more than this is not one.
MAX_SPECS = 1000


def p1_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key with two or more rows."""
    return best_records(table(spark, sf, "entries"), duplicate_key(F.col("word_hinglish_roman")))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return survivor_items(p1_survivors(spark, sf))


def p2_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of every definition and of the stretches of the mixed ones."""
    entries = table(spark, sf, "entries").select("rec_id", "definition", "definition_lang")
    model = train(training_sample(entries, "definition", "definition_lang"))
    return label_languages(spread(entries), "rec_id", "definition", model)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "entries").select("rec_id", "definition", "definition_lang")
    model = train(training_sample(entries, "definition", "definition_lang"))
    # the label travels with the id, so that nothing has to be joined back
    tagged = entries.select(F.struct("rec_id", canonical_label(F.col("definition_lang")).alias("label")).alias("tag"), "definition")
    found = label_languages(spread(tagged), "tag", "definition", model).where(F.col("lang") != OTHER)
    wrong = (F.col("seg") > 0) | ~F.col("tag.label").eqNullSafe(F.col("lang"))
    return found.where(wrong).select("tag.rec_id", "seg", "lang")


_TEXTS = ["definition", "example_sentence"]


def p4_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry's category, score and the restored text that decides."""
    entries = table(spark, sf, "entries").select("rec_id", "word_hindi", *_TEXTS, "source")
    model = content_model(entries, "rec_id", "word_hindi", _TEXTS, table(spark, sf, "content_labels"), table(spark, sf, "blocklist"))
    return score_content(spread(entries), "rec_id", "word_hindi", _TEXTS, model, ["source"])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_scores(spark, sf).where(F.col("category") != "none").select("rec_id", "category")


def p4_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Entries, and the share of them in each category, per source."""
    share = [F.round(F.avg((F.col("category") == c).cast("double")), 6).alias(f"{c}_rate") for c in ("abuse", "hate", "sexual")]
    return p4_scores(spark, sf).groupBy("source").agg(F.count("*").alias("entries"), *share, F.round(F.avg("score"), 6).alias("mean_score"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return visual_forms(table(spark, sf, "entries"), "rec_id", ["word_hindi", "head_word"])


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text")


def _specs(spark: SparkSession, sf: str) -> list[tuple[int, str, int]]:
    rows = table(spark, sf, "pack_specs").select("spec_id", "tokenizer", "capacity").limit(MAX_SPECS + 1).collect()
    if len(rows) > MAX_SPECS:
        raise ValueError(f"more than {MAX_SPECS} container specs")
    return [tuple(r) for r in rows]


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text", _specs(spark, sf))


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing_report(p7_containers(spark, sf))


def p8_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Grade and level on the latent scale of every document of running text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return reading_levels(spread(docs), "doc_id", "text", table(spark, sf, "reading_labels"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return p8_levels(spark, sf).select("doc_id", "grade")


def p8_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and mean level per grade."""
    return p8_levels(spark, sf).groupBy("grade").agg(F.count("*").alias("documents"), F.round(F.avg("level"), 4).alias("mean_level"))


def p1_values(spark: SparkSession, sf: str) -> DataFrame:
    """The survivors' definition, score and sources: the fields whose rules SQL can state, too."""
    return p1_survivors(spark, sf).select("dup_key", "definition_en", "confidence_score", F.array_join("sources", "|").alias("sources"))


def p6_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return decode_corpus(p6_ids(spark, sf), "doc_id", "ids")


def p7_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Per spec: documents packed, containers over capacity, documents cut that would have fitted, documents whose pieces don't add up."""
    packed = p7_containers(spark, sf)
    over = packed.where(F.col("container") != "none").groupBy("spec_id", "container").agg(F.sum("n_tokens").alias("n"), F.max("capacity").alias("c")).groupBy("spec_id").agg(F.count_if(F.col("n") > F.col("c")).alias("over_full"))
    docs = packed.groupBy("spec_id", "capacity", "doc_id").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("n"), F.max(F.col("start") + F.col("n_tokens")).alias("end"), F.max("piece").alias("last"))
    whole = docs.groupBy("spec_id", "capacity").agg(F.count("*").alias("documents"), F.count_if((F.col("k") > 1) & (F.col("n") <= F.col("capacity"))).alias("cut_needlessly"), F.count_if((F.col("n") != F.col("end")) | (F.col("last") + 1 != F.col("k"))).alias("incomplete"))
    return whole.join(over, "spec_id", "left").select("spec_id", "capacity", "documents", F.coalesce("over_full", F.lit(0)).alias("over_full"), "cut_needlessly", "incomplete")


def p8_graded(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that get a grade."""
    return p8_levels(spark, sf).select("doc_id")


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_survivors, p1_values, p2_found, p2_segments, p4_found, p4_scores, p4_rates, p5_found, p6_ids, p6_roundtrip, p7_containers, p7_report, p7_checks, p8_found, p8_levels, p8_graded, p8_profile)}




def _stripped(c: str) -> str:
    return f"regexp_replace({c}, '{survivor._STRIP}', '', 'g')"


_NONE = ", ".join(f"'{x}'" for x in survivor.PLACEHOLDERS)
_TRUST = " ".join(f"when '{k}' then {v}::DOUBLE" for k, v in survivor.TRUST.items())


def oracle_sql() -> dict[str, str]:
    """SQL of what it can state: the votes on texts and scores, losslessness, the containers' rules, which texts are graded."""
    return {
        "p1_values": rf"""with e as (select *, nullif(lower({_stripped('word_hinglish_roman')}), '') k, coalesce(epoch_us(updated_at), 0) us, case trim(source) {_TRUST} else {survivor.OTHER_TRUST}::DOUBLE end trust, {_stripped('definition_en')} d from entries),
t as (select max(us) newest from e),
l as (select k, us, trust, 'd' field, d norm, case when d <> definition_en then definition_en else '' end stored from e where d <> '' and lower(d) not in ({_NONE}) and regexp_matches(d, '[\p{{L}}\p{{N}}]') and not regexp_matches(d, '{survivor.CUT_MARK}')
 union all select k, us, trust, 'c', printf('%.4f', confidence_score), '' from e where confidence_score between 0 and 1 and not isnan(confidence_score)),
o as (select k, field, norm, us, max(trust * pow(2.0::DOUBLE, greatest((us - newest) / 1e6::DOUBLE / {survivor.HALF_LIFE}, -1000))) vote, max(trust) trust, arg_max(stored, [trust::VARCHAR, stored]) stored from l, t where k is not null group by k, field, norm, us),
v as (select k, field, norm, sum(vote) vote, max(us) us, arg_max(trust, us) trust, arg_max(stored, us) stored from o group by 1, 2, 3),
u as (select * from v where not exists (select 1 from v w where w.k = v.k and w.field = v.field and w.norm <> v.norm and starts_with(w.norm, v.norm))),
b as (select k, field, coalesce(nullif(stored, ''), norm) item from u qualify row_number() over (partition by k, field order by vote desc, us desc, trust desc, length(norm) desc, norm desc) = 1),
g as (select k, count(*) n from e where k is not null group by 1 having count(*) > 1),
s as (select k, array_to_string(list_sort(list_distinct(list(nullif({_stripped('s')}, '')))), '|') sources from (select k, unnest(coalesce(sources, [source])) s from e) where s is not null group by 1)
select g.k dup_key, d.item definition_en, c.item confidence_score, coalesce(s.sources, '') sources from g left join b d on d.k = g.k and d.field = 'd' left join b c on c.k = g.k and c.field = 'c' left join s on s.k = g.k""",
        "p6_roundtrip": "select doc_id, coalesce(text, '') as text from documents",
        "p7_checks": "select spec_id, capacity, (select count(*) from documents)::BIGINT documents, 0::BIGINT over_full, 0::BIGINT cut_needlessly, 0::BIGINT incomplete from pack_specs",
        "p8_graded": r"""with p as (select doc_id, case when contains(text, '<') then regexp_replace(text, '<[^<>]{1,200}>', chr(10), 'g') else text end t from documents where text is not null),
w as (select doc_id, t, list_filter(string_split_regex(t, '\s+'), lambda x: x <> '') ws, len(list_filter(string_split_regex(replace(replace(replace(t, ' - ', ','), ' – ', ','), ' — ', ','), '[,;\n|.।॥!?\t、，；]+'), lambda x: trim(x, ' ') <> '')) pieces from p)
select doc_id from w where len(ws) >= 15 and len(ws) >= 2 * pieces and len(list_filter(ws, lambda x: regexp_matches(x, '\p{N}'))) < 0.3 * len(ws)
 and (regexp_matches(t, '[.!?…।॥|]') or regexp_matches(t, '\S[^\n\r]*[\n\r]+[^\n\r]*\S') or len(list_distinct(ws)) < 0.93 * len(ws))""",
    }
