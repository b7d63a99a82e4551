"""Relations between entries by shared synsets and by the hypernymy between synsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_GROUP = 20


def members(entries: DataFrame, ord_col: str = "rec_id") -> DataFrame:
    """(synset, id, ord, pos): the first row of each id in each synset it names."""
    x = entries.select("id", F.col(ord_col).cast("long").alias("ord"), F.posexplode("synsets").alias("pos", "synset"))
    return x.groupBy("synset", "id").agg(F.min("ord").alias("ord"), F.min("pos").cast("long").alias("pos"))


def _first(df: DataFrame, k: int, per: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("rn") <= k)


def _heads(m: DataFrame, k: int) -> DataFrame:
    """The k+1 first members of each synset: enough for any member's k others."""
    return _first(m, k + 1, ["synset"], [F.col("ord"), F.col("id")]).drop("rn")


def same_synset(entries: DataFrame, k: int = PER_GROUP) -> DataFrame:
    """(entry_id, related_entry_id, rank): the first k other members of an entry's synsets.

    A synset gives each of its members its first members only, so the join
    grows with members times k, never with pairs of members.
    """
    m = members(entries)
    pairs = m.select("synset", F.col("id").alias("entry_id"), F.col("pos").alias("at")).join(_heads(m, k), "synset").where(F.col("entry_id") != F.col("id"))
    once = pairs.groupBy("entry_id", F.col("id").alias("related_entry_id")).agg(F.min(F.struct("at", "ord")).alias("o"))
    ranked = _first(once, k, ["entry_id"], [F.col("o"), F.col("related_entry_id")])
    return ranked.select("entry_id", "related_entry_id", F.col("rn").cast("long").alias("rank"))


def hypernym_edges(edges: DataFrame) -> DataFrame:
    """Distinct (child, parent) as the synsets' names."""
    name = lambda c: F.concat(F.lit("iwn-"), F.col(c).cast("string"))
    return edges.where("child_synset is not null and parent_synset is not null").select(name("child_synset").alias("child"), name("parent_synset").alias("parent")).distinct()


def broader_narrower(entries: DataFrame, edges: DataFrame, k: int = PER_GROUP) -> DataFrame:
    """(entry_id, related_entry_id, relation_type, rank): the first k members of parent (broader) and child (narrower) synsets."""
    m, e = members(entries), hypernym_edges(edges)
    heads = _heads(m, k)
    both = e.select(F.col("child").alias("synset"), F.col("parent").alias("other"), F.lit("broader").alias("relation_type")).unionByName(e.select(F.col("parent").alias("synset"), F.col("child").alias("other"), F.lit("narrower").alias("relation_type")))
    # a synset with many children: their first k+1 members together are enough
    reach = both.join(heads.select(F.col("synset").alias("other"), F.col("id").alias("rid"), F.col("ord").alias("rord")), "other")
    reach = reach.groupBy("synset", "relation_type", "rid").agg(F.min("rord").alias("rord"))
    reach = _first(reach, k + 1, ["synset", "relation_type"], [F.col("rord"), F.col("rid")]).drop("rn")
    pairs = m.select("synset", "id").join(reach, "synset").where("id <> rid").groupBy(F.col("id").alias("entry_id"), "relation_type", F.col("rid").alias("related_entry_id")).agg(F.min("rord").alias("o"))
    ranked = _first(pairs, k, ["entry_id", "relation_type"], [F.col("o"), F.col("related_entry_id")])
    return ranked.select("entry_id", "related_entry_id", "relation_type", F.col("rn").cast("long").alias("rank"))


def clean_relations(related: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct edges whose two ends exist and differ; the type in lower case without blanks."""
    ids = entries.select("id").distinct()
    edges = related.select("entry_id", "related_entry_id", F.lower(F.trim("relation_type")).alias("relation_type")).where("entry_id <> related_entry_id").distinct()
    return edges.join(ids.select(F.col("id").alias("entry_id")), "entry_id", "left_semi").join(ids.select(F.col("id").alias("related_entry_id")), "related_entry_id", "left_semi").select("entry_id", "related_entry_id", "relation_type")


def orphans(related: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct ids named by an edge that no entry has."""
    ends = related.select(F.explode(F.array("entry_id", "related_entry_id")).alias("id")).where("id is not null").distinct()
    return ends.join(entries.select("id").distinct(), "id", "left_anti")


def one_sided(edges: DataFrame) -> DataFrame:
    """Edges of ``clean_relations`` without their reverse (broader and narrower reverse each other)."""
    turned = F.when(F.col("relation_type") == "broader", "narrower").when(F.col("relation_type") == "narrower", "broader").otherwise(F.col("relation_type"))
    back = edges.select(F.col("related_entry_id").alias("entry_id"), F.col("entry_id").alias("related_entry_id"), turned.alias("relation_type"))
    return edges.join(back, ["entry_id", "related_entry_id", "relation_type"], "left_anti")


def related_top(edges: DataFrame, entries: DataFrame, k: int = PER_GROUP) -> DataFrame:
    """(entry_id, relation_type, related_entry_id, roman, rank): per entry and type the first k by roman."""
    names = entries.groupBy(F.col("id").alias("related_entry_id")).agg(F.min(F.coalesce("word_hinglish_roman", F.lit(""))).alias("roman"))
    joined = edges.join(names, "related_entry_id")
    ranked = _first(joined, k, ["entry_id", "relation_type"], [F.col("roman"), F.col("related_entry_id")])
    return ranked.select("entry_id", "relation_type", "related_entry_id", "roman", F.col("rn").cast("long").alias("rank"))
