"""A search index in a folder: entries, keys and postings, laid out so that a query reads the few files it needs.

``keys`` holds every lower-case headword and roman, ``postings`` every token of
the searched columns with its count, the entry's length, confidence and
safety, ``entries`` the rows. Keys and tokens lie in folders by the hash of
their first letters, sorted within; entries by the hash of their ord. A lookup
or search prunes folders by the hash of what is asked, skips row groups by the
pushed filter, and fetches the rows of its answer by ord. Statistics of the
collection are one row, written with the index.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.operators.search import B, K1, LOOKUP_CAP, SEARCH_CAP, _confidence, is_safe, low, tier_search, tokens

#: Folders of each table, and letters by which keys and tokens are placed.
BUCKETS, HEAD = 64, 2
TABLES = ("entries", "keys", "postings")
#: A token of a search text.
_WORD = r"[^\W_](?:[^\W_]|[ऀ-ःऺ-ॏ])*"


def _bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


class SearchIndex:
    """An index written by ``build``; queries give the same rows as the scans of operators.search."""

    def __init__(self, spark: SparkSession, path: str, ord_col: str = "rec_id"):
        self.spark, self.path, self.ord = spark, path, ord_col
        self.n, self.average, self.buckets, *schemas = spark.read.parquet(f"{path}/statistics").first()
        read = lambda name, schema: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/{name}")
        self.entries, self.keys, self.postings = map(read, TABLES, schemas)

    @staticmethod
    def build(entries: DataFrame, path: str, columns: list[str], ord_col: str = "rec_id", buckets: int = BUCKETS) -> SearchIndex:
        """Write the index of ``entries`` over ``columns`` to a folder every executor reaches; ords must be unique."""

        schemas: dict[str, str] = {}

        def write(df: DataFrame, name: str, *order: str) -> None:
            schemas[name] = df.schema.json()  # (an empty table leaves no file to read it from)
            df.repartition("b").sortWithinPartitions("b", *order).write.mode("overwrite").partitionBy("b").parquet(f"{path}/{name}")

        write(entries.withColumn("b", _bucket(F.col(ord_col).cast("long"), buckets)), "entries", ord_col)
        place = lambda c: _bucket(F.substring(c, 1, HEAD), buckets)
        ord_ = F.col(ord_col).cast("long").alias("ord")
        keys = entries.select(ord_, F.explode(F.array_distinct(F.array(low("word_hindi"), low("word_hinglish_roman")))).alias("key")).where("key <> ''")
        write(keys.withColumn("b", place("key")), "keys", "key", "ord")
        docs = entries.select(ord_, _confidence().alias("conf"), F.col("confidence_score").alias("score"), is_safe().alias("safe"), tokens(F.concat_ws(" ", *[F.col(c) for c in columns])).alias("t")).withColumn("dl", F.size("t").cast("long"))
        postings = docs.select("ord", "conf", "score", "safe", "dl", F.explode("t").alias("token")).groupBy("token", "ord", "conf", "score", "safe", "dl").agg(F.count("*").alias("tf"))
        write(postings.withColumn("b", place("token")), "postings", "token", "ord")
        docs.agg(F.count("*").alias("n"), F.avg("dl").alias("average"), F.lit(buckets).alias("buckets"), *[F.lit(schemas[t]).alias(t) for t in TABLES]).write.mode("overwrite").parquet(f"{path}/statistics")
        return SearchIndex(entries.sparkSession, path, ord_col)

    def _place(self, values: list[str]) -> Column:
        """Folders of keys or tokens (of HEAD letters or more, or whole)."""
        return F.col("b").isin(*[_hash_bucket(v[:HEAD], self.buckets) for v in values])

    def fetch(self, ords: list[int]) -> DataFrame:
        """The rows of a bounded list of ords."""
        return self.entries.where(F.col("b").isin(*sorted({_hash_bucket(o, self.buckets) for o in ords})) & F.col(self.ord).isin(*ords)).drop("b") if ords else self.entries.limit(0).drop("b")

    def exact(self, word: str) -> DataFrame:
        """(ord) of every entry whose headword or roman is the word, whatever its case."""
        q = word.strip().lower()
        return self.keys.where(self._place([q]) & (F.col("key") == q)).select("ord") if q else self.keys.limit(0).select("ord")

    def lookup(self, word: str, limit: int = 10, safe: bool = False, min_confidence: float = 0.0, mode: str = "all") -> DataFrame:
        """Exact matches by the index, best confidence first; where there are none, substring matches by a scan.

        ``mode`` "last": the last exact match alone if its confidence passes, else a
        tiered search; a safe lookup takes all matches.
        """
        if mode == "last" and not safe:
            last = self.exact(word).agg(F.max("ord")).first()[0]
            if last is not None:
                row = self.fetch([last]).where(F.col("confidence_score") >= min_confidence) if min_confidence > 0 else self.fetch([last])
                if min_confidence <= 0 or not row.isEmpty():
                    return row
            return tier_search(self.entries.drop("b"), word, limit, safe, min_confidence, ord_col=self.ord)
        found = self._with_filters(self.exact(word), safe, min_confidence)
        top = found.orderBy(_confidence().desc(), self.ord).limit(min(limit, LOOKUP_CAP))
        if not top.isEmpty():
            return top
        from lexmill.operators.search import lookup

        return lookup(self.entries.drop("b"), word, limit, safe, min_confidence, self.ord).drop("tier")

    def _with_filters(self, ords: DataFrame, safe: bool, min_confidence: float) -> DataFrame:
        """Rows of the ords, which a word may have many of: joined, each side placed by the same folders."""
        wanted = ords.withColumn("b", _bucket(F.col("ord"), self.buckets))
        rows = self.entries.join(wanted.withColumnRenamed("ord", "_o"), (self.entries["b"] == wanted["b"]) & (F.col(self.ord) == F.col("_o")), "left_semi").drop("b")
        rows = rows.where(is_safe()) if safe else rows
        return rows.where(F.col("confidence_score") >= min_confidence) if min_confidence > 0 else rows

    def search(self, q: str, limit: int = 20, safe: bool = False, min_confidence: float = 0.0, prefix: bool = False) -> DataFrame:
        """Entries that hold every token of q, with ``bm25``, best first: as operators.search.full_text, from postings alone."""
        wanted = list(dict.fromkeys(re.findall(_WORD, q.lower())))
        if not wanted:
            return self.fetch([]).withColumn("bm25", F.lit(0.0))
        hit = lambda w: F.col("token").startswith(w) if prefix else F.col("token") == w
        read = self.postings.where(self._place(wanted)) if not prefix or all(len(w) >= HEAD for w in wanted) else self.postings
        which = F.explode(F.filter(F.array(*[F.when(hit(w), F.lit(i)) for i, w in enumerate(wanted)]), lambda x: x.isNotNull())).alias("i")
        any_hit = hit(wanted[0])
        for w in wanted[1:]:
            any_hit = any_hit | hit(w)
        per = read.where(any_hit).select("ord", "conf", "score", "safe", "dl", "tf", which).groupBy("ord", "conf", "score", "safe", "dl", "i").agg(F.sum("tf").alias("tf"))
        df = per.groupBy("i").agg(F.count("*").alias("df"))  # one row per token asked
        idf = F.greatest(F.log((self.n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
        part = idf * (F.col("tf") * (K1 + 1)) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / self.average))
        docs = per.join(F.broadcast(df), "i").groupBy("ord", "conf", "score", "safe").agg(F.count("*").alias("k"), F.round(F.sum(part), 6).alias("bm25")).where(F.col("k") == len(wanted))
        docs = docs.where("safe") if safe else docs
        docs = docs.where(F.col("score") >= min_confidence) if min_confidence > 0 else docs
        top = docs.orderBy(F.desc("bm25"), F.desc("conf"), "ord").limit(min(limit, SEARCH_CAP)).select("ord", "bm25").collect()
        rows = self.fetch([r.ord for r in top])
        scores = F.create_map(*[F.lit(x) for r in top for x in (r.ord, r.bm25)]) if top else F.create_map(F.lit(0).cast("long"), F.lit(0.0))
        return rows.withColumn("bm25", scores[F.col(self.ord).cast("long")]).orderBy(F.desc("bm25"), _confidence().desc(), self.ord)


def _hash_bucket(value: str | int, buckets: int) -> int:
    """The folder of a value, as ``_bucket`` gives it: the 64-bit hash with seed 42."""
    import xxhash

    h = xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else int(value).to_bytes(8, "little", signed=True), 42)
    return (h - (1 << 64) if h >= 1 << 63 else h) % buckets
