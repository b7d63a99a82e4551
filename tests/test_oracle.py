"""Every query that has SQL, against that SQL, on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lexmill.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v
    return sorted([tuple(tidy(r[i]) for i in order) for r in data], key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(columns, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_partition_count_does_not_matter(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append({k: sorted(map(str, QUERIES[k](spark, SF).collect())) for k in ("e05_same_synset", "f08_roman_dedup", "h01_tier_search", "e02_fuzzy_best", "build_lexicon")})
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
