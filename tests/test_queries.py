"""Every registered query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return f"{v:.6g}"
    return v.isoformat(sep=" ")[:19] if hasattr(v, "hour") else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


OWN = [n for n in entry.queries() if not n.startswith(("op", "pipeline"))]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    got = duck.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall()) == rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["seg", "doc", "start", "end", "cer", "stage"]
