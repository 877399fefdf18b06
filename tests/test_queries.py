"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLES = entry.q.named_queries(), entry.oracles.sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    mine = sorted(repr([r[c] for c in columns]) for r in df.collect())
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert mine == sorted(repr([r[i] for i in at]) for r in rel.fetchall())


def test_entry(spark):
    hosts = entry.entry(spark)
    assert hosts.columns == ["host", "n_links"]
    assert hosts.agg({"n_links": "sum"}).first()[0] == 279
