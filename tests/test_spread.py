"""Pages written from one small file are parsed by many tasks, and each page once."""

import __spark_entry__ as entry
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import plan, shuffled_columns

from linkmill.sources.pages import spread

N = 3000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    ids = spark.range(0, N, 1, 1)
    ids.selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "'M' AS c_mktsegment", "id % 7 - 3.0D AS c_acctbal",
                   "1 AS c_nationkey").write.parquet(f"{path}/customer.parquet")
    ids.selectExpr("id AS p_partkey", "concat('n ', id) AS p_name", "concat('Brand#', id % 50) AS p_brand", "'T' AS p_type",
                   "int(id % 40) AS p_size", "1.0D AS p_retailprice").write.parquet(f"{path}/part.parquet")
    return str(path)


def test_rows_are_dealt_evenly(spark):
    one = spark.range(0, N, 1, 1)
    assert spread(one.limit(900)).rdd.getNumPartitions() == 1
    assert spread(one.where("false")).count() == 0
    sizes = [len(p) for p in spread(one, (10, 100)).rdd.glom().collect()]  # beyond twice the cores
    assert len(sizes) == 30 and max(sizes) <= 110 and sum(sizes) == N


def staged_files(df, name):
    return [f for f in df.inputFiles() if f"/{name}-" in f]


def parsed_in_tasks(df, per_page):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and max(sizes) <= 1.1 * min(sizes) and sum(sizes) == N * per_page
    assert "html" not in shuffled_columns(df._jdf.queryExecution().executedPlan())


def test_endpoint_crawl(spark, folder):
    df = entry.queries()["endpoint_crawl"](spark, folder)
    assert len(staged_files(df, "endpoints")) == 3 and "ArrowEvalPython" not in plan(df)
    got = rows(df)
    speed = {i: i % 7 - 3.0 for i in range(N)}
    assert sorted(got) == sorted((i, f"c{i}{end}", port or str(i), speed[i]) for i in range(N)
                                 for end, port in (("", ""), ("-b", "81"), ("-c", "82")) if end or speed[i] > 0)


def test_article_crawl(spark, folder):
    df = entry.queries()["article_crawl"](spark, folder)
    assert len(staged_files(df, "articles")) == len(staged_files(df, "listing")) == 3
    assert "ArrowEvalPython" not in plan(df)
    got = rows(df.select("url", "front_image_url", "comment_nums"))
    assert sorted(got) == sorted(
        (f"http://list.example.com/p/{i}{end}", f"https://img.example.com/{i}.png" if end == ".html" else "", i)
        for i in range(N) for end in (".html", "-b.html"))


def test_extract_jobs(spark, folder):
    df = entry.queries()["extract_jobs"](spark, folder)
    parsed_in_tasks(df, 1)
    assert df.where("salary = (page_id % 40) * 1000 AND title = concat('n ', page_id)").count() == N


def test_append_endpoints(spark, folder):
    df = entry.queries()["append_endpoints"](spark, folder)
    assert len(df.inputFiles()) == 3 and df.count() == 3 * N


def test_extract_table(spark, folder):
    parsed_in_tasks(entry.queries()["extract_table"](spark, folder), 3)


def test_article_requests(spark, folder):
    parsed_in_tasks(entry.queries()["article_requests"](spark, folder), 3)
