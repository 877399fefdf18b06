"""The shape of physical plans: what is read, what moves, what is computed once."""

import __spark_entry__ as entry
from conftest import rows
from pyspark.sql import functions as F

from linkmill.operators import frontier, quality
from linkmill.plans import queries as q

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_columns(node):
    """Names of all columns that any exchange of the plan carries."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return shuffled_columns(node.initialPlan())
    found = set()
    if "Exchange" in name:
        out = node.output()
        found |= {out.apply(i).name() for i in range(out.size())}
    for i in range(node.children().size()):
        found |= shuffled_columns(node.children().apply(i))
    return found


def test_page_text_is_not_shuffled(spark):
    for name in ("admit", "plan_fetch", "carry_meta", "extract_articles", "job_crawl"):
        columns = shuffled_columns(entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan())
        assert "html" not in columns, name
    columns = shuffled_columns(q.admit_(spark, FOLDER)._jdf.queryExecution().executedPlan())
    assert {"fp", "spider"} <= columns  # the check sees what exchanges carry


def test_pages_are_parsed_once(spark):
    jobs = q.extract_jobs_(spark, FOLDER)
    good, _ = quality.split_valid(jobs, jobs.columns)
    for df in (q.extract_table_(spark, FOLDER), q.next_page_(spark, FOLDER), q.extract_listing_(spark, FOLDER),
               q.article_requests(spark, FOLDER), good):
        assert plan(df).count("ArrowEvalPython") == 1


def test_only_needed_columns_are_read(spark):
    text = plan(q.pending_count(spark, FOLDER))
    assert "ReadSchema: struct<o_orderstatus:string>" in text
    assert "html" not in plan(q.canonical_url_(spark, FOLDER))
    assert "PushedFilters: [IsNotNull" in plan(q.extract_articles_(spark, FOLDER))


def test_rest_of_a_small_batch_leaves_the_frontier_in_place(spark):
    df = spark.range(0, 1000, 1, 4).select(F.col("id").alias("seq"), (F.col("id") % 3).cast("string").alias("spider"),
                                           F.lit(1).alias("priority"))
    _, rest = frontier.select_batch(df, 2)
    text = plan(rest)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    _, moved = frontier.select_batch(df, 2, broadcast_rows=0)
    assert sorted(rows(rest)) == sorted(rows(moved)) and rest.count() == 994
