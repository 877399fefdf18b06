"""Keys that hold a third of all rows, cut batches, live picks and stream counters."""

import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkmill.operators import enrich
from linkmill.operators.cut import batch_cut
from linkmill.operators.dedup import merge_pending
from linkmill.operators.frontier import select_batch
from linkmill.operators.links import filter_domains, filter_domains_table
from linkmill.operators.skew import heavy_keys, join_one
from linkmill.sources.seeds import take_seeds
from linkmill.streaming.state import stream_admit_state


@pytest.fixture
def hot(spark):
    return spark.range(0, 60_000, 1, 8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("fp"))


def test_frequent_keys_are_found(spark, hot):
    assert heavy_keys(hot, "fp") == ["hot"]
    assert heavy_keys(hot.where("false"), "fp") == []
    assert heavy_keys(hot.where("fp is null"), "fp") == []


def test_a_frequent_key_is_not_one_task(spark, hot):
    right = spark.range(0, 5000, 2).select(F.concat(F.lit("k"), "id").alias("fp"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "fp string, v long"))
    want = hot.join(right, "fp", "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = join_one(hot, right, "fp")
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2] + 1
        plain = sorted(r["count"] for r in want.groupBy(F.spark_partition_id()).count().collect())
        assert plain[-1] > 2 * plain[len(plain) // 2]
        assert sorted(rows(got.select("id", "fp", "v")), key=repr) == sorted(rows(want.select("id", "fp", "v")), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_pending_requests_are_folded_before_the_shuffle(spark):
    schema = "spider string, request_key string, seq long, priority int, meta string"
    early = spark.createDataFrame([("a", "x", 1, 5, "first"), ("a", "y", 2, None, None), (None, "x", 3, 1, "n")], schema)
    late = spark.createDataFrame([("a", "x", 4, 7, "later"), ("a", "x", 5, None, "last"), (None, "x", 6, 2, "m")], schema)
    merged = merge_pending(early, late)
    assert merged.columns == early.columns
    assert sorted(rows(merged), key=repr) == sorted(
        [("a", "x", 1, None, "first"), ("a", "y", 2, None, None), (None, "x", 3, 2, "n")], key=repr)
    text = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Join" not in text and text.count("Exchange") == 1 and "partial_min_by" in text


@pytest.mark.parametrize("order", ["fifo", "lifo", "priority"])
def test_cut_batches_are_those_of_the_ranking(spark, order):
    rng = random.Random(4)
    data = [(i * 1_003 - 50_000, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0, 1, 1, 1, 9, -3]))
            for i in rng.sample(range(10 ** 4), 1500)]
    frame = spark.createDataFrame(data + [(7, "few", 1)], "seq long, spider string, priority int").repartition(6)
    for n in (10, 700):
        want, rest = select_batch(frame, n, order)
        batch, stays = batch_cut(frame, n, order)
        assert sorted(rows(batch), key=repr) == sorted(rows(want), key=repr)
        assert sorted(rows(stays), key=repr) == sorted(rows(rest), key=repr)
    plans = [batch_cut(frame, n, order)[0]._jdf.queryExecution().executedPlan().toString() for n in (10, 600)]
    assert all("Window" not in p for p in plans)
    assert batch_cut(frame.where("false"), 3, order)[0].collect() == []


def test_a_dead_member_moves_only_its_own_rows(spark):
    jobs = spark.range(3000).withColumn("agent", F.when(F.col("id") == 5, F.lit("own")))
    pool = spark.createDataFrame([(f"m{i}", True) for i in range(30)], "member string, alive boolean")
    for few in (64, 4):
        before = {r.id: r.agent for r in enrich.assign_live(jobs, pool, "id", "agent", "member", "alive", few=few).collect()}
        share = {m: sum(v == m for v in before.values()) for m in set(before.values()) - {"own"}}
        assert len(share) == 30 and min(share.values()) > 20 and before[5] == "own"
        dead = pool.withColumn("alive", F.col("member") != "m7")
        after = {r.id: r.agent for r in enrich.assign_live(jobs, dead, "id", "agent", "member", "alive", few=few).collect()}
        assert "m7" not in after.values()
        assert all(after[i] == before[i] for i in before if before[i] != "m7")
        nobody = enrich.assign_live(jobs, pool.withColumn("alive", F.lit(None).cast("boolean")), "id", "agent", "member", "alive",
                                    few=few)
        assert {r.agent for r in nobody.collect()} == {None, "own"}
    keyless = spark.createDataFrame([(None,), (1,)], "id long")
    got = enrich.assign_live(keyless, pool.select("member"), "id", "agent", "member").collect()
    assert [r.agent is None for r in sorted(got, key=lambda r: r.id is not None)] == [True, False]


def test_a_table_of_domains(spark):
    urls = ["http://a.example.com/x", "http://example.com:8080/", "https://EXAMPLE.org/y", "http://badexample.com/", "nothing", None]
    frame = spark.createDataFrame(list(enumerate(urls)), "id long, url string")
    domains = spark.createDataFrame([(" Example.com ",), ("",), (None,), ("example.org",), ("example.org",)], "domain string")
    want = sorted(r.id for r in filter_domains(frame, ["example.com", "example.org"]).collect())
    for limit in (10, 0):
        got = filter_domains_table(frame, domains, broadcast_rows=limit)
        assert got.columns == frame.columns and sorted(r.id for r in got.collect()) == want == [0, 1, 2]
    assert filter_domains_table(frame, domains.where("domain = ''")).count() == len(urls)


def test_batch_and_rest_share_no_seed(spark):
    seeds = spark.createDataFrame([(None, "a", 1.0), (1, None, 9.0), (2, "b", 2.0)], "seq long, member string, score double")
    for mode, column in (("list", "seq"), ("scored", "member"), ("set", "member")):
        batch, rest = take_seeds(seeds, 2, mode)
        taken, left = [r[column] for r in batch.collect()], [r[column] for r in rest.collect()]
        assert len(taken) == 2 and len(left) == 1 and not set(taken) & set(left), mode


def _run(spark, frame, out, check):
    query = frame.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert query.exception() is None


def test_first_arrivals_with_state(spark, tmp_path):
    schema = "seq long, spider string, fp string, dont_filter boolean, at timestamp, more array<string>"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def arrive(data):
        rows_ = [(s, p, f, d, None if s % 2 else __import__("datetime").datetime(2024, 1, 1, 0, 0, s), ["x", None]) for s, p, f, d in data]
        spark.createDataFrame(rows_, schema).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        _run(spark, stream_admit_state(stream), out, check)
        return sorted(r.seq for r in spark.read.parquet(out).collect())

    first = [(9, "a", "x", False), (3, "a", "x", False), (5, "b", "x", None), (6, None, "x", False), (7, "a", "x", True),
             (8, "a", "x", True), (10, "a", None, False)]
    assert arrive(first) == [3, 5, 6, 7, 8]
    # After a restart the state is there, and dont_filter requests pass without one.
    assert arrive([(11, "a", "x", False), (12, "a", "y", False), (13, "a", "x", True), (14, None, "x", False)]) == [3, 5, 6, 7, 8, 12, 13]
    got = {r.seq: r for r in spark.read.parquet(out).collect()}
    assert got[12].more == ["x", None] and got[12].at.second == 12 and got[3].at is None


def test_a_key_is_forgotten_after_its_time(spark, tmp_path):
    """A query that waits for times to run out does not end by itself: it is stopped when its row was read."""
    schema = "seq long, spider string, fp string"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for seq, forget_after in ((1, 600_000), (2, 600_000), (3, 1)):
        spark.createDataFrame([(seq, "a", "x")], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = (stream_admit_state(stream, dont_filter=None, forget_after=forget_after).writeStream.format("parquet")
                 .option("checkpointLocation", check).start(out))
        try:
            for _ in range(300):
                if any(p["numInputRows"] for p in query.recentProgress):
                    break
                time.sleep(0.1)
        finally:
            query.stop()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 3]
