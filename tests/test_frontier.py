import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkmill.operators import enrich, frontier, quality, stats
from linkmill.operators.bloom import BloomSize, bloom_build, bloom_maybe_contains, bloom_merge
from linkmill.operators.dedup import admit, append_seen, merge_pending, merge_seen, reset_seen
from linkmill.operators.ordered import first_rows, ordered_last, ordered_rank
from linkmill.sources.seeds import decode_seeds, parse_seed_json, take_seeds


@pytest.fixture(scope="module")
def requests(spark):
    data = [(1, "a", False), (2, "a", False), (3, "b", True), (4, "b", False), (5, "c", False)]
    return spark.createDataFrame(data, "seq int, fp string, dont_filter boolean")


@pytest.mark.parametrize("dedup", ["exact", "bloom+exact"])
def test_admit(spark, requests, dedup):
    seen = spark.createDataFrame([("c",)], "fp string")
    admitted, new_seen = admit(requests, seen, dedup=dedup, capacity=1000)
    assert sorted(r.seq for r in admitted.collect()) == [1, 3, 4]
    assert sorted(rows(new_seen)) == [("a",), ("b",)]
    again, nothing = admit(requests, merge_seen(seen, new_seen), dedup=dedup, capacity=1000)
    assert [r.seq for r in again.collect()] == [3] and nothing.count() == 0


def test_admit_sends_one_row_per_key_and_task(spark):
    big = spark.range(0, 10_000, 1, 8).select(F.col("id").alias("seq"), F.when(F.col("id") < 9_000, "hot").otherwise("cold").alias("fp"))
    admitted, _ = admit(big, dont_filter=None)
    plan = admitted._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > 0 and "Partial" in plan
    assert sorted(rows(admitted)) == [(0, "hot"), (9000, "cold")]


def test_seen_table(spark, tmp_path):
    path = str(tmp_path / "seen")
    new = spark.createDataFrame([("s", "a"), ("t", "b")], "spider string, fp string")
    for _ in range(2):
        append_seen(new, path, 0)
    append_seen(spark.createDataFrame([("s", "c")], "spider string, fp string"), path, 1)
    seen = spark.read.parquet(path).select("spider", "fp")
    assert sorted(rows(seen)) == [("s", "a"), ("s", "c"), ("t", "b")]
    assert rows(reset_seen(seen, "s")) == [("t", "b")]


def test_merge_pending(spark):
    old = spark.createDataFrame([(1, "s", "a", 5)], "seq int, spider string, request_key string, priority int")
    new = spark.createDataFrame([(2, "s", "a", 1), (3, "s", "b", 2)], old.schema)
    assert sorted(rows(merge_pending(old, new).select("request_key", "priority", "seq"))) == [("a", 1, 1), ("b", 2, 3)]


@pytest.mark.parametrize("order, batch, rest", [("fifo", {1, 2}, {3, 4}), ("lifo", {4, 3}, {1, 2}),
                                                ("priority", {2, 3}, {1, 4})])
def test_select_batch(spark, order, batch, rest):
    df = spark.createDataFrame([("s", 1, 0), ("s", 2, 9), ("s", 3, 9), ("s", 4, 1)], "spider string, seq int, priority int")
    taken, left = frontier.select_batch(df, 2, order)
    assert {r.seq for r in taken.collect()} == batch and {r.seq for r in left.collect()} == rest
    assert frontier.has_pending(left) and rows(frontier.pending_count(left)) == [("s", 2)]


def test_seeds(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "x", 3.0), (4, "z", 0.0)], "seq int, member string, score double")
    batch, rest = take_seeds(df, 2)
    assert [r.seq for r in batch.collect()] == [1, 2] and {r.seq for r in rest.collect()} == {3, 4}
    scored = spark.createDataFrame([(1, "a", 1.0), (2, "b", 9.0), (3, "c", 9.0)], df.schema)
    batch, rest = take_seeds(scored, 2, "scored")
    assert [r.member for r in batch.collect()] == ["c", "b"] and [r.member for r in rest.collect()] == ["a"]
    batch, rest = take_seeds(df, 2, "set", seed=1)
    assert {r.member for r in batch.collect()} | {r.member for r in rest.collect()} == {"x", "y", "z"}
    assert rows(batch) == rows(take_seeds(df, 2, "set", seed=1)[0])


def test_large_seed_batches(spark):
    df = spark.range(0, 5000, 1, 7).select((4999 - F.col("id")).alias("seq"))
    for n in (10, 1500):
        batch, rest = take_seeds(df, n)
        assert sorted(r.seq for r in batch.collect()) == list(range(n)) and rest.count() == 5000 - n


def test_seed_messages(spark):
    df = spark.createDataFrame([(1, "http://a/é".encode()), (2, b"")], "seq int, data binary")
    assert rows(decode_seeds(df).select("seq", "url", "dont_filter")) == [(1, "http://a/é", True)]
    latin = spark.createDataFrame([(1, "http://a/é".encode("latin-1"))], "seq int, data binary")
    assert decode_seeds(latin, "ISO-8859-1").first().url == "http://a/é"
    df = spark.createDataFrame([(1, '["http://a/", 3, "parse"]'), (2, "broken"), (3, '["http://b/"]')], "seq int, message string")
    assert sorted(rows(parse_seed_json(df))) == [(1, "http://a/", 3, "parse", False), (3, "http://b/", 0, None, False)]


def test_plan_fetch(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("http://h/1", 1, 0), ("http://h/2", 2, 5), ("http://g/3", 3, 0)], "url string, seq int, priority int")
    got = {r.seq: (r.fetch_at - start).seconds for r in frontier.plan_fetch(df, 2, F.lit(start)).collect()}
    assert got == {2: 0, 1: 2, 3: 0}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; groups and values have nulls."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None, "zz"])
        data.append((group, rng.randrange(3), i, rng.choice([None, None, float(i)])))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "g string, p int, seq int, v double").repartition(6)


def test_rank_of_split_groups(spark, skewed):
    data, df = skewed
    order = [F.col("p").desc(), F.col("seq").asc()]
    got = sorted(rows(ordered_rank(df, ["g"], order, "r", task_rows=0).select("seq", "r")))
    by_group = {}
    for g, p, seq, _ in data:
        by_group.setdefault(g, []).append((-p, seq))
    expected = sorted((seq, i + 1) for items in by_group.values() for i, (_, seq) in enumerate(sorted(items)))
    assert got == expected
    assert sorted(rows(ordered_rank(df, ["g"], order, "r").select("seq", "r"))) == expected


def test_carried_values_of_split_groups(spark, skewed):
    data, df = skewed
    got = sorted(rows(ordered_last(df, "v", ["g"], [F.col("seq")], "c", task_rows=0).select("seq", "c")))
    last, expected = {}, []
    for g, _, seq, v in sorted(data, key=lambda r: r[2]):
        last[g] = v if v is not None else last.get(g)
        expected.append((seq, last[g]))
    assert got == expected
    assert sorted(rows(ordered_last(df, "v", ["g"], [F.col("seq")], "c").select("seq", "c"))) == expected


def test_small_arrow_batches(spark, skewed):
    data, df = skewed
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        ranked = ordered_rank(df, ["g"], [F.col("seq")], "r", task_rows=0)
        assert ranked.groupBy("g").agg(F.max("r") == F.count("*"), F.countDistinct("r") == F.count("*")).filter(
            "not (`(max(r) = count(1))` and `(count(DISTINCT r) = count(1))`)").count() == 0
        filled = sorted(rows(ordered_last(df, "v", ["g"], [F.col("seq")], "c", task_rows=0).select("seq", "c")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert filled == sorted(rows(ordered_last(df, "v", ["g"], [F.col("seq")], "c").select("seq", "c")))


def test_large_batches_are_ranked(spark, skewed):
    _, df = skewed
    small = first_rows(df, 40, ["g"], [F.col("seq")])
    large = first_rows(df, 40, ["g"], [F.col("seq")], partial_limit=0, task_rows=0)
    assert sorted(r.seq for r in small.collect()) == sorted(r.seq for r in large.collect())


def test_bloom(spark):
    size = BloomSize.of(1000, 0.01)
    added = spark.range(250).select(F.concat(F.lit("http://in/"), "id").alias("url"))
    absent = spark.range(20_000).select(F.concat(F.lit("http://out/"), "id").alias("url"))
    bloom = bloom_build(added, "url", size)
    assert bloom_maybe_contains(added, bloom, "url", size).filter("maybe_seen").count() == 250
    assert bloom_maybe_contains(absent, bloom, "url", size).filter("maybe_seen").count() <= 400
    halves = bloom_build(added.filter("url < 'http://in/3'"), "url", size).unionByName(
        bloom_build(added.filter("url >= 'http://in/3'"), "url", size))
    assert sorted(rows(bloom_merge(halves))) == sorted(rows(bloom))


def test_bloom_rate_at_capacity(spark):
    size = BloomSize.of(2000, 0.01)
    bloom = bloom_build(spark.range(2000).select(F.col("id").cast("string").alias("k")), "k", size)
    probes = spark.range(10_000, 40_000).select(F.col("id").cast("string").alias("k"))
    assert bloom_maybe_contains(probes, bloom, "k", size).filter("maybe_seen").count() <= 30_000 * 0.02


def test_carry_meta(spark):
    listing = spark.createDataFrame([(1, "u1", "img"), (2, "u2", ""), (3, "u1", "later")], "seq int, fp string, front_image_url string")
    details = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "fp string")
    assert sorted(rows(enrich.carry_meta(details, listing))) == [("u1", "img"), ("u2", None), ("u3", None)]


def test_attach_image_path(spark):
    items = spark.createDataFrame([("u", ["i"], None), ("w", ["i"], None), ("x", None, "old")],
                                  "url string, front_image_url array<string>, front_image_path string")
    results = spark.createDataFrame([("u", 0, True, "p0"), ("u", 1, True, "p1"), ("u", 2, False, None)],
                                    "url string, pos int, ok boolean, path string")
    assert sorted((r.url, r.front_image_path) for r in enrich.attach_image_path(items, results).collect()) == [
        ("u", "p1"), ("w", ""), ("x", "old")]


def test_checks_and_pruning(spark):
    checks = spark.createDataFrame([(1, 200), (2, 299), (3, 300), (4, None)], "ip int, status int")
    assert [r.ip for r in quality.filter_status_ok(checks).collect()] == [1, 2]
    endpoints = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 3)], "ip int")
    assert sorted(r.ip for r in enrich.prune_failed(endpoints, checks).collect()) == [1, 2, 5]


def test_assign_member(spark):
    pool = spark.createDataFrame([(i, f"m{i}") for i in range(5)], "i int, m string")
    df = spark.range(200).select("id", F.when(F.col("id") == 3, F.lit("own")).alias("agent"))
    small = sorted(rows(enrich.assign_member(df, pool, "id", ["i"], "agent", "m", "s")))
    large = sorted(rows(enrich.assign_member(df, pool, "id", ["i"], "agent", "m", "s", broadcast_rows=0)))
    assert small == large and small[3] == (3, "own") and len({m for _, m in small}) == 6
    assert enrich.assign_member(df, pool.limit(0), "id", ["i"], "agent", "m").filter("agent is null").count() == 199


def test_crawl_stats(spark):
    df = spark.createDataFrame([("s", "admitted")] * 3 + [("s", "filtered")] * 2, "spider string, outcome string")
    assert sorted(rows(stats.crawl_stats(df))) == [("s", "admitted", 3), ("s", "filtered", 2)]
