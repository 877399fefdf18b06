"""Sinks, upserts and streams."""

import datetime as dt
import json
import os

from conftest import rows
from pyspark.sql import functions as F

from linkmill import schemas
from linkmill.operators.dedup import admit, fingerprint
from linkmill.sinks import files
from linkmill.sinks import upsert as up
from linkmill.sources.pages import stream_pages, stream_seeds
from linkmill.streaming.admission import admit_batches, read_seen, stream_admit
from linkmill.streaming.loading import stream_load

KIND = "k string, n int, u int"


def test_upsert(spark):
    target = spark.createDataFrame([("k1", 1, 1), ("k2", None, 2), ("k4", 4, 4)], KIND)
    batch = spark.createDataFrame([(1, "k1", 8, 9), (2, "k2", 5, None), (3, "k3", 1, 1), (4, "k3", 2, 2)], f"seq int, {KIND}")
    expected = [("k1", 1, 9), ("k2", None, None), ("k3", 1, 2), ("k4", 4, 4)]
    once = up.upsert(target, batch, "k", ["u"])
    assert sorted(rows(once)) == expected
    assert sorted(rows(up.upsert(once, batch, "k", ["u"]))) == expected
    assert sorted(rows(up.upsert(target, batch.limit(0), "k", ["u"]))) == sorted(rows(target))


def test_change_log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([(1, "a", 1, 1), (2, "b", None, 2)], f"seq int, {KIND}")
    second = spark.createDataFrame([(1, "b", 7, None), (2, "a", 8, 9)], first.schema)
    up.append_changes(first, path, 0)
    for _ in range(2):
        up.append_changes(second, path, 1)
    assert sorted(rows(up.read_current(spark, path, first.schema, "k", ["u"]))) == [("a", 1, 9), ("b", None, None)]
    base = spark.createDataFrame([("a", 0, 0), ("z", 5, 5)], KIND)
    assert sorted(rows(up.read_current(spark, path, first.schema, "k", ["u"], base=base))) == [
        ("a", 0, 9), ("b", None, None), ("z", 5, 5)]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2)), (2, None, None, None)],
                               "i int, s string, t timestamp, d date")
    files.write_json(df, str(tmp_path / "json"))
    files.write_json(df, str(tmp_path / "json"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "json").glob("*.json"))
    assert "é" in text and len(text.strip().splitlines()) == 2
    feed = {r.key: json.loads(r.value) for r in files.to_item_feed(df.filter("i = 1"), "sp").collect()}
    assert feed == {"sp:items": {"i": 1, "s": "é", "t": "2024-01-02 03:04:05", "d": "2024-01-02"}}
    custom = files.to_item_feed(df, F.lit("x"), lambda s: s["i"].cast("string"))
    assert sorted(rows(custom)) == [("x:items", "1"), ("x:items", "2")]


def test_write_all_gives_every_sink_the_same_rows(spark):
    got = []
    files.write_all(spark.range(5).withColumn("r", F.rand()), [lambda d: got.append(rows(d)), lambda d: got.append(rows(d))])
    assert sorted(got[0]) == sorted(got[1]) and len(got[0]) == 5


def write_part(spark, folder, name, data, schema):
    """One more input file for a stream; the name sorts after the earlier ones."""
    tmp = os.path.join(os.path.dirname(folder), "tmp-" + name)
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    os.rename(os.path.join(tmp, part), os.path.join(folder, name + ".parquet"))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


REQUEST = "seq long, spider string, url string, dont_filter boolean"
PARTS = [
    [(1, "s", "http://a/1", False), (2, "s", "http://a/1", False), (3, "s", "http://a/2", True)],
    [(4, "s", "http://a/2", False), (5, "t", "http://a/1", False), (6, "s", "http://a/1", False)],
]


def test_pages_and_seeds_arrive_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(3):
        write_part(spark, folder, f"p{i}", [(i, f"http://a/{i}", "<p>")], schemas.PAGE)
    out = str(tmp_path / "out")
    finish(stream_pages(spark, folder, 1).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out))
    assert sorted(r.page_id for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    seeds = str(tmp_path / "seeds")
    write_part(spark, seeds, "s0", [(1, bytearray(b"http://a/"), 1.0)], schemas.SEED)
    assert stream_seeds(spark, seeds).isStreaming


def test_stream_admission_equals_batch_and_survives_restart(spark, tmp_path):
    folder, seen, out = (str(tmp_path / n) for n in ("in", "seen", "out"))
    for i, part in enumerate(PARTS):
        write_part(spark, folder, f"p{i}", part, REQUEST)
        stream = fingerprint(spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).parquet(folder))
        finish(admit_batches(stream, seen, out, str(tmp_path / "check")))
    batch = fingerprint(spark.createDataFrame([r for p in PARTS for r in p], REQUEST))
    admitted, new_seen = admit(batch, key=("spider", "fp"))
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == sorted(r.seq for r in admitted.collect())
    assert sorted(rows(read_seen(spark, seen))) == sorted(rows(new_seen))


def test_native_stream_admission(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(PARTS):
        write_part(spark, folder, f"p{i}", part, REQUEST)
        stream = fingerprint(spark.readStream.schema(REQUEST).parquet(folder))
        finish(stream_admit(stream).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out))
    got = spark.read.parquet(out)
    assert sorted(rows(got.filter("not dont_filter").select("spider", "url"))) == [
        ("s", "http://a/1"), ("s", "http://a/2"), ("t", "http://a/1")]
    assert got.filter("dont_filter").count() == 1


def test_stream_admission_within_a_span(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = dt.datetime(2024, 1, 1)
    kind = "seq long, spider string, fp string, dont_filter boolean, at timestamp"
    write_part(spark, folder, "p0", [(1, "s", "a", False, at), (2, "s", "a", False, at + dt.timedelta(seconds=5))], kind)
    stream = stream_admit(spark.readStream.schema(kind).parquet(folder), event_time="at", within="1 minute")
    finish(stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
           .trigger(availableNow=True).start(out))
    assert spark.read.parquet(out).count() == 1


def test_stream_load_equals_batch(spark, tmp_path):
    folder, feed, changes, rejects = (str(tmp_path / n) for n in ("in", "feed", "changes", "rejects"))
    kind = f"seq int, {KIND}"
    parts = [[(1, "a", 1, 1), (2, "b", None, 2), (3, "a", 3, 3)], [(4, "a", 4, 4), (5, "c", 5, 5)]]
    for i, part in enumerate(parts):
        write_part(spark, folder, f"p{i}", part, kind)
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder)
        finish(stream_load(stream, "sp", ["n"], feed, changes, rejects, str(tmp_path / "check")))
    schema = spark.createDataFrame([], kind).schema
    loaded = up.read_current(spark, changes, schema, "k", ["u"])
    assert sorted(rows(loaded)) == [("a", 1, 4), ("c", 5, 5)]
    assert spark.read.parquet(feed).count() == 4
    assert [r.missing for r in spark.read.parquet(rejects).collect()] == [["n"]]
