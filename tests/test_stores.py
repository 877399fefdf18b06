"""Stored sets, logs and queues: versions, partial reads, crashes."""

import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkmill.operators.dedup import admit
from linkmill.plans.manifest import Manifest
from linkmill.sinks import bucketed
from linkmill.sinks.changelog import ChangeLog
from linkmill.sinks.seen import SeenStore, admit_stored
from linkmill.sinks.upsert import fold_changes
from linkmill.sources.queue import SeedQueue


def keys(spark, pairs):
    return spark.createDataFrame(pairs, "spider string, fp string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_are_exclusive_and_old_ones_stay(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.state() == (0, None)
    assert manifest.commit({"x": 1}, 0) == 1 and manifest.commit({"x": 2}, 1) == 2
    assert manifest.state() == (2, {"x": 2}) and manifest.state(1) == (1, {"x": 1})
    with pytest.raises(Exception, match="(?i)exists"):
        manifest.commit({"x": 3}, 1)
    assert manifest.state() == (2, {"x": 2})


@pytest.fixture
def store(spark, tmp_path):
    made = SeenStore(spark, str(tmp_path / "seen"), homes=4, slots=4)
    made.add(keys(spark, [("a", "1"), ("a", "2"), ("b", "1"), (None, "9"), ("", "9")]), 0)
    made.add(keys(spark, [("a", "3"), ("b", "2"), ("b", "2")]), 1)
    return made


ALL = [("a", "1"), ("a", "2"), ("a", "3"), ("b", "1"), ("b", "2"), ("", "9"), (None, "9")]


def found(df):
    return sorted(rows(df), key=repr)


def test_a_seen_set_is_read_whole_in_part_and_as_it_was(spark, store):
    assert found(store.read()) == sorted(ALL, key=repr)
    assert found(store.read(before_batch=1)) == sorted([x for x in ALL if x not in (("a", "3"), ("b", "2"))], key=repr)
    wanted = keys(spark, [("a", "3"), ("c", "7")])
    part = store.read(store.cells(wanted))
    assert ("a", "3") in rows(part) and set(rows(part)) < set(ALL)
    assert "PartitionFilters: [cell" in plan(part) or "cell#" in plan(part)
    # Another process opens it with the sizes it was made with.
    again = SeenStore(spark, store.manifest.path)
    assert (again.homes, again.slots) == (4, 4) and found(again.read()) == found(store.read())


def test_clearing_rewrites_one_home(spark, store):
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.manifest.path}/keys-*/cell=*/*.parquet")}
    old, _ = store.manifest.state()
    store.clear("a")
    assert found(store.read()) == sorted([x for x in ALL if x[0] != "a"], key=repr)
    assert found(store.read(version=old)) == sorted(ALL, key=repr)
    new = [f for f in glob.glob(f"{store.manifest.path}/keys-*/cell=*/*.parquet") if f not in before]
    home = set(store.home_cells("a"))
    assert {int(f.split("cell=")[1].split("/")[0]) for f in new} <= home
    store.clear(None)
    store.clear("not there")
    assert found(store.read()) == sorted([x for x in ALL if x[0] not in ("a", None)], key=repr)
    # A cleared spider can come again.
    store.add(keys(spark, [("a", "1")]), 2)
    assert ("a", "1") in rows(store.read())


def test_merging_keeps_the_last_batch_repeatable(spark, store):
    store.add(keys(spark, [("a", "4")]), 2)
    store.compact()
    _, state = store.manifest.state()
    assert [b["id"] for b in state["batches"]] == [2]
    assert found(store.read()) == sorted([*ALL, ("a", "4")], key=repr)
    assert found(store.read(before_batch=2)) == sorted(ALL, key=repr)
    store.add(keys(spark, [("a", "5")]), 2)  # the same batch again, with other keys
    assert found(store.read()) == sorted([*ALL, ("a", "5")], key=repr)
    with pytest.raises(ValueError):
        store.add(keys(spark, [("z", "1")]), 1)
    store.compact()
    gone = store.vacuum(keep=1)
    assert gone and found(store.read()) == sorted([*ALL, ("a", "5")], key=repr)
    store.add(keys(spark, []), 3)
    assert found(store.read()) == sorted([*ALL, ("a", "5")], key=repr)


def test_a_crash_before_the_version_leaves_the_old_table(spark, store, monkeypatch):
    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", crash)
        for change in (lambda: store.clear("a"), store.compact, lambda: store.add(keys(spark, [("z", "1")]), 2)):
            with pytest.raises(RuntimeError):
                change()
    assert found(store.read()) == sorted(ALL, key=repr)


def test_admission_against_the_store(spark, tmp_path):
    store = SeenStore(spark, str(tmp_path / "seen"))
    schema = "seq long, spider string, fp string, dont_filter boolean"
    one = spark.createDataFrame([(1, "a", "x", False), (2, "a", "x", False), (3, "a", "y", True), (4, "b", "x", None)], schema)
    two = spark.createDataFrame([(5, "a", "x", False), (6, "a", "y", False), (7, "a", None, False), (8, None, "x", False)], schema)
    assert sorted(r.seq for r in admit_stored(one, store, 0).collect()) == [1, 3, 4]
    for _ in range(2):  # a repeated batch admits the same rows
        assert sorted(r.seq for r in admit_stored(two, store, 1).collect()) == [6, 8]
    assert found(store.read()) == sorted([("a", "x"), ("b", "x"), ("a", "y"), (None, "x")], key=repr)


def test_a_bucketed_seen_set_is_not_moved(spark, tmp_path):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    requests = spark.range(4000).selectExpr(
        "id AS seq", "IF(id % 7 = 0, NULL, concat('s', id % 3)) AS spider", "IF(id % 3 = 0, 'hot', concat('k', id % 900)) AS fp",
        "id % 100 = 1 AS dont_filter")
    seen = spark.range(0, 900, 2).selectExpr("concat('s', id % 3) AS spider", "concat('k', id) AS fp").unionByName(
        spark.createDataFrame([(None, "hot")], "spider string, fp string"))
    want, want_new = admit(requests, seen, ("spider", "fp"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for buckets in (parts, parts + 3):
            name = f"seen_{buckets}"
            bucketed.write_bucketed_seen(seen, name, str(tmp_path / name), buckets=buckets)
            admitted, new = bucketed.admit_bucketed(requests, name)
            assert sorted(r.seq for r in admitted.collect()) == sorted(r.seq for r in want.collect())
            assert found(new.distinct()) == found(want_new.distinct())
            text = plan(admitted).split("== Initial Plan ==")[-1]
            # No exchange above the scan of the seen-set; the batch has one, or two if the numbers differ.
            side = text[text.index("Scan parquet") if "SortMergeJoin" not in text else text.index("SortMergeJoin"):]
            assert text.count("Exchange") == (1 if buckets == parts else 2) and "Bucketed: true" in side
        bucketed.append_bucketed_seen(new, name)
        assert bucketed.admit_bucketed(requests.where("not dont_filter"), name)[0].count() == 0
        reopened = bucketed.open_bucketed_seen(spark, "seen_again", str(tmp_path / name), "spider string, fp string", parts + 3)
        assert reopened.count() == spark.table(name).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SCHEMA = "seq long, id string, title string, n long"


def changes(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_a_log_is_the_same_table_however_it_is_merged(spark, tmp_path):
    batches = [[(s, f"k{(b * 3 + s) % 5}", None if (b + s) % 4 == 0 else f"t{b}.{s}", b * 10 + s) for s in range(4)]
               for b in range(6)]
    schema = changes(spark, batches[0]).schema
    plain = [(b, *r) for b, rs in enumerate(batches) for r in rs]
    want = fold_changes(spark.createDataFrame(plain, "b long, " + SCHEMA), "id", ["n"], ["b", "seq"])
    for fanout, whole in ((2, False), (99, True)):
        log = ChangeLog(spark, str(tmp_path / f"log{fanout}{whole}"), schema, "id", ["n"], fanout=fanout)
        assert log.current().collect() == []
        for b, data in enumerate(batches):
            if b % 3 == 1:
                log.append(changes(spark, data[:1]), b)
            log.append(changes(spark, data), b)  # a repeated batch replaces itself
            log.compact(whole and b == 4)
        assert found(log.current().select("id", "title", "n")) == found(want.select("id", "title", "n"))
        folders = log.folders()
        assert [f["first"] for f in folders] == [0, *(f["last"] + 1 for f in folders[:-1])] and folders[-1]["last"] == 5
        if fanout == 2:
            assert len(folders) <= 4
        if whole:
            assert [f["level"] for f in folders[1:]] == [0, 0]
        log.vacuum(keep=1)
        assert found(log.current().select("id", "title", "n")) == found(want.select("id", "title", "n"))


def test_a_crash_while_merging_leaves_the_log(spark, tmp_path, monkeypatch):
    log = ChangeLog(spark, str(tmp_path / "log"), changes(spark, [(1, "a", "x", 1)]).schema, "id", ["n"], fanout=2)
    for b in range(4):
        log.append(changes(spark, [(1, "a", f"x{b}", b), (2, f"k{b}", None, b)]), b)
    before, folders = found(log.current()), log.folders()

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", crash)
        with pytest.raises(RuntimeError):
            log.compact()
    assert log.folders() == folders and found(log.current()) == before
    log.compact()
    assert len(log.folders()) < len(folders) and found(log.current()) == before
    with pytest.raises(ValueError):
        log.append(changes(spark, [(1, "a", "x", 1)]), 2)


def test_a_queue_reads_the_pieces_of_its_batch(spark, tmp_path):
    seeds = spark.range(1, 5001).selectExpr("id AS seq", "concat('u', id) AS member")
    queue = SeedQueue(spark, str(tmp_path / "queue"), seeds.schema)
    assert queue.take(5).collect() == []
    queue.push(seeds, pieces=50)
    assert [r.seq for r in queue.take(30).collect()] == list(range(1, 31))
    text = plan(queue.peek(30))
    assert "GreaterThan(seq,30)" in text and "LessThanOrEqual(seq," in text
    upto = int(text.split("LessThanOrEqual(seq,")[1].split(")")[0])
    assert upto < 500  # of 5000: what the plan reads follows the batch
    assert [r.seq for r in queue.take(300).collect()] == list(range(31, 331))
    assert queue.waiting().count() == 4670
    queue.push(spark.range(9000, 9010).selectExpr("id AS seq", "'late' AS member"), pieces=2)
    for bad in ((5,), (None,)):
        with pytest.raises(ValueError):
            queue.push(spark.createDataFrame([(*bad, "x")], seeds.schema))
    assert sorted(r.seq for r in queue.take(4675).collect())[-5:] == [9000, 9001, 9002, 9003, 9004]
    assert sorted(r.seq for r in queue.take(100).collect()) == [9005, 9006, 9007, 9008, 9009]
    assert queue.take(1).collect() == [] and queue.waiting().count() == 0
    queue.vacuum(keep=1)
    assert not glob.glob(f"{queue.manifest.path}/seeds-*")
