"""The mix: targets against plain arithmetic, balance of what is taken, reruns."""

import re
from collections import defaultdict

import numpy as np

from linkmill.llm import mixing as mx
from linkmill.llm.queries import op3_mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        share = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        above = {s for s in rest if weight[s] * share > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * share for s in order}
        full |= above


def check(rows, got, tolerance):
    """rows: (doc_id, source, text)."""
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken = targets(sizes), defaultdict(int)
    by_id = {d: (s, len(WORD.findall(t or ""))) for d, s, t in rows}
    assert len(got) == len(rows)
    for doc_id, size, source_size, target, n in got:
        source, words = by_id[doc_id]
        assert size == words and source_size == sizes[source] and abs(target - want[source]) < 1e-6
        assert n % max(size, 1) == 0 and 0 <= n <= 3 * size
        taken[source] += n
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance
    return want


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, op3_mixing(spark, folder).collect()))
    check(rows, got, 250)
    assert got == sorted(map(tuple, op3_mixing(spark, folder).collect()))


def test_many_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK", 64)
    rng = np.random.default_rng(1)
    rows = [(i, ("hot", "b", "ä", None, "é", "")[min(5, int(rng.exponential(0.6)))], "w " * int(rng.integers(0, 300)))
            for i in range(3000)]
    rows += [(5000, "none", None), (5001, "none", " \n"), (5002, "long", "y " * 30_000), (5003, "tiny", "z")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "doc_id long, source string, text string, target string, rows int")
    got = sorted(map(tuple, mx.mixture_report(frame).collect()))
    want = check([(d, s, t) for d, s, t in rows], got, 30_000)
    hot = sum(n for (d, _, _, _, n), (_, s, _) in zip(got, rows) if s == "hot")
    assert abs(hot - want["hot"]) < 300
    again = frame.repartition(7)
    assert got == sorted(map(tuple, mx.mixture_report(again).collect()))
    mixed = mx.mix_documents(frame).groupBy("doc_id").count().collect()
    copies = {r.doc_id: r["count"] for r in mixed}
    assert all(n == size * copies.get(d, 0) for d, size, _, _, n in got)
    assert mx.mix_documents(frame).columns == frame.columns
    assert mx.mixture_report(frame.limit(0)).count() == 0 and mx.mix_documents(frame.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a", "x y")] * 4 + [(None, "b", "x y z")] * 2, "doc_id long, source string, text string")
    assert mx.mixture_report(same).count() == 6


def test_flight_keeps_totals():
    rng = np.random.default_rng(4)
    sizes, p = rng.integers(0, 900, 2000), np.full(2000, 0.37)
    means = np.zeros(2000)
    for seed in range(60):
        out = mx.flight(p, np.ones(2000, int), sizes, [seed])
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * sizes).sum() - (p * sizes).sum()) < 1e-3
        means += out / 60
    assert abs(means.mean() - 0.37) < 0.01 and means.std() < 0.09
