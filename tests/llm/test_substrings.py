"""Repeated passages against brute force over all windows."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkmill.llm import substrings as su
from linkmill.llm.queries import op5_substrings

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=35):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = {}
    for i, w in enumerate(texts):
        for k in range(len(w) - window + 1):
            seen.setdefault(tuple(w[k:k + window]), []).append((i, k))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + window))
    return sorted(((d, len(w), len(g), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in g).encode())
                    .hexdigest()) for (d, _), w, g in zip(rows, texts, gone)), key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=25), st.integers(1, 2)), max_size=6), st.integers(1, 5))
def test_automaton_counts_windows(texts, window):
    automaton = su.SuffixAutomaton()
    for t, weight in texts:
        automaton.add(list(t), weight)
    automaton.finish()
    counts = {}
    for t, weight in texts:
        for k in range(len(t) - window + 1):
            counts[t[k:k + window]] = counts.get(t[k:k + window], 0) + weight
    for t, _ in texts:
        assert automaton.repeated(list(t), window) == [
            k for k in range(len(t) - window + 1) if counts[t[k:k + window]] > 1]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(op5_substrings(spark, folder)) == brute(rows)


@pytest.mark.parametrize("large, shard", [(256, 60_000), (2, 300)])
def test_common_passages_and_odd_rows(spark, monkeypatch, large, shard):
    monkeypatch.setattr(su, "LARGE", large)
    monkeypatch.setattr(su, "SHARD_WORDS", shard)
    rng = random.Random(7)
    words = lambda n: " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(n))
    common, other, long = words(60), words(36), words(400)
    rows = [(i, f"{words(rng.randint(0, 60))} {common} {words(rng.randint(0, 60))}") for i in range(40)]
    rows += [(50, long), (51, " ".join(long.split()[20:300]) + " x " + other), (52, other + "\n\n" + words(40) + "\t" + other),
             (53, long.upper()), (54, None), (55, ""), (56, " \t"), (57, "z " * 500), (58, common[:40]),
             (59, "É " * 34), (60, ("É " * 35)), (61, words(3000)), (61, words(3000)), (62, other), (62, other)]
    rows += [(70, common + " end"), (71, "begin " + common), (None, common), (None, words(100)), (None, None)]
    frame = spark.createDataFrame([(d, t, 1, "x", d) for d, t in rows],
                                  "doc_id long, text string, rid int, hash string, low long")
    assert result(su.repeats_report(frame)) == brute(rows)
    assert result(su.repeats_report(frame, window=12)) == brute(rows, 12)
    assert su.repeats_report(frame.limit(0)).count() == 0
