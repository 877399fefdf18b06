"""Fingerprints against brute force over k-mers, and the order of documents."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from linkmill.llm import syncmers as sy
from linkmill.llm.queries import op8_syncmers


def brute_anchors(text):
    """Closed syncmers from their definition, with the operator's hash of one k-mer at a time."""
    if len(text) < sy.K:
        return None
    tool, places = sy.Syncmers(), []

    def one(piece):
        total = np.zeros(len(piece) + 1, np.uint64)
        codes = np.array([ord(c) + 1 for c in piece], np.uint64)
        np.cumsum(codes * tool.up[:len(piece)], out=total[1:])
        return int(tool._mers(total, len(piece), np.array([0]), len(piece))[0])

    for i in range(len(text) - sy.K + 1):
        inner = [one(text[j:j + sy.S]) for j in range(i, i + sy.K - sy.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            places.append((one(text[i:i + sy.K]) >> 32, i))
    first = {}
    for h, p in places:
        first.setdefault(h, p)
    return dict(sorted(first.items())[:sy.ANCHORS])


def test_anchors_equal_the_definition(monkeypatch):
    text = "Ein längerer Text 漢字 mit 😀 Zeichen, a a a a a a a a, und noch mehr davon. " * 3 + "Schluss"
    want = brute_anchors(text)
    monkeypatch.setattr(sy, "_BLOCK", 50)
    assert sy.decode(sy.encode(sy.Syncmers().anchors(text))) == want
    monkeypatch.undo()
    assert sy.decode(sy.encode(sy.Syncmers().anchors(text))) == want


def test_likeness():
    tool = sy.Syncmers()
    finger = lambda t: sy.encode(tool.anchors(t))
    rng = np.random.default_rng(1)
    a, b = ("".join(rng.choice(list("abcdefghij "), 900)) for _ in range(2))
    assert sy.likeness(finger(a), finger(a)) == 1 and sy.likeness("", "") == 1 and sy.likeness(finger(a), "") == 0
    assert sy.likeness(finger(a), finger(b)) < 0.05
    assert sy.likeness(finger(a), finger(b[:200] + a)) > 0.5  # all places moved alike
    assert 0.3 < sy.likeness(finger(a), finger(a[:600] + b[:300])) < 0.7
    assert sy.likeness(finger(a[:450] + a[450:]), finger(a[450:] + a[:450])) < 0.8  # order counts


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()),
                  reverse=True)
    tool, want = sy.Syncmers(), {}
    for i, (d, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        f, e, x = (sy.encode(tool.anchors(t)) for t in (text, edited, following))
        want[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, sy.likeness(f, e), sy.likeness(f, x))
    got = {r[0]: tuple(r)[1:] for r in op8_syncmers(spark, folder).collect()}
    assert got == want
    alike = [v[4] - v[5] for v in want.values()]
    assert sum(x > 0.2 for x in alike) >= 0.95 * len(alike)


def test_odd_rows(spark):
    rows = [(3, "abc"), (3, "abd"), (2, None), (None, "last of all rows"), (9, ""), (7, "x" * 300_000), (7, "é" * 20)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, bucket int")
    got = sy.fingerprint_documents(frame, buckets=3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    texts = [t or "" for _, t in order]
    want = []
    for i, (d, t) in enumerate(order):
        n = len(texts[i]) // 3
        edited = texts[i][:len(texts[i]) - n] + texts[(i + 1) % len(texts)][:n]
        want.append((d, len(texts[i]), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got.select("doc_id", "n_chars", "edited_sha256").collect()))) == sorted(
        map(repr, want))
    assert got.where(F.col("near_edited").between(0, 1) & F.col("near_next").between(0, 1)).count() == len(rows)
    assert sy.fingerprint_documents(frame.limit(0)).count() == 0
    one = sy.fingerprint_documents(frame.where("doc_id = 9")).first()
    assert (one.near_edited, one.near_next) == (1.0, 1.0)


def test_short_texts_have_anchors():
    tool, rng = sy.Syncmers(), np.random.default_rng(4)
    finger = lambda t: sy.encode(tool.anchors(t))
    for n in range(1, 40):
        for _ in range(100):
            a, b = ("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n)) for _ in range(2))
            assert finger(a) and sy.likeness(finger(a), "") == 0 and sy.likeness(finger(a), finger(a)) == 1
            assert a == b or n < 4 or sy.likeness(finger(a), finger(b)) < 0.5
    assert sy.likeness(finger("the cat sat on the mat"), finger("the cat sat on the hat")) > 0.5
    assert finger("a" * 24) and finger("a" * 25)
