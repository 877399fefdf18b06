import math
import re

import numpy as np

from linkmill.llm import ranked_search
from linkmill.llm.queries import SQL, op12_ranked_search
from linkmill.llm.ranked_search import Rows, Search, Tree, search


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", lower)


def brute_force(docs, items, k=20):
    docs = [(d, terms(t)) for d, t in docs]
    n_docs, words = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, w in docs:
            score = 0
            for term in terms(text):
                tf = w.count(term)
                if tf:
                    m = 75 + (25 * len(w) * n_docs) // words
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (
                        (1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda x: tuple((v is None, v or 0) for v in x))


def test_query_agrees_with_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert ordered(op12_ranked_search(spark, folder).collect()) == ordered(brute_force(docs, items))


def test_query_agrees_with_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = con.execute(SQL["op12_ranked_search"]).fetchall()
    assert ordered(op12_ranked_search(spark, folder).collect()) == ordered(want)


def test_odd_rows_and_ties(spark, monkeypatch):
    # Small trees and samples, so that every bound and every block is met.
    for name, value in (("TREE_ROWS", 16), ("LEAF_ROWS", 4), ("LEAF_ITEMS", 2), ("SAMPLE", 8), ("ITEM_TERMS", 6)):
        monkeypatch.setattr(ranked_search, name, value)
    docs = [(i, t) for i, t in enumerate(["Red fox", "red RED fox é", "", None, "É é", "a b c", "fox " * 500, "ﬁ red", "x-y_z 42"])]
    docs += [(100 + i, "red fox jumps") for i in range(40)] + [(None, "red fox jumps"), (7, "ﬁ red"), (7, "ﬁ red")]
    docs += [(200 + i, f"w{i % 17} w{i % 5} common") for i in range(60)]
    items = [(1, "red"), (2, "red fox fox"), (3, None), (4, ""), (5, "É Red 42"), (5, "É Red 42"), (None, "w3 common"), (6, "nowhere"),
             (7, "w1 w2 w3 w4"), (8, "--")]
    frame = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, n int, terms string").repartition(5)
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert ordered(search(frame, queries, 5).collect()) == ordered(brute_force(docs, items, 5))
    assert search(frame.where("false"), queries).collect() == []
    assert search(frame, queries.where("false")).collect() == []


def rows_of(matrix):
    bounds = np.concatenate(([0], np.cumsum((matrix > 0).sum(axis=1))))
    return Rows(bounds, np.nonzero(matrix)[1], matrix[matrix > 0])


def test_nodes_hold_the_maxima_of_their_rows():
    rng = np.random.default_rng(3)
    for n in (1, 5, 32, 33, 100):
        matrix = rng.integers(0, 50, (n, 40)) * (rng.random((n, 40)) < 0.2)
        tree = Tree(rows_of(matrix), 40, 4)
        assert sorted(tree.order.tolist()) == list(range(n))
        for level, nodes in enumerate(tree.levels):
            width = 4 << level
            for j in range(len(nodes)):
                dense = np.zeros(40, int)
                span = slice(nodes.bounds[j], nodes.bounds[j + 1])
                dense[nodes.columns[span]] = nodes.values[span]
                assert (dense == matrix[tree.order[j * width:(j + 1) * width]].max(axis=0)).all()


def test_bounds_prune_whole_batches_and_lose_nothing():
    rng = np.random.default_rng(5)
    topics = rng.integers(0, 20, 3000)
    matrix = np.zeros((3000, 400), np.int64)
    for i, topic in enumerate(topics):
        matrix[i, topic * 20 + rng.integers(0, 20, 8)] = rng.integers(1, 900, 8)
    items = np.zeros((60, 400), np.int64)
    for i in range(60):
        items[i, (i % 20) * 20 + rng.integers(0, 20, 5)] = rng.integers(1, 50, 5)
    found = Search(rows_of(items), 400, 10, np.ones(60, np.int64))
    for at in range(0, 3000, 1000):
        found.show(rows_of(matrix[at:at + 1000]), list(range(at, at + 1000)))
    scores = items @ matrix.T
    for item in range(60):
        want = sorted((-s, d) for d, s in enumerate(scores[item].tolist()) if s > 0)[:10]
        assert sorted((-s, d) for i, d, s in found.result() if i == item)[:10] == want
    assert found.scored < 0.4 * scores.size
