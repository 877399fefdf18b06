"""Near vectors against brute force over all pairs."""

import numpy as np

from linkmill.llm import near_vectors as nv
from linkmill.llm.queries import op2_near_vectors


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = nv.unit(np.array([v for _, v in good])) if good else np.empty((0, 1))
    ids = [i for i, _ in good]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    low = list(ids)
    changed = True
    while changed:
        new = [min([low[a], *(low[b] for b in np.flatnonzero(near[a]))]) for a in range(len(ids))]
        changed, low = new != low, new
    links = {i: (int(near[a].sum()), low[a]) for a, i in enumerate(ids)}
    return sorted((i, *links.get(i, (0, i)), links.get(i, (0, i))[1] == i) for i, _ in rows)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op2_near_vectors(spark, folder).collect())) == brute(rows)


def test_planted_copies_of_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(3)
    for k in range(2000):
        v = np.array(rows[k // 4][1])
        noise = rng.normal(size=len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * rng.uniform(0, 0.5)
        rows.append((100_000 + k, (v + noise).tolist()))
    want = brute(rows)
    got = sorted(map(tuple, nv.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert [r[0] for r in got] == [r[0] for r in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.995 * sum(w[1] for w in want) > 4000


def test_lists_of_many_blocks_and_loose_clusters(spark, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", 20)
    monkeypatch.setattr(nv, "LIST_ROWS", 40)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = np.concatenate([c + rng.normal(size=(30, 24)) * s for c, s in zip(centres, np.linspace(0.05, 0.5, 12))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute(rows), sorted(map(tuple, nv.near_vectors(frame).collect()))
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (10, [0.0, -3.0]), (10, [0.0, -3.0]), (11, [1e-3, 0.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                  "vec_id long, embedding array<double>, n long, digest string")
    got = sorted(map(tuple, nv.near_vectors(frame).collect()))
    want = sorted((i, {7: 3, 8: 3, 9: 3, 11: 3, 10: 1}.get(i, 0), 7 if i in (7, 8, 9, 11) else i,
                   i not in (8, 9, 11)) for i, _ in rows)
    assert got == want
    assert nv.near_vectors(frame.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0])],
                                 "vec_id long, embedding array<double>")
    assert sorted(map(repr, map(tuple, nv.near_vectors(lone.limit(1)).collect()))) == ["(None, 0, None, False)"]
    assert sum(r.n_links for r in nv.near_vectors(lone).collect()) == 0


def clustered(d, rng, n=1500):
    """Unit vectors around 40 centres, every third one followed by a copy at cosine 0.951 to 0.99."""
    centres = rng.normal(size=(40, d))
    x = nv.unit(centres[rng.integers(0, 40, n)] + rng.normal(size=(n, d)) * 0.7)
    for i in range(0, n - 1, 3):
        side = rng.normal(size=d)
        side = nv.unit((side - side @ x[i] * x[i])[None])[0]
        c = rng.uniform(0.951, 0.99)
        x[i + 1] = c * x[i] + np.sqrt(1 - c * c) * side
    return x


def test_pre_filter_loses_no_near_pair_of_long_vectors():
    for d in (24, 64, 128, 256, 384, 768):
        x = clustered(d, np.random.default_rng(d))
        tool = nv.Quantiser.fit(x, 1)
        codes = tool.codes_of(x, np.zeros(len(x), int))
        least, greatest = tool.bounds(x, 0, codes, 0.95)
        rough, near = tool.approximate(x, 0, codes), x @ x.T >= 0.95
        kept = (rough >= least) & (rough <= greatest)
        assert near.sum() >= len(x) + 900 and kept[near].all()
        assert kept.mean() < 0.25


def test_long_vectors_of_several_dimensions(spark, monkeypatch):
    monkeypatch.setattr(nv, "LIST_ROWS", 100)
    monkeypatch.setattr(nv, "BLOCK", 400)
    rows, want = [], []
    for k, (d, n) in enumerate(((128, 900), (384, 600), (768, 900), (5, 40), (64, 300))):
        part = [(10_000 * k + i, v.tolist()) for i, v in enumerate(clustered(d, np.random.default_rng(k), n))]
        rows += part
        want += brute(part)
    got = sorted(map(tuple, nv.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert [g[0] for g in got] == [w[0] for w in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    for k in range(5):
        a, b = (sum(x[1] for x in r if x[0] // 10_000 == k) for r in (got, want))
        assert a >= 0.99 * b > 0
