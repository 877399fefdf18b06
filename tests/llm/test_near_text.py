"""Near-duplicate documents against brute force over all pairs."""

import re

from linkmill.llm.near_text import near_duplicates
from linkmill.llm.queries import op1_near_text

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)], d == low[find(i)]) for i, (d, _) in enumerate(rows))


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, op1_near_text(spark, folder).collect())) == brute(rows, 85)


def test_chain_of_near_copies_and_odd_texts(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(100 + k, " ".join(words[k * 12:k * 12 + 200])) for k in range(12)]  # each links only to the next
    rows += [(1, ""), (2, None), (3, " \t\n"), (4, "One two"), (5, "one TWO\n"), (6, "one two three"), (7, "É à"),
             (8, "é à"), (9, "x" * 50_000), (10, " ".join(words) * 40), (11, " ".join(words) * 40)]
    rows += [(20, "a b c d e f g")] * 2
    frame = spark.createDataFrame([(d, t, "s", d, "x") for d, t in rows],
                                  "doc_id long, text string, rep string, digest long, bands string")
    assert sorted(map(tuple, near_duplicates(frame, 85).collect())) == brute(rows, 85)
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, None), (3, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(repr, map(tuple, near_duplicates(nulls).collect()))) == [
        "(3, 2, 3, True)", "(None, 0, None, False)", "(None, 2, 3, False)"]
    assert near_duplicates(frame.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    """Different texts under one id are each compared; what links to any of them bears that id."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a), (5, b), (8, a + " more"), (9, b + " other"), (5, a), (30, "x y z u v w"), (30, None), (31, "x y z u v w"),
            (None, b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.component_id) for r in near_duplicates(frame, 85).collect()))
    assert got == [(0, 5), (5, 5), (5, 5), (5, 5), (8, 5), (9, 5), (30, 30), (30, 30), (31, 30)]
