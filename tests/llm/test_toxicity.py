"""Toxicity: the automaton against plain edit distances, context, and held-out labels."""

import math
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from linkmill.llm import toxicity as tx
from linkmill.llm.queries import op10_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, x, b, i)
    return row[-1]


def _next(row, x, b, i):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def brute(terms, word):
    found = []
    for t, term in enumerate(terms):
        if term.stem:
            if word.startswith(term.text):
                found.append((0, t))
        elif (d := distance(term.text, word)) <= tx.edits_allowed(len(term.text)):
            found.append((d, t))
    return min(found, default=None)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=3, max_size=10), st.booleans()), max_size=8),
       st.lists(st.text("abcd", min_size=1, max_size=12), max_size=20))
def test_automaton_equals_edit_distance(terms, words):
    lexicon = [tx.Term(t, 1.0, stem) for t, stem in terms]
    automaton = tx.LexiconAutomaton(lexicon)
    for w in words:
        got, want = automaton.match(w), brute(lexicon, w)
        assert (got and got[0]) == (want and want[0]), (w, got, want)
        assert (got is None) == (want is None)


def test_context_and_misspellings():
    matcher = tx.Matcher([tx.Term("scoundrel", 5.0, False), tx.Term("blaff", 4.0, True)])
    used, misspelt, cited = tx.features("You Scoundrel! what a scuondrel, blaffing", matcher)
    assert abs(used - math.log1p(5 + 5 / 3 + 4)) < 1e-9 and abs(misspelt - math.log1p(5 / 3)) < 1e-9 and cited == 0
    assert tx.features('he said "scoundrel" to them', matcher)[0] == 0 < tx.features('he said "scoundrel"', matcher)[2]
    assert tx.features("the word scoundrel is old", matcher)[2] > 0
    assert tx.features("### SCOUNDREL!!", matcher)[0] > 0
    assert tx.features(None, matcher) == tx.features("", matcher) == tx.features("calm words only", matcher) == (0, 0, 0)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = op10_toxicity(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.7)
    unseen = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    caught = sum(p for p, y in unseen if y) / sum(y for _, y in unseen)
    wrong = sum(p for p, y in unseen if not y) / sum(not y for _, y in unseen)
    # A twelfth of the labelled texts there hold no toxic word: their text was replaced by junk.
    assert caught >= 0.9 and wrong <= 0.01


def test_odd_rows(spark):
    bad = [(i, f"the {w} is a vilewretch to us", 1) for i, w in enumerate("abcdefghijkl")]
    good = [(50 + i, f"quiet words {w} of a calm day in the garden", 0) for i, w in enumerate("abcdefghijklmnop")]
    odd = [(100, None, 0), (101, "", 0), (None, "vilewretch", 1), (102, "x " * 100_000 + "vilewretch", None),
           (103, "vilewretch", None), (103, "vilewretch", None), (104, "vilewretsh", None)]
    docs = spark.createDataFrame([(d, t, y, "s", 0.5) for d, t, y in bad + good + odd],
                                 "doc_id long, text string, toxic int, source string, score double")
    labels = docs.select("doc_id", "toxic")
    got = sorted(map(tuple, tx.toxicity(docs.drop("toxic"), labels).collect()), key=repr)
    assert len(got) == docs.count()
    scores = {}
    for d, held, score, predicted in got:
        scores[d] = score
        assert 0 <= score <= 1 and predicted == (score >= 0.7) and (d is not None or not held)
    assert min(scores[i] for i in range(12)) > max(scores[i] for i in (*range(50, 66), 100, 101))
    assert scores[103] > 0.7 and scores[104] > scores[50]
    assert tx.toxicity(docs.limit(0), labels).count() == 0
    none = tx.toxicity(docs, labels.limit(0)).collect()
    assert all(r.predicted == 0 for r in none) and len(none) == docs.count()
