"""Piece counts against a cut piece by piece and against the tokenizers' own word-piece model."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from linkmill.llm.queries import op7_token_counts, tokenizer_path
from linkmill.llm.token_counts import PieceCounter, read_pieces, token_counts

PIECES = read_pieces(tokenizer_path("piece_bpe_32k.model"))


def greedy(word, first, inner):
    at, n = 0, 0
    while at < len(word):
        pool = inner if at else first
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5)), st.sets(st.text("abc", min_size=1, max_size=5)),
       st.lists(st.text("abcd", min_size=1, max_size=14), max_size=10))
def test_automaton_equals_greedy_cut(first, inner, words):
    counter = PieceCounter(first, inner)
    assert [counter.count(w) for w in words] == [greedy(w, first, inner) for w in words]


def test_query_equals_the_tokenizers_model(spark):
    from tokenizers import Tokenizer, models

    first, inner = PIECES
    vocab = {p: i for i, p in enumerate(dict.fromkeys(["[UNK]", *first, *("##" + p for p in inner)]))}
    model = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10**6))
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = re.findall(r"\w+|[^\w\s]", r.text or "")
        tokens = [model.encode(w).tokens for w in words]
        want[r.doc_id] = (len(words), sum(map(len, tokens)), tokens.count(["[UNK]"]))
    assert {r[0]: tuple(r)[1:] for r in op7_token_counts(spark, folder).collect()} == want


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (2, " \n"), (None, "ab ab"), (4, "a" * 100_000), (5, "ab! ?"), (5, "ab! ?")]
    frame = spark.createDataFrame([(d, t, d) for d, t in rows], "doc_id long, text string, n_words long")
    got = token_counts(frame, ["ab", "a", "!"], ["a", "aa"])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [
        (1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (None, 2, 2, 0), (4, 1, 50_001, 0), (5, 3, 3, 1), (5, 3, 3, 1)]))
    assert token_counts(frame.limit(0), ["a"], []).count() == 0
