import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from linkmill.llm.byte_pairs import BytePairs, encode_bytes, encode_documents, encoding_report, merged, read_ranks
from linkmill.llm.queries import op11_byte_pairs

RANKS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WHOLE = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=RANKS, special_tokens={})

ODD = ["", " ", "  \n\n  x", "it's I'LL we've 's", "<|endoftext|> a", "ünïcödé ñ 日本語 😀👩‍👩‍👧", "a b c　", "\0\x01\x7f",
       "x" * 700, "=" * 300 + "ab" * 200, "12345 6789 ²½", "a\u0085b\x1cc", "\r\n\t end  ", "Ærøskøbing 'tis"]


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_agrees_with_the_library_on_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op11_byte_pairs(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])


def test_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (3, "again", "x"), (3, "again", "x"), (99, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string").repartition(3)
    got = encoding_report(docs, RANKS, public_tokenizers.PATTERN).collect()
    key = lambda x: (x[0] is None, str(x))
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(t)) for i, t, _ in rows), key=key)
    assert encoding_report(docs.where("false"), RANKS, public_tokenizers.PATTERN).collect() == []


def test_plan_has_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = encode_documents(docs, BytePairs(RANKS), public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_bytes_of_documents_are_those_of_their_words(spark):
    texts = [*ODD, None, "\U0001f600" * 3 + "\u00ff\u07ff \u00ff"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in encode_bytes(docs, BytePairs(RANKS), public_tokenizers.PATTERN).collect()}
    ids = {i: LIBRARY.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert got == {i: (struct.pack(f"<{len(x)}I", *x), (texts[i] or "").encode()) for i, x in ids.items()}


def test_report_packs_and_decodes_distinct_words_only(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = encoding_report(docs, RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().analyzed().toString()
    assert "array_join" in plan and "flatten" not in plan  # the ids of a whole text are never listed


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=12))
def test_merging_is_that_of_the_library(word):
    assert merged(word.encode(), RANKS) == WHOLE.encode_ordinary(word)


def test_tokens_that_merging_does_not_reach(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"xy": 257, b"xyxy": 258}
    library = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    pairs = BytePairs(ranks)
    assert pairs.apart == {"abc": 256}
    texts = ["abc abcd xyxyxy xyx", "aabc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode_documents(docs, pairs, r"\S+|\s+").collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        BytePairs({b"a": 0})


def test_a_token_has_one_pair_and_its_row_leads_to_it():
    pairs = BytePairs(RANKS)
    for token, rank in RANKS.items():
        if len(token) > 1:
            left, right = merged(token, RANKS, 2)
            at = pairs.shift[left] + right
            assert (pairs.row_of[at], pairs.rank_at[at]) == (left, rank)
    assert sum(row >= 0 for row in pairs.row_of) == len(RANKS) - 256


def test_fold_searches_no_map(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = encoding_report(docs, RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().analyzed().toString()
    assert "map_from_entries" not in plan and "element_at" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_ranks_in_any_order(spark, seed):
    rng = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)] + sorted({"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(60)})
    rng.shuffle(tokens)  # a token may rank before its parts, and be out of reach
    ranks = {token: rank for rank, token in enumerate(tokens)}
    words = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.ids for r in encode_documents(docs, BytePairs(ranks), r"\S+|\s+").collect()}
    assert got == {i: [ranks[w.encode()]] if w.encode() in ranks else merged(w.encode(), ranks) for i, w in enumerate(words)}
