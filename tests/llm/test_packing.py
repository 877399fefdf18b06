"""Packing against the tokenizer itself, and the cutting-stock plan against its bounds."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkmill.llm import packing as pk
from linkmill.llm.queries import op9_packing, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
JSON = open(PATH, encoding="utf-8").read()
TOKENIZER = Tokenizer.from_file(PATH)


def check(rows, got, sequence=4096):
    """rows: (doc_id, text) with distinct ids."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, tokens, seq, offset in got:
        docs[doc_id].append((start, length, crc, tokens))
        sequences[seq].append((offset, length))
    assert set(docs) == {d for d, _ in rows}
    for doc_id, text in rows:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for start, length, crc, tokens in sorted(docs[doc_id]):
            assert (start, tokens) == (at, len(ids))
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
        padding += 0 if at & (at - 1) == 0 else sequence - at
    return padding / max(1, len(sequences) * sequence)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert check(rows, op9_packing(spark, folder).collect()) < 0.02


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.sampled_from(
    ["a.b", "Don't.", "x,.", "<|endoftext|>", "É.", "ΑΣ", "á", "1.5,", "ß", " ", "\x1c", "İ", "it's", "...", "'s"]),
    max_size=12), st.sampled_from([" ", "\n", "\t ", "", "\x0b", " "]))
def test_runs_give_the_ids_of_the_text(parts, gap):
    text = gap.join(parts)
    assert pk.WordTokens(JSON)(text.encode()).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_small_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(pk, "RUNS", 3)
    monkeypatch.setattr(pk, "SLICE_BYTES", 8)
    texts = ["one two three four five. One", "two three, six", None, "one SEVEN eight nine one two", "", " five. five "]
    found = [ids.tolist() for ids in pk.WordTokens(JSON).texts(pa.array(texts, pa.string()).slice(1))]
    assert found == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]


def test_the_inverse_of_a_basis():
    rng = np.random.default_rng(1)
    for n in (1, 2, 60):
        basis = np.triu(rng.integers(0, 4, (n, n))) + np.eye(n) * 9
        basis = basis[rng.permutation(n)]
        assert np.allclose(pk._inverse(basis.copy()) @ basis, np.eye(n), atol=1e-8)


def test_a_plan_beside_a_live_session(spark):
    """With the threads that the linear algebra library takes by itself."""
    assert spark.range(10).count() == 10
    counts = np.random.default_rng(2).integers(0, 400, 512)
    assert sum((p * t for p, t in pk.cutting_stock(counts, 512)), np.zeros(512, np.int64)).tolist() == counts.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=16, max_size=16))
def test_plan_holds_all_pieces(counts):
    plan = pk.cutting_stock(np.array(counts), 16)
    total = sum((p * t for p, t in plan), np.zeros(16, np.int64))
    assert total.tolist() == counts
    assert all(int(p @ np.arange(1, 17)) <= 16 for p, _ in plan)
    placed = pk.Assignment.of(plan)
    used = defaultdict(int)
    for c, n in enumerate(counts, 1):
        for s in placed.place(np.full(n, c), np.arange(n)).tolist() if n else ():
            used[s] += c
    assert max(used.values(), default=0) <= 16 and len(used) == sum(t for _, t in plan)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    for draw in (rng.integers(1, 513, 200_000), np.minimum(512, rng.exponential(70, 200_000).astype(int) + 1),
                 rng.integers(200, 300, 100_000)):
        counts = np.bincount(draw, minlength=513)[1:]
        n = sum(t for _, t in pk.cutting_stock(counts, 512))
        best = max(int(np.ceil(draw.sum() / 512)), int((draw > 256).sum()) if draw.min() < 200 else int(np.ceil(len(draw) / 2)))
        assert n <= 1.01 * best + 5


@pytest.mark.parametrize("grain", [8, 1])
def test_odd_rows(spark, grain):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 5000), (5, "a " * 4095), (6, "a " * 2047), (7, "x" * 30_000),
            (None, "no id"), (9, "É ß <|endoftext|> don't."), *((100 + i, "z " * (i % 7)) for i in range(60))]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows],
                                  "doc_id long, text string, start int, order int, rank string")
    assert check(rows, pk.pack_documents(frame, JSON, grain=grain).collect()) < 0.2
    twice = pk.pack_documents(frame.union(frame), JSON)
    assert twice.count() == 2 * pk.pack_documents(frame, JSON).count()
    assert twice.select("sequence_id", "offset").distinct().count() == twice.count()
    assert pk.pack_documents(frame.limit(0), JSON).count() == 0
