import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkmill.llm import alignment
from linkmill.llm.alignment import Matrix, align_documents, byte_alphabet, groups, overlaps
from linkmill.llm.queries import op13_alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens(text):
    """(id, bytes) of both tokenizers over the whole text at once; none if it is not spelt exactly."""
    if not text:
        return [], []
    byte = byte_alphabet()
    a = [(i, bytes(byte[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())
         for i in B.encode(text)]
    whole = (" " + text).encode()
    exact = b"".join(x for _, x in a) == whole and b"".join(x for _, x in b) == whole
    return (a, b) if exact else ([], [])


def brute_force(docs):
    parsed, holders = [], Counter()
    for doc, text in docs:
        a, b = tokens(text)
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]).tolist(), np.cumsum([len(x) for _, x in b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        parts = [([], []) for _ in cuts]
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for (i, _), end in zip(ids, ends):
                parts[next(j for j, c in enumerate(cuts) if c >= end)][side].append(i)
        links = [(x, y) for p, q in parts for x in p for y in q]
        holders.update(set(links))
        parsed.append((doc, a, b, parts, links))
    highest = Counter()
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc, a, b, parts, links in parsed:
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in parts)
        out.append((doc, len(a), len(b), len(parts), len(links), sum(holders[x] == highest[x[0]] for x in links),
                    sum(holders[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda x: tuple((v is None, v or type(x[-1])() if isinstance(v, str) else v or 0) for v in x))


def test_query_agrees_with_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs]
    got = op13_alignment(spark, folder)
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == ordered(brute_force(docs))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 40)
    monkeypatch.setattr(alignment, "LIST_PAIRS", 7)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 60)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 150)
    monkeypatch.setattr(alignment, "PRODUCT", 5)
    monkeypatch.setattr(alignment, "WORDS", 3)
    texts = ["", None, " ", "   two  blanks ", "tab\tand\nline\r\n", "<s>x</s><|endoftext|><0x41>", "▁mark", "naïve 日本語 ①ﬁ 😀",
             "=" * 90, "the the the the", "The cat's 1234", "\0\x01", "a b　c", "under ▁ score"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "the cat"), (9, "the cat"), (9, "the cat")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, pairs string").repartition(3)
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        args = f.read(), g.read(), public_tokenizers.PATTERN
    assert ordered(align_documents(frame, *args).collect()) == ordered(brute_force(docs))
    assert align_documents(frame.where("false"), *args).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.data())
def test_products_and_groups(a, data):
    total = sum(a)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, total - 1)), max_size=15)) - {total}) if total > 1 else []
    b = np.diff([0, *cuts, total])
    a = np.array(a)
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    dense_a = np.array([[e - n <= k < e for k in range(total)] for n, e in zip(a, ends_a)], int)
    dense_b = np.array([[e - n <= k < e for k in range(total)] for n, e in zip(b, ends_b)], int)
    product = np.zeros((len(a), len(b)), int)
    row, column, value = overlaps(a, b)
    product[row, column] = value
    assert (product == dense_a @ dense_b.T).all()
    both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    of_a, of_b = groups(a, b)
    assert of_a.tolist() == [next(j for j, c in enumerate(both) if c >= e) for e in ends_a]
    assert of_b.tolist() == [next(j for j, c in enumerate(both) if c >= e) for e in ends_b]


def test_a_product_of_empty_matrices():
    empty = Matrix(np.zeros(1, np.int64), np.zeros(0, np.int64))
    assert [len(x) for x in empty.times(empty)] == [0, 0, 0]
