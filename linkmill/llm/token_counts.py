"""Greedy word-piece counts in linear time.

The vocabulary's pieces form a trie. Where a word cannot be followed further, a failure
link leads to the node for the rest of it, and the number of pieces that the greedy cut
completes on the way is known beforehand. A word is read once, and no piece is built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORDS = 100_000
_PARTS = re.compile(r"\w+|[^\w\s]")
NONE = -1


def read_pieces(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that go on in it, of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        (first if piece.startswith("▁") else inner).append(piece.removeprefix("▁"))
    return [p for p in first if p], [p for p in inner if p and "▁" not in p]


class PieceCounter:
    """Number of pieces of a word by greedy longest match; None if it cannot be cut."""

    def __init__(self, first: Iterable[str], inner: Iterable[str]):
        # Nodes 0 and 1 are the roots for a word's beginning and for its rest.
        self.step: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, first), (1, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.step[node]:
                        self.step[node][c] = len(self.step)
                        self.step.append({})
                        whole.append(False)
                    node = self.step[node][c]
                whole[node] = True
        self.fail, self.popped = [NONE] * len(self.step), [0] * len(self.step)
        level = [(n, c, child) for n in (0, 1) for c, child in self.step[n].items()]
        while level:
            for parent, c, node in level:
                if whole[node]:
                    self.fail[node], self.popped[node] = 1, 1
                    continue
                z, count = self.fail[parent], self.popped[parent]
                while z != NONE and c not in self.step[z]:
                    count += self.popped[z]
                    z = self.fail[z]
                if z != NONE:
                    self.fail[node], self.popped[node] = self.step[z][c], count
            level = [(n, c, child) for _, _, n in level for c, child in self.step[n].items()]

    def count(self, word: str) -> int | None:
        node, pieces = 0, 0
        for c in word:
            while c not in self.step[node]:
                pieces += self.popped[node]
                node = self.fail[node]
                if node == NONE:
                    return None
            node = self.step[node][c]
        while node != 1:
            pieces += self.popped[node]
            node = self.fail[node]
            if node == NONE:
                return None
        return pieces


class Counts(dict):
    """Run of non-blank characters -> (words, tokens, unknown words), remembered for the latest runs."""

    def __init__(self, counter: PieceCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, run: bytes) -> tuple[int, int, int]:
        if len(self) > _WORDS:
            self.clear()
        parts = [self.counter.count(w) for w in _PARTS.findall(run.decode("utf-8", "surrogatepass"))]
        unknown = parts.count(None)
        value = self[run] = (len(parts), sum(p for p in parts if p is not None) + unknown, unknown)
        return value


def token_counts(docs: DataFrame, first: Iterable[str], inner: Iterable[str]) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every whole text, without a shuffle.

    A word is a run of word characters or one other character that is not white space. It is
    cut greedily into the longest piece of `first`, then the longest ones of `inner`; a word
    that cannot be cut is one unknown token. A null or empty text has no words. The automaton
    is as large as the vocabulary, and is sent to each executor once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceCounter(first, inner))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(shared.value)
        for batch in batches:
            totals = [[], [], []]
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = list(map(counts.__getitem__, text.split())) if text else []
                for total, values in zip(totals, zip(*found) if found else ((), (), ())):
                    total.append(sum(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(t, pa.int64()) for t in totals)],
                                             names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_unknown long")
