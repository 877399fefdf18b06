"""Alignment of two tokenizers over the same texts.

Tokens cover bytes; a token-byte incidence matrix has a row per token and a column per
byte. The row products A x B' of both tokenizers' matrices are the overlaps of tokens. Where
consecutive tokens overlap with no common token, both tokenizers end, and a group ends. The
products of the group-incidence matrices are the links: tokens that share a group.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.byte_pairs import split_words
from linkmill.llm.common import Staged, gathered, process_cache, run_bounds

#: Text bytes whose distinct words are tokenised together, and whose tokens are aligned together.
CHUNK_BYTES, SLICE_BYTES = 8 << 20, 1 << 19
#: Links of a chunk of documents that share one list of id pairs; pairs of a row of that list.
CHUNK_LINKS, LIST_PAIRS = 1 << 20, 1 << 16
#: Words that a tokenizer gets at a time; what it returns is much larger than their ids.
WORDS = 2048
#: Links that are multiplied out at a time.
PRODUCT = 1 << 20
SPACE = "▁"


class Matrix:
    """Compressed sparse rows: entries of row i stand from bounds[i] to bounds[i + 1]."""

    def __init__(self, bounds: np.ndarray, columns: np.ndarray, values: np.ndarray | None = None):
        self.bounds, self.columns = bounds, columns
        self.values = np.ones(len(columns), np.int64) if values is None else values

    def rows(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def times(self, other: Matrix) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values of the product, row by row (Gustavson).

        Each entry of a row here adds its multiple of a row of `other`; entries of the same
        row and column are then summed. Entries must come in the order of their columns, and
        so must the products, as they do for tokens of one text.
        """
        sizes = np.diff(other.bounds)[self.columns]
        at = gathered(other.bounds[self.columns], sizes)
        row, column = np.repeat(self.rows(), sizes), other.columns[at]
        value = np.repeat(self.values, sizes) * other.values[at]
        if not len(row):
            return row, column, value
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
        return row[new], column[new], np.add.reduceat(value, np.flatnonzero(new))


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token of A, token of B and their common bytes, for tokens of the given sizes over the same bytes."""
    total = int(a_sizes.sum())
    a = Matrix(run_bounds(a_sizes), np.arange(total))
    b_turned = Matrix(np.arange(total + 1), np.repeat(np.arange(len(b_sizes)), b_sizes))
    return a.times(b_turned)


def groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of A and of B. Groups end where tokens of both end."""
    a, b, _ = overlaps(a_sizes, b_sizes)
    of_a, of_b = np.zeros(len(a_sizes), np.int64), np.zeros(len(b_sizes), np.int64)
    if len(a):
        cut = np.zeros(len(a), np.int64)
        cut[1:] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
        cut = np.cumsum(cut)
        of_a[a], of_b[b] = cut, cut
    return of_a, of_b


def counted(group: np.ndarray, ids: np.ndarray, n_groups: int) -> Matrix:
    """Incidence of groups and ids: how often each id stands in each group."""
    key, counts = np.unique(group << 32 | ids, return_counts=True)
    return Matrix(np.searchsorted(key >> 32, np.arange(n_groups + 1)), key & 0xFFFFFFFF, counts)


def shared_links(a: Matrix, b: Matrix) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, id of A, id of B, links) by products of the group incidences, some groups at a time."""
    group = a.rows()
    sizes = np.diff(b.bounds)[group]
    done = np.concatenate(([0], np.cumsum(sizes)))
    first = 0
    while first < len(group):
        last = max(first + 1, int(np.searchsorted(done, done[first] + PRODUCT, "right")) - 1)
        # Entries of A as rows, each with its group as the only column.
        rows = Matrix(np.arange(last - first + 1), group[first:last], a.values[first:last])
        row, column, links = rows.times(b)
        yield group[first:last][row], a.columns[first:last][row], column, links
        first = last


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and how a text may be cut for them."""

    def __init__(self, byte_level: str, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        byte = byte_alphabet()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            # A special token has no byte-level form; it is never met, since its string is plain text.
            self.a_bytes[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else b""
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        #: Tokens of B never reach over a blank that follows something else: text may be cut there.
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def encode_a(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]

    def encode_b(self, parts: list[str]) -> list[list[int]]:
        """Parts begin with the blank that the tokenizer adds itself, but to an empty text."""
        blank = [self.b.piece_to_id(SPACE)]
        return [ids or blank for ids in self.b.encode([p[1:] for p in parts], num_threads=1)]


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def encoded(words: pa.Array, encode, table: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the words of many texts: word codes, bounds of each code's ids, ids, and whether the ids spell the word."""
    coded = words.dictionary_encode()
    sizes, flat, exact = [], [], []
    for at in range(0, len(coded.dictionary), WORDS):
        some = coded.dictionary.slice(at, WORDS).to_pylist()
        ids = encode(some)
        exact += [b"".join(map(table.__getitem__, x)) == w.encode() for w, x in zip(some, ids)]
        sizes += map(len, ids)
        flat.append(np.fromiter((i for x in ids for i in x), np.int32))
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    return np.asarray(coded.indices), run_bounds(np.array(sizes, np.int64)), ids, np.array(exact, bool)


class Aligned:
    """Documents of a chunk: their own figures, and links by the position of their id pair in the chunk's list."""

    def __init__(self, chunk: int):
        self.chunk, self.size = chunk, 0
        self.docs: list[tuple[pa.Array, dict[str, np.ndarray], list[str]]] = []
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # document, pair, links
        self.n = 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        doc, pair, links = (np.concatenate([x[i] for x in self.links]) for i in range(3))
        pairs, codes, held = np.unique(pair, return_inverse=True, return_counts=True)
        order = np.lexsort((codes, doc))
        bounds = pa.array(np.searchsorted(doc[order], np.arange(self.n + 1)), pa.int32())
        figures = [np.concatenate([d[1][c] for d in self.docs]) for c in FIGURES]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(self.n, self.chunk)), pa.concat_arrays([d[0] for d in self.docs]),
             *(pa.array(f, pa.int64()) for f in figures), pa.array([s for d in self.docs for s in d[2]], pa.string()),
             pa.ListArray.from_arrays(bounds, pa.array(codes[order], pa.int32())),
             pa.ListArray.from_arrays(bounds, pa.array(links[order], pa.int64())),
             pa.nulls(self.n, pa.int32()), pa.nulls(self.n, pa.list_(pa.int64())), pa.nulls(self.n, pa.list_(pa.int32()))],
            schema=_ARROW)
        starts = list(range(0, len(pairs), LIST_PAIRS))
        for at in starts:
            end = min(at + LIST_PAIRS, len(pairs))
            whole = pa.array([0, end - at], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.chunk], pa.int64()), *(pa.nulls(1, f.type) for f in list(_ARROW)[1:9]),
                 pa.array([at], pa.int32()), pa.ListArray.from_arrays(whole, pa.array(pairs[at:end], pa.int64())),
                 pa.ListArray.from_arrays(whole, pa.array(held[at:end], pa.int32()))], schema=_ARROW)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_ARROW = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), *((f, pa.int64()) for f in FIGURES),
                    ("groups_sha256", pa.string()), ("codes", pa.list_(pa.int32())), ("links", pa.list_(pa.int64())),
                    ("first", pa.int32()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))])
_STAGED = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes array<int>, links array<long>, first int, pairs array<long>, held array<int>")


def _names(n_a: int, n_b: int) -> pa.Array:
    """Decimal ids with the mark that follows: within a side, after the last of A, after the last of B."""
    return pa.array([f"{i}{mark}" for n, marks in ((n_a, ",|"), (n_b, ",;")) for mark in marks for i in range(n)], pa.binary())


def _align_slice(ids: pa.Array, a: tuple, b: tuple, voc: Vocabularies, names: pa.Array, out: Aligned) -> None:
    """Align some documents; a and b are (word codes, bounds of each document's words, *encoded())."""
    n, tokens, owner, size = len(ids), [], [], []
    usable = np.ones(n, bool)
    for codes, bounds, _, _, exact in (a, b):
        wrong = np.concatenate(([0], np.cumsum(~exact[codes])))
        usable &= (wrong[bounds[1:]] == wrong[bounds[:-1]]) & (bounds[1:] > bounds[:-1])
    for (codes, bounds, starts, flat, _), lengths in ((a, voc.a_sizes), (b, voc.b_sizes)):
        doc = np.repeat(np.arange(n), np.diff(bounds))
        good = usable[doc]
        codes, doc = codes[good], doc[good]
        counts = np.diff(starts)[codes]
        tokens.append(flat[gathered(starts[codes], counts)].astype(np.int64))
        owner.append(np.repeat(doc, counts))
        size.append(lengths[tokens[-1]])
    of_a, of_b = groups(*size)
    n_groups = int(of_a[-1]) + 1 if len(of_a) else 0
    doc_of_group = np.zeros(n_groups, np.int64)
    doc_of_group[of_a] = owner[0]

    per_a, per_b = np.bincount(of_a, minlength=n_groups), np.bincount(of_b, minlength=n_groups)
    figures = {"n_a": np.bincount(owner[0], minlength=n), "n_b": np.bincount(owner[1], minlength=n),
               "n_groups": np.bincount(doc_of_group, minlength=n),
               "n_links": np.zeros(n, np.int64)}
    np.add.at(figures["n_links"], doc_of_group, per_a * per_b)

    # The text of the groups: tokens of A, then of B, group by group.
    order = np.empty(len(of_a) + len(of_b), np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (of_a, of_b))
    at_a = np.arange(len(of_a)) + (np.cumsum(per_b) - per_b)[of_a]
    at_b = np.arange(len(of_b)) + np.cumsum(per_a)[of_b]
    order[at_a] = tokens[0] + last_a * len(voc.a_bytes)
    order[at_b] = tokens[1] + last_b * len(voc.b_bytes) + 2 * len(voc.a_bytes)
    text = names.take(pa.array(order)).cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = memoryview(text.buffers()[2]) if len(text) and text.buffers()[2] is not None else memoryview(b"")
    edges = ends[run_bounds(figures["n_a"] + figures["n_b"])].tolist()
    shas = [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(edges, edges[1:])]

    found = [(doc_of_group[g], x << 32 | y, links) for g, x, y, links in shared_links(
        counted(of_a, tokens[0], n_groups), counted(of_b, tokens[1], n_groups))]
    doc, pair, links = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    # A document's links of the same pair of ids are one entry.
    sorting = np.lexsort((pair, doc))
    doc, pair, links = doc[sorting], pair[sorting], links[sorting]
    if len(doc):
        new = np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))
        doc, pair, links = doc[new], pair[new], np.add.reduceat(links, np.flatnonzero(new))
    out.docs.append((ids, figures, shas))
    out.links.append(((doc + out.n).astype(np.int32), pair, links))
    out.n += n
    out.size += len(doc)


def aligned_chunks(docs: DataFrame, byte_level: str, pieces: bytes, pattern: str) -> DataFrame:
    """Documents with their figures and coded links, and the lists of id pairs of their chunks."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = process_cache("alignment")
        if not kept:
            voc = kept["voc"] = Vocabularies(*shared.value)
            voc.a_sizes, voc.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (voc.a_bytes, voc.b_bytes))
            kept["names"] = _names(len(voc.a_bytes), len(voc.b_bytes))
        voc, names = kept["voc"], kept["names"]
        number = TaskContext.get().partitionId() << 32
        out = Aligned(number)
        for batch in batches:
            columns = [batch.column(i) for i in (1, 2)]
            bounds = [np.asarray(c.offsets).astype(np.int64) for c in columns]
            ends = np.cumsum([0, *np.asarray(batch.column(3))])
            row = 0
            while row < len(batch):
                end = min(len(batch), max(row + 1, int(np.searchsorted(ends, ends[row] + CHUNK_BYTES, "right")) - 1))
                sides = [encoded(c.values.slice(x[row], x[end] - x[row]), encode, table) for c, x, encode, table in
                         zip(columns, bounds, (voc.encode_a, voc.encode_b), (voc.a_bytes, voc.b_bytes))]
                while row < end:
                    to = min(end, max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, "right")) - 1))
                    chosen = []
                    for (codes, starts, flat, exact), x in zip(sides, bounds):
                        base = x[end] - len(codes)
                        chosen.append((codes[x[row] - base:x[to] - base], x[row:to + 1] - x[row], starts, flat, exact))
                    _align_slice(batch.column(0).slice(row, to - row), *chosen, voc, names, out)
                    row = to
                    if out.size >= CHUNK_LINKS:
                        yield from out.batches()
                        number += 1
                        out = Aligned(number)
        if out.n:
            yield from out.batches()

    cuts = Vocabularies(byte_level, pieces).cuts
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spaced = F.concat(F.lit(" "), text)
    # A text with the piece mark itself cannot be spelt by B: its pieces say blank there.
    empty = (text == "") | text.contains(SPACE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _none(empty, split_words(spaced, pattern)),
                       _none(empty, F.regexp_extract_all(spaced, F.lit(" +[^ ]*" if cuts else "(?s).+"), F.lit(0))),
                       F.octet_length(text).cast("long").alias("size"))
    return rows.mapInArrow(align, _STAGED)


def _none(empty: Column, words: Column) -> Column:
    return F.when(empty, F.array().cast("array<string>")).otherwise(words)


def _summed(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk with the sums over their links; counts are those of the chunk's pairs."""
    by_code = np.argsort(np.asarray(counts.column("code")))
    count = np.asarray(counts.column("n"))[by_code]
    best = np.asarray(counts.column("best"))[by_code]
    docs = docs.combine_chunks()
    codes, links = docs.column("codes").combine_chunks(), docs.column("links").combine_chunks()
    bounds = np.asarray(codes.offsets).astype(np.int64)
    code = np.asarray(codes.values).astype(np.int64)
    n = np.asarray(links.values)
    sums = []
    for value in (n * best[code], n * count[code]) if len(code) else (n, n):
        total = np.concatenate(([0], np.cumsum(value)))
        sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64()))
    columns = [docs.column(c) for c in ("doc_id", *FIGURES)]
    return pa.table([*columns, *sums, docs.column("groups_sha256")],
                    names=["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])


def align_documents(docs: DataFrame, byte_level: str, pieces: bytes, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    `byte_level` is the JSON of a byte-level tokenizer (A), whose words `pattern` cuts, and
    `pieces` a sentencepiece model (B). A null or empty text, and one that either tokenizer
    does not spell byte for byte, has no tokens: zeros and an empty string. Rows that repeat
    an id, or have none, stay apart, and count apart as holders of their pairs.

    Documents come in chunks of about `CHUNK_LINKS` links with one list of their id pairs, so
    that a pair which stands in very many documents is one row per chunk wherever rows meet,
    and what is joined back to the documents is a fraction of their links.
    """
    chunks = Staged(aligned_chunks(docs, byte_level, pieces, pattern), "aligned").df
    listed = chunks.where("pairs is not null")
    at = listed.select("chunk", "first", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "entry"))
    pairs = at.select("chunk", (F.col("first") + F.col("place")).alias("code"), F.col("entry.pairs").alias("pair"),
                      F.col("entry.held").alias("held"))
    counts = Staged(pairs.groupBy("pair").agg(F.sum("held").alias("n")), "pair-counts").df
    a = F.shiftright("pair", 32)
    # One row per id of A: no more than its vocabulary.
    highest = F.broadcast(counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest")))
    marked = counts.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).cast("int").alias("best"))
    known = pairs.join(marked, "pair").select(F.col("chunk").alias("of_chunk"), "code", "n", "best")
    rows = chunks.where("pairs is null").select("chunk", "doc_id", *FIGURES, "groups_sha256", "codes", "links")
    return rows.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")
