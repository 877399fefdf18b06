"""Byte-level byte-pair encoding and decoding with Spark's higher-order functions.

A byte is written as the character of the same number, so that words and tokens are
strings, tokens can be keys of a literal map, and joined strings are joined bytes. The
words of a chunk of documents are made distinct by Arrow; each distinct word is folded
once, merge by merge, and the documents pick their words' ids by position. No step
shuffles, so neither a frequent word nor a document gathers rows.
"""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes of the documents whose words are made distinct together.
CHUNK_BYTES = 32 << 20
LATIN = "ISO-8859-1"
#: An entry of the fold, from the highest bits: rank (20 bits), place in the word (23), token (20).
PLACE, RANK = 20, 43
TOKENS = NO_RANK = (1 << 20) - 1
PLACES = (1 << 23) - 1
#: White space as the tokenizers have it; Java's \s knows ASCII only.
SPACE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a rank file (a line is a token in base64 and its rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The splitting pattern for Spark's functions: Unicode white space written out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


def split_words(text: Column, pattern: str) -> Column:
    """All matches of the pattern, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: a fold over nothing, as an indexed transform derives its type for each value."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def _literal(value, kind: str) -> Column:
    """A constant of any size: text that Spark parses once, while it optimises the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def merged(word: bytes, ranks: Mapping[bytes, int], least: int = 1) -> list[int]:
    """Ids of a word by merging alone, as `BytePairs` folds it, until `least` are left."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > least:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def shifted_rows(rows: Mapping[int, Mapping[int, int]], n: int) -> tuple[list[int], list[int], list[int]]:
    """Rows of column -> value in one array: the shift of each of `n` rows; whose row an entry is of, or -1; its value."""
    shift = [0] * n
    row_of, value = np.full(2 * n, -1), np.zeros(2 * n, np.int64)
    at = size = 0
    for key, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        columns = np.array(sorted(row))
        offsets = columns - columns[0]
        at, size = at if len(row) == size else 0, len(row)  # what was too full for a row is so for others of its size
        while True:
            while at + 1024 + offsets[-1] > len(row_of):
                row_of, value = np.append(row_of, np.full(len(row_of), -1)), np.append(value, np.zeros_like(value))
            free = at + np.flatnonzero(row_of[at:at + 1024] < 0)
            free = free[(row_of[free[:, None] + offsets] < 0).all(1)]
            if len(free):
                break
            at += 1024
        shift[key] = int(free[0] - columns[0])
        row_of[free[0] + offsets] = key
        value[free[0] + offsets] = [row[c] for c in columns.tolist()]
    end = int(np.flatnonzero(row_of >= 0)[-1]) + 1 if rows else 0
    return shift, row_of[:end].tolist(), value[:end].tolist()


class BytePairs:
    """Encoding and decoding by ranked merges.

    Of all neighbouring tokens whose joined bytes have a rank, those with the lowest rank
    are merged, the first ones of several, until there are none. A word that has a rank
    itself is that token. Every single byte must have a rank.

    The rank map leads from a pair of tokens to the rank of their joined bytes. A token
    can only arise from the pair that merging its own bytes ends with: merges within its
    bytes are the same ones in any word. So a token has one pair. The pairs of a left token
    are a row, and the rows lie shifted in one array without overlap; a second array tells
    whose row an entry is of.
    """

    def __init__(self, ranks: Mapping[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must be the numbers from 0")
        if len(ranks) > NO_RANK:
            raise ValueError(f"at most {NO_RANK} ranks fit into an entry of the fold")
        self.pieces = [b""] * len(ranks)
        self.apart: dict[str, int] = {}  # Tokens that merging does not reach; there are none in a trained vocabulary.
        rows: dict[int, dict[int, int]] = {}
        for token, rank in ranks.items():
            self.pieces[rank] = token
            if len(token) > 1:
                pair = merged(token, ranks, 2)
                if len(pair) == 2:
                    rows.setdefault(pair[0], {})[pair[1]] = rank
                else:
                    self.apart[token.decode(LATIN)] = rank
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.shift, self.row_of, self.rank_at = shifted_rows(rows, len(ranks))

    def encode(self, words: Column) -> Column:
        """Ids of each word of an array of words: a fold over the merges of each.

        The state has a number per token: the rank of the token with its right neighbour,
        its place, and the token. So the smallest number is the merge that is next. A word
        has at most 2 ** 23 bytes.
        """
        def with_tables(single: Column, shift: Column, row_of: Column, rank_at: Column) -> Column:
            def rank(a: Column, b: Column) -> Column:
                """Shifted to its place; none for what is no pair, neighbours beyond the ends included."""
                at = F.get(shift, a) + b
                return F.when(F.get(row_of, at) == a, F.get(rank_at, at)).otherwise(_long(NO_RANK << RANK))

            def token(x: Column) -> Column:
                return x.bitwiseAND(_long(TOKENS))

            def merge(s: Column, _: Column) -> Column:
                def put(low: Column, i: Column, new: Column) -> Column:
                    def entry(x: Column, j: Column) -> Column:
                        left = rank(token(x), new) + x.bitwiseAND(_long((1 << RANK) - 1))
                        here = rank(new, token(F.get(s, i + 2))) + low.bitwiseAND(_long(PLACES << PLACE)) + new
                        return (F.when(j > i + 1, x - _long(1 << PLACE)).when(j < i - 1, x)
                                .when(j == i, here).when(j < i, left).otherwise(_long(-1)))

                    return F.array_remove(F.transform(s, entry), _long(-1))

                def at(low: Column) -> Column:
                    place = F.shiftright(low, PLACE).bitwiseAND(_long(PLACES)).cast("int")
                    return F.when(low >= _long(NO_RANK << RANK), s).otherwise(
                        let(place, lambda i: let(F.shiftright(low, RANK), lambda new: put(low, i, new))))

                return let(F.array_min(s), at)

            def fold(word: Column) -> Column:
                def start(parts: Column) -> Column:
                    entries = F.transform(parts, lambda x, j: rank(x, F.get(parts, j + 1)) + F.shiftleft(j.cast("long"), PLACE) + x)
                    return F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), entries, merge,
                                       lambda s: F.transform(s, lambda x: token(x).cast("int")))

                return let(F.transform(F.split(word, ""), lambda c: F.get(single, F.ascii(c))), start)

            def ids(word: Column) -> Column:
                if not self.apart:
                    return fold(word)
                known = F.try_element_at(_literal(self.apart, "map<string,int>"), word)
                return F.when(known.isNotNull(), F.array(known)).otherwise(fold(word))

            return F.transform(words, lambda w: let(F.decode(F.encode(w, "UTF-8"), LATIN), ids))

        def numbers(values: list[int], body: Callable[[Column], Column]) -> Column:
            return let(_literal(values, "array<bigint>"), body)

        ranks = [rank << RANK for rank in self.rank_at]
        return numbers(self.single, lambda single: numbers(self.shift, lambda shift: numbers(
            self.row_of, lambda row_of: numbers(ranks, lambda rank_at: with_tables(single, shift, row_of, rank_at)))))

    @staticmethod
    def _joined(ids: Column, names: list[bytes]) -> Column:
        # Binary in JSON is base64; as strings the bytes stay as they are, and no lambda keeps the table from being a constant.
        table = _literal([base64.b64encode(n).decode() for n in names], "array<binary>").cast("array<string>")
        return F.array_join(F.transform(ids, lambda i: F.get(table, i)), "").cast("binary")

    def decode(self, ids: Column) -> Column:
        """The bytes of an array of ids."""
        return self._joined(ids, self.pieces)

    def packed(self, ids: Column) -> Column:
        """The ids as little-endian unsigned 32-bit integers."""
        return self._joined(ids, [struct.pack("<I", i) for i in range(len(self.pieces))])


def word_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, words) rows to one row per chunk: distinct words, and each document's words by position."""
    for batch in batches:
        words = batch.column(1).cast(pa.list_(pa.large_string()))
        bounds = np.asarray(words.offsets)
        ends = np.asarray(words.values.cast(pa.large_binary()).buffers()[1]).view(np.int64) if len(words.values) else np.zeros(1)
        size = ends[bounds] if len(words.values) else np.zeros(len(bounds))
        row = 0
        while row < len(words):
            end = max(row + 1, int(np.searchsorted(size, size[row] + CHUNK_BYTES, "right")) - 1)
            end = min(end, len(words))
            coded = words.values.slice(bounds[row], bounds[end] - bounds[row]).dictionary_encode()
            codes = pa.ListArray.from_arrays(pa.array(bounds[row:end + 1] - bounds[row], pa.int32()), coded.indices)
            docs = pa.StructArray.from_arrays([batch.column(0).slice(row, end - row), codes], ["doc_id", "codes"])
            distinct = coded.dictionary.cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct),
                 pa.ListArray.from_arrays(pa.array([0, end - row], pa.int32()), docs)], ["words", "docs"])
            row = end


def _by_document(docs: DataFrame, pairs: BytePairs, pattern: str,
                 columns: Mapping[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]]) -> DataFrame:
    """doc_id, and columns of each document: what is made of the ids of a word, and then of all that a document's words give."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_words(F.col("text"), pattern).alias("words"))
    chunks = rows.mapInArrow(word_chunks, "words array<string>, docs array<struct<doc_id:bigint,codes:array<int>>>")

    def words(ids: Column) -> Column:
        return F.struct(*(F.transform(ids, of_word).alias(name) for name, (of_word, _) in columns.items()))

    def row(doc: Column, words: Column) -> Column:
        return F.struct(doc.doc_id.alias("doc_id"), *(
            of_document(F.transform(doc.codes, lambda c: F.get(words[name], c))).alias(name)
            for name, (_, of_document) in columns.items()))

    found = let(pairs.encode(F.col("words")), lambda ids: let(words(ids), lambda w: F.transform("docs", lambda d: row(d, w))))
    # The outer form: no row is without documents, and the plain one would compute them twice to find that out.
    return chunks.select(F.inline_outer(found))


def encode_documents(docs: DataFrame, pairs: BytePairs, pattern: str) -> DataFrame:
    """doc_id, ids (array of int): every whole text, each match of `pattern` encoded by itself.

    A null or empty text has no ids. Rows that repeat an id, or have none, stay apart. Letters
    and digits are those of the JVM's Unicode tables. A word of n bytes takes time n * n.
    """
    return _by_document(docs, pairs, pattern, {"ids": (lambda ids: ids, F.flatten)})


def encode_bytes(docs: DataFrame, pairs: BytePairs, pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), decoded (binary: the bytes of the ids).

    As `encode_documents`; a distinct word's ids are packed and decoded once, documents join them.
    """
    def joined(words: Column) -> Column:
        return F.array_join(words, "").cast("binary")

    return _by_document(docs, pairs, pattern, {"ids": (lambda ids: pairs.packed(ids).cast("string"), joined),
                                               "decoded": (lambda ids: pairs.decode(ids).cast("string"), joined)})


def encoding_report(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, encoded and decoded again."""
    return encode_bytes(docs, BytePairs(ranks), pattern).select(
        "doc_id", F.shiftright(F.octet_length("ids"), 2).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
