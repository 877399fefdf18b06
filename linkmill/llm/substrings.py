"""Repeated passages by suffix automata of reference shards.

A window is `WINDOW` consecutive words. Of the grams in a window the one with the smallest
hash is its anchor, so equal windows have equal anchors, and windows with one anchor lie side
by side: they make up a segment. Anchors that occur once hold nothing repeated. Of the others
the distinct segments are the reference. It is dealt to shards by anchor; a shard's segments
form one suffix automaton, whose states know how often their strings occur, and the
segments are streamed through it: where the matched length reaches the window and the state
occurs twice, the window is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import Staged, hashed_texts, mix, signed, windows

GRAM = 8
# Words that the automaton of a shard is built from, about.
SHARD_WORDS = 60_000
# Anchors with more distinct segments than this have those cut down to windows whose hash recurs first.
LARGE = 256
_BASE = 0x9E6C63D0876A9A75
_UNBASE = pow(_BASE, -1, 1 << 64)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of each run of windows with one anchor."""
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    gram = min(GRAM, window)
    grams = windows(words, gram)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    place = view.argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return grams[place[first]], first, np.append(first[1:], n) - 1


def segment_hashes(words: np.ndarray, first: np.ndarray, end: np.ndarray, kept: dict) -> np.ndarray:
    """Hash of the words from `first` up to `end`."""
    n = len(words)
    if len(kept.get("up", ())) < n + 1:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            p = np.full(max(n + 1, 1 << 16), base, np.uint64)
            p[0] = 1
            kept[name] = np.multiply.accumulate(p)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * kept["up"][:n], out=total[1:])
    return mix((total[end] - total[first]) * kept["down"][first] + (end - first).astype(np.uint64))


class SuffixAutomaton:
    """Of several word sequences, each with a weight; states count occurrences."""

    def __init__(self) -> None:
        self.step: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _clone(self, p: int, q: int, c) -> int:
        copy = len(self.step)
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        while p != -1 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list, weight: int) -> None:
        step, link, length, last = self.step, self.link, self.length, 0
        for c in words:
            q = step[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, c)
            else:
                new, p = len(step), last
                step.append({})
                length.append(length[last] + 1)
                link.append(0)
                self.count.append(0)
                while p != -1 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p != -1:
                    q = step[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
                last = new
            self.count[last] += weight

    def finish(self) -> None:
        """Every string also occurs where a longer one ends in it."""
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list, window: int) -> list[int]:
        """Starts of the windows that occur at least twice, by matching statistics cut off at the window."""
        state, matched, found = 0, 0, []
        for end, c in enumerate(words):
            while state and c not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.step[state]:
                state, matched = self.step[state][c], matched + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
            matched = min(matched, self.length[state], window)
            if matched == window and self.count[state] >= 2:
                found.append(end - window + 1)
        return found


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: dict = {}
            texts = batch.column(1).cast(pa.binary())
            for row, hashes, bounds in hashed_texts(texts, kept):
                n = len(bounds) - 1
                found = [anchors(hashes[bounds[i]:bounds[i + 1]], window) for i in range(n)]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32))
                flat = [np.concatenate([f[k] for f in found]) for k in range(3)]
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (
                    signed(flat[0]), flat[1].astype(np.int32), flat[2].astype(np.int32))]
                digests = [_digest(_words(t)) for t in texts.slice(row, n).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(np.diff(bounds)), pa.array(digests), *lists],
                    names=["doc_id", "n_words", "digest", "hashes", "lows", "highs"])

    return scan


def _segments(window: int):
    """The repeated anchors' segments of each text: hash of the words, and where its windows begin."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: dict = {}
            ranges = [np.array([(r["low"], r["high"]) for r in rs], np.int64).reshape(-1, 2)
                      for rs in batch.column(2).to_pylist()]
            anchor = [[r["hash"] for r in rs] for rs in batch.column(2).to_pylist()]
            for row, hashes, bounds in hashed_texts(batch.column(1), kept):
                n = len(bounds) - 1
                out = [[], [], [], [], []]
                for i in range(n):
                    r = ranges[row + i]
                    if not len(r):
                        continue
                    s = segment_hashes(hashes[bounds[i]:bounds[i + 1]], r[:, 0], r[:, 1] + window, kept)
                    for o, x in zip(out, (np.full(len(r), batch.column(0)[row + i].as_py()), np.array(anchor[row + i]),
                                          signed(s), r[:, 0], r[:, 1] - r[:, 0] + 1)):
                        o.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(o) if o else np.empty(0, np.int64), pa.int64()) for o in out],
                    names=["rid", "hash", "segment", "low", "n"])

    return cut


def _reference(window: int):
    """The words of chosen segments."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, chosen in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                rows += [(r["hash"], r["segment"], r["weight"],
                          b" ".join(words[r["low"]:r["low"] + r["n"] + window - 1])) for r in chosen]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["hash", "segment", "weight", "words"])

    return read


def _window_hashes(window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: dict = {}
            for row, hashes, bounds in hashed_texts(batch.column(3), kept):
                for i in range(len(bounds) - 1):
                    words = hashes[bounds[i]:bounds[i + 1]]
                    starts = np.arange(len(words) - window + 1)
                    found = segment_hashes(words, starts, starts + window, kept)
                    n, at = len(starts), row + i
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.full(n, batch.column(c)[at].as_py()), pa.int64()) for c in range(3)),
                         pa.array(starts, pa.int64()), pa.array(signed(found))],
                        names=["hash", "segment", "weight", "at", "fingerprint"])

    return each


def _runs(window: int):
    """Cut segments down to runs of the given windows."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, segment, weight, text, starts in zip(*(c.to_pylist() for c in batch.columns)):
                words, starts = _words(text), sorted(starts)
                first = 0
                for i in range(1, len(starts) + 1):
                    if i == len(starts) or starts[i] != starts[i - 1] + 1:
                        run = b" ".join(words[starts[first]:starts[i - 1] + window])
                        piece = int.from_bytes(hashlib.blake2b(run, digest_size=8).digest(), "little", signed=True)
                        rows.append((h, segment, weight, run, starts[first], piece))
                        first = i
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["hash", "segment", "weight", "words", "shift", "piece"])

    return cut


def _decide(window: int):
    """Build a shard's automaton from its pieces and stream them through it."""
    def decide(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        automaton, ids = SuffixAutomaton(), {}
        pieces = [[ids.setdefault(w, len(ids)) for w in _words(t)] for t in table["words"].to_pylist()]
        for words, weight in zip(pieces, table["weight"].to_pylist()):
            automaton.add(words, weight)
        automaton.finish()
        masks = [sum(1 << i for i in automaton.repeated(words, window)) for words in pieces]
        return pa.table({"hash": table["hash"], "piece": table["piece"], "mask": pa.array(masks, pa.int64())})

    return decide


def _strip(window: int):
    """Leave out the words that the marked windows cover."""
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, texts = [], []
            for text, marks in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                words = _words(text)
                change = np.zeros(len(words) + 1, np.int32)
                for m in marks:
                    mask, low = m["mask"], m["low"]
                    while mask:
                        i = (mask & -mask).bit_length() - 1
                        change[low + i] += 1
                        change[low + i + window] -= 1
                        mask &= mask - 1
                covered = np.cumsum(change[:-1]) > 0
                removed.append(int(covered.sum()))
                texts.append(b" ".join(words[i] for i in np.flatnonzero(~covered)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["rid", "n_removed", "kept"])

    return strip


SCANNED = "doc_id long, n_words long, digest string, hashes array<long>, lows array<int>, highs array<int>"


def remove_repeats(docs: DataFrame, window: int = 35) -> tuple[DataFrame, DataFrame]:
    """Find the words that windows occurring elsewhere cover, in every whole text.

    Returns (rows, texts). rows has a row per input row: rid, doc_id, n_words, digest (SHA-256 of all
    words joined by one space). texts has, for texts that lose words: rid, n_removed and kept, the
    words left over. Words are told apart exactly as they are. Null and empty texts have no words,
    texts shorter than a window lose none; of repeated rows and equal texts every copy goes.

    What moves are anchors (about one in fifteen words) and, once, texts that hold a repeated anchor.
    Equal segments are folded and counted before they meet, so that a passage in a third of all
    documents is a few rows per task; its edges, which differ in every document, are cut off
    by the hashes of their windows before an automaton is built. A shard's automaton has a bounded size
    and goes to the task of that shard only.
    """
    if window - GRAM + 1 > 60:
        raise ValueError("a segment's windows must fit the bits of a number: take a larger GRAM")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = texts.mapInArrow(_scan(window), SCANNED).withColumn("rid", F.monotonically_increasing_id())
    scanned = Staged(scanned, "scanned").df
    each = scanned.select("rid", F.explode(F.arrays_zip("hashes", "lows", "highs")).alias("a")).select(
        "rid", F.col("a.hashes").alias("hash"), F.col("a.lows").alias("low"), F.col("a.highs").alias("high"))
    again = scanned.select(F.explode("hashes").alias("hash")).groupBy("hash").count().where("count > 1").select("hash")
    ranges = each.join(again, "hash").groupBy("rid").agg(F.collect_list(F.struct("hash", "low", "high")).alias("ranges"))

    # Texts with a repeated anchor move once. Rows that share an id find their own text by its digest.
    owners = ranges.join(scanned.select("rid", "doc_id", "digest"), "rid").withColumnRenamed("doc_id", "owner")
    owned = texts.join(owners, F.col("doc_id").eqNullSafe(F.col("owner")))
    words = F.array_join(F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != ""), " ")
    owned = owned.where(F.sha2(words.cast("binary"), 256) == F.col("digest")).select("rid", "text", "ranges")
    temporary = [Staged(owned, "owned")]
    owned = temporary[-1].df

    segments = owned.mapInArrow(_segments(window), "rid long, hash long, segment long, low long, n long")
    temporary.append(Staged(segments.dropDuplicates(["rid", "low"]), "segments"))
    segments = temporary[-1].df
    kinds = segments.groupBy("hash", "segment").agg(
        F.count("*").alias("weight"), F.min(F.struct("rid", "low", "n")).alias("first"))
    temporary.append(Staged(kinds, "kinds"))
    kinds = temporary[-1].df
    sizes = kinds.groupBy("hash").agg(F.count("*").alias("kinds"))
    kinds = kinds.join(sizes, "hash")
    alone = kinds.where("kinds = 1 AND weight > 1")
    chosen = kinds.where("kinds > 1").select("first.rid", F.struct(
        "hash", "segment", "weight", "first.low", "first.n").alias("r"), "kinds")

    def reference(which: str) -> DataFrame:
        lists = chosen.where(which).groupBy("rid").agg(F.collect_list("r").alias("chosen"))
        read = owned.select("rid", "text").join(lists, "rid").select("text", "chosen").mapInArrow(
            _reference(window), "hash long, segment long, weight long, words binary")
        return read.dropDuplicates(["hash", "segment"])

    small = reference(f"kinds <= {LARGE}").withColumns({"shift": F.lit(0).cast("long"), "piece": F.col("segment")})
    temporary.append(Staged(reference(f"kinds > {LARGE}"), "large"))
    large = temporary[-1].df
    each_window = large.mapInArrow(_window_hashes(window),
                                   "hash long, segment long, weight long, at long, fingerprint long")
    recurring = each_window.groupBy("hash", "fingerprint").agg(F.sum("weight").alias("w")).where("w > 1")
    starts = each_window.join(recurring, ["hash", "fingerprint"], "left_semi").groupBy("hash", "segment").agg(
        F.collect_list("at").alias("starts"))
    cut = large.join(starts, ["hash", "segment"]).select("hash", "segment", "weight", "words", "starts").mapInArrow(
        _runs(window), "hash long, segment long, weight long, words binary, shift long, piece long")
    temporary.append(Staged(small.unionByName(cut), "pieces"))
    pieces = temporary[-1].df

    distinct = pieces.groupBy("hash", "piece").agg(F.sum("weight").alias("weight"), F.min("words").alias("words"))
    n_words = pieces.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, n_words // (5 * SHARD_WORDS))
    decided = distinct.groupBy(F.pmod(F.xxhash64("hash"), F.lit(shards)).alias("shard")).applyInArrow(
        _decide(window), "hash long, piece long, mask long")
    marks = pieces.select("hash", "segment", "shift", "piece").join(decided.where("mask <> 0"), ["hash", "piece"])
    marks = marks.select("hash", "segment", F.expr("shiftleft(mask, cast(shift as int))").alias("mask")).groupBy(
        "hash", "segment").agg(F.bit_or("mask").alias("mask"))
    whole = alone.select("hash", "segment", (F.expr("shiftleft(1L, cast(first.n as int))") - 1).alias("mask"))
    marked = segments.join(marks.unionByName(whole), ["hash", "segment"]).groupBy("rid").agg(
        F.collect_list(F.struct("low", "mask")).alias("marks"))
    stripped = owned.select("rid", "text").join(marked, "rid").mapInArrow(
        _strip(window), "rid long, n_removed long, kept string")
    texts = Staged(stripped.dropDuplicates(["rid"]), "stripped").df
    for table in temporary:
        table.drop()
    return scanned.select("rid", "doc_id", "n_words", "digest"), texts


def repeats_report(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of `docs`."""
    rows, texts = remove_repeats(docs, window)
    texts = texts.select("rid", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("sha"))
    return rows.join(texts, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha", "digest").alias("kept_sha256"))


def strip_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """`docs` with the words left over in place of the texts that lose some; n_chars, if there, follows.

    Texts that lose nothing stay as they are, to the character. A document that loses all its words is left out.
    Rows that share an id are told apart by their words.
    """
    rows, texts = remove_repeats(docs, window)
    changed = rows.join(texts, "rid").groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_set(F.struct("digest", "kept")).alias("_kept"))
    joined = docs.join(changed, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    words = F.array_join(F.filter(F.split(F.col("text").cast("string"), "[ \\x09-\\x0D]+"), lambda w: w != ""), " ")
    own = F.sha2(words.cast("binary"), 256)
    mine = F.when(F.col("_kept").isNotNull(), F.get(F.filter("_kept", lambda k: k.digest == own), F.lit(0)).kept)
    joined = joined.withColumn("_mine", mine).where("_mine IS NULL OR _mine <> ''")
    columns = {"text": F.coalesce("_mine", "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("_mine").isNull(), F.col("n_chars")).otherwise(
            F.char_length("_mine").cast(docs.schema["n_chars"].dataType))
    return joined.select(*(columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns))
