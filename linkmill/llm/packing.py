"""Packing documents into sequences of fixed length by cutting-stock column generation.

Documents are cut at full sequences; what is left of each is packed. Lengths are rounded up to
a histogram of classes. A linear program over patterns of classes is solved by generating
columns: a knapsack program finds the pattern that the present prices call for. Rounded
patterns, and greedy ones for the few pieces left, say which ranks of each class go where.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.common import Staged, gathered, process_cache, run_bounds

SEQUENCE = 4_096
GRAIN = 8
END_ID = 2
# Column generation stops when the bound shows that at most this share could still be saved.
GAP = 1e-3
MAX_COLUMNS = 1_000
RANK_ROWS = 8_192
# Text bytes whose runs are made distinct together, and whose ids are put together.
CHUNK_BYTES, SLICE_BYTES = 1 << 24, 1 << 20
# Runs that the tokenizer gets at a time; what it returns is much larger than their ids.
RUNS = 2_048
_MARKS = ".,"
_PLAIN = "^[\\x{41}-\\x{5A}\\x{61}-\\x{7A}\\x{AA}-\\x{12F}\\x{131}-\\x{17F}]+$"


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordTokens:
    """Ids of texts, looked up run by run of characters between ASCII white space.

    White space never joins its neighbours in this vocabulary, so the ids of a text are those of its
    runs. Points and commas after a letter are tokens of their own, and a word of plain letters goes
    to the vocabulary's model as the tokenizer would spell it; other runs go to the tokenizer.
    Runs, and then words, are made distinct by Arrow, so Python works per distinct word.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each core has a task already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.bare = Tokenizer(self.tokenizer.model)
        self.letters = _byte_letters()

    @staticmethod
    def _ids(tokenizer, texts: pa.Array, spell=None) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of texts."""
        sizes, flat = [], array("I")
        for at in range(0, len(texts), RUNS):
            some = texts.slice(at, RUNS).to_pylist()
            for e in tokenizer.encode_batch_fast(list(map(spell, some)) if spell else some, add_special_tokens=False):
                ids = e.ids
                sizes.append(len(ids))
                flat.extend(ids)
        return np.array(sizes, np.int64), np.frombuffer(flat, "<u4") if flat else np.zeros(0, "<u4")

    def _spelling(self, word: str) -> str:
        """How the model sees a word of plain letters."""
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def distinct(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each run's ids begin (and the end of the last), and the ids."""
        words = pc.ascii_rtrim(runs, characters=_MARKS)
        plain = pc.and_(pc.utf8_is_alpha(words), pc.match_substring_regex(words, _PLAIN))
        is_plain = plain.to_numpy(zero_copy_only=False)
        spelled = pc.utf8_lower(words.filter(plain)).dictionary_encode()
        n_marks = pc.subtract(pc.binary_length(runs), pc.binary_length(words)).to_numpy()[is_plain]
        marks = pa.array([r[len(r) - n:] if n else "" for r, n in zip(runs.filter(plain).to_pylist(), n_marks.tolist())],
                         pa.string()).dictionary_encode()
        parts = []  # (places, where their ids begin in the source, sizes, source)
        size = np.zeros(len(runs), np.int64)
        for places, coded, found in (
                (np.flatnonzero(is_plain), np.asarray(spelled.indices), self._ids(self.bare, spelled.dictionary, self._spelling)),
                (np.flatnonzero(is_plain), np.asarray(marks.indices), self._ids(self.tokenizer, marks.dictionary)),
                (np.flatnonzero(~is_plain), None, self._ids(self.tokenizer, runs.filter(pc.invert(plain))))):
            sizes, ids = found
            coded = np.arange(len(places)) if coded is None else coded
            parts.append((places, run_bounds(sizes)[:-1][coded], sizes[coded], ids, size[places]))
            size[places] += sizes[coded]
        starts = run_bounds(size)
        out = np.empty(starts[-1], "<u4")
        for places, source, sizes, ids, before in parts:
            out[gathered(starts[places] + before, sizes)] = ids[gathered(source, sizes)]
        return starts, out

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn; null counts as empty."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        bounds = np.asarray(split.offsets).astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        codes = np.asarray(coded.indices)
        starts, ids = self.distinct(coded.dictionary.cast(pa.large_string()))
        sizes = np.diff(starts)
        row, most = 0, SLICE_BYTES // 4
        while row < len(texts):
            end = min(len(texts), max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1))
            some = codes[bounds[row]:bounds[end]]
            found = ids[gathered(starts[some], sizes[some])]
            at = run_bounds(sizes[some])[bounds[row:end + 1] - bounds[row]]
            for i in range(end - row):
                yield found[at[i]:at[i + 1]]
            row = end

    def __call__(self, text: bytes) -> np.ndarray:
        return next(self.texts(pa.array([text.decode("utf-8", "surrogatepass")])))


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in slices of about `CHUNK_BYTES`."""
    ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))))
    row = 0
    while row < len(texts):
        end = min(len(texts), max(row + 1, int(np.searchsorted(ends, ends[row] + CHUNK_BYTES, "right")) - 1))
        yield texts.slice(row, end - row)
        row = end


def _pieces(shared, sequence: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, text_of = process_cache("word_tokens"), shared.value
        if text_of not in cache:
            cache[text_of] = WordTokens(text_of)
        tokens, end = cache[text_of], np.array([END_ID], "<u4")
        for batch in batches:
            rows, doc_ids = [], batch.column(0).to_pylist()
            found = (ids for chunk in _chunks(batch.column(1)) for ids in tokens.texts(chunk))
            for doc_id, ids in zip(doc_ids, found):
                ids = np.concatenate([ids, end])
                rows += [(doc_id, at, min(sequence, len(ids) - at), zlib.crc32(ids[at:at + sequence].tobytes()),
                          len(ids)) for at in range(0, len(ids), sequence)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def _best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack without bounds: the pattern of classes 1.. with the highest sum of prices."""
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    n = len(prices)
    for c in range(1, capacity + 1):
        k = min(n, c)
        options = value[c - k:c][::-1] + prices[:k]  # option i is class i + 1
        i = int(options.argmax())
        if options[i] > value[c - 1] + 1e-15:
            value[c], choice[c] = options[i], i + 1
        else:
            value[c] = value[c - 1]
    pattern, c = np.zeros(n, np.int64), capacity
    while c > 0:
        if choice[c]:
            pattern[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return float(value[capacity]), pattern


def _greedy(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Fill sequences with the largest classes that fit, repeating a pattern as often as pieces last."""
    out = []
    while left.any():
        pattern, room = np.zeros_like(left), capacity
        for c in range(len(left), 0, -1):
            if c <= room and left[c - 1]:
                pattern[c - 1] = min(left[c - 1], room // c)
                room -= pattern[c - 1] * c
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left = left - pattern * times
        out.append((pattern, times))
    return out


def _first_basis(present: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and amounts of a greedy solution: each column uses up a class that later ones lack, so they are a basis."""
    left, columns, amounts = demand.copy(), np.zeros((len(demand), len(demand))), np.zeros(len(demand))
    while (open_ := np.flatnonzero(left > 0)).size:
        pattern, room = np.zeros(len(demand)), capacity
        for i in open_[::-1]:
            pattern[i], room = divmod(room, int(present[i]) + 1)
            if not room:
                break
        used = np.flatnonzero(pattern)
        times = (left[used] / pattern[used]).min()
        left[used] -= times * pattern[used]
        gone = used[left[used] <= 1e-9 * demand[used]]
        left[gone] = 0
        columns[:, gone[0]], amounts[gone[0]] = pattern, times
        for i in gone[1:]:
            columns[i, i] = capacity // (present[i] + 1)
    return columns, amounts


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination, one step per class. It needs no threads of a linear algebra library, which the driver,
    a process beside a virtual machine, has been seen to wait for without end."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        if pivot != i:
            both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        rows = np.flatnonzero(both[:, i])
        rows = rows[rows != i]
        both[rows] -= both[rows, i][:, None] * both[i]
    return both[:, n:]


def cutting_stock(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) that hold exactly `counts` pieces of the classes 1..capacity.

    The linear program covers all pieces by as few patterns as it can; its basis starts from
    a greedy solution. Columns are priced until the bound of the prices is within `GAP`.
    """
    counts = np.asarray(counts, np.int64)
    present = np.flatnonzero(counts)
    if not len(present):
        return []
    demand = counts[present].astype(float)
    columns, x = _first_basis(present, demand, capacity)
    inverse = _inverse(columns)
    for step in range(MAX_COLUMNS):
        prices = np.zeros(len(counts))
        prices[present] = inverse.sum(axis=0)
        best, pattern = _best_pattern(np.maximum(prices, 0), capacity)
        bound = float((np.maximum(prices[present], 0) * demand).sum()) / max(best, 1)
        if best <= 1 + 1e-9 or x.sum() - bound <= GAP * x.sum():
            break
        new = pattern[present].astype(float)
        change = (inverse * new).sum(axis=1)
        rising = change > 1e-9
        ratios = np.where(rising, x / np.where(rising, change, 1), np.inf)
        out = int(ratios.argmin())
        x = np.maximum(x - ratios[out] * change, 0)
        x[out] = ratios[out]
        columns[:, out] = new
        if step % 200 == 199:
            inverse = _inverse(columns)
            x = np.maximum((inverse * demand).sum(axis=1), 0)
        else:
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
    left, plan = counts.copy(), []
    for column, times in zip(columns.T, np.floor(x + 1e-9).astype(np.int64)):
        pattern = np.zeros_like(counts)
        pattern[present] = column.round().astype(np.int64)
        used = pattern > 0
        times = min(int(times), int((left[used] // pattern[used]).min()))
        if times > 0:
            left = left - pattern * times
            plan.append((pattern, times))
    return plan + _greedy(left, capacity)


@dataclass(frozen=True)
class Assignment:
    """For each class the ranks at which a pattern begins, its first sequence, and its pieces of the class."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    each: dict[int, np.ndarray]

    @classmethod
    def of(cls, plan: list[tuple[np.ndarray, int]]) -> Assignment:
        first, sequence, each, at, ranks = {}, {}, {}, 0, {}
        for pattern, times in plan:
            for c in np.flatnonzero(pattern).tolist():
                n = int(pattern[c])
                first.setdefault(c + 1, []).append(ranks.get(c, 0))
                sequence.setdefault(c + 1, []).append(at)
                each.setdefault(c + 1, []).append(n)
                ranks[c] = ranks.get(c, 0) + n * times
            at += times
        arrays = [{c: np.array(v, np.int64) for c, v in d.items()} for d in (first, sequence, each)]
        return cls(*arrays)

    def place(self, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        out = np.empty(len(ranks), np.int64)
        for c in np.unique(classes).tolist():
            mine = classes == c
            r = ranks[mine]
            i = np.searchsorted(self.first[c], r, "right") - 1
            out[mine] = self.sequence[c][i] + (r - self.first[c][i]) // self.each[c][i]
        return out


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, grain: int = GRAIN) -> DataFrame:
    """Pack all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece.

    `tokenizer` is the text of a tokenizers file (`word_bpe_49k.json`). A document is its ids and
    the end id; null is empty. Full sequences are cut off its front, and only what is left is packed
    with others. Texts are read once and never move; the pieces do, five numbers each. The driver gets the
    histogram of at most `sequence / grain` classes. Ranks within a class are counted per
    bucket of a hash, so that a class with most pieces is many tasks. Repeated rows are packed each.
    """
    spark = docs.sparkSession
    shared, capacity = spark.sparkContext.broadcast(tokenizer), sequence // grain
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(_pieces(shared, sequence),
                             "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = Staged(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces").df
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = pieces.groupBy("class").count().collect()
    counts = np.zeros(capacity, np.int64)
    for r in histogram:
        counts[r["class"] - 1] = r["count"]
    plan = Assignment.of(cutting_stock(counts, capacity))
    # Plain arrays: an object of a class would be looked up in the worker's own packages.
    arrays = spark.sparkContext.broadcast((plan.first, plan.sequence, plan.each))

    buckets = max(1, int(counts.sum()) // RANK_ROWS)
    order = F.xxhash64("doc_id", "start", "ids_crc32", "rid")
    pieces = pieces.withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int"))
    before = pieces.groupBy("class", "bucket").count().select("class", "bucket", F.coalesce(F.sum("count").over(
        Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = pieces.withColumn("at", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("order", "rid")))
    ranked = ranked.join(before, ["class", "bucket"]).withColumn("rank", F.col("before") + F.col("at") - 1)

    @F.arrow_udf("long")
    def place(classes: pa.Array, ranks: pa.Array) -> pa.Array:
        return pa.array(Assignment(*arrays.value).place(classes.to_numpy(), ranks.to_numpy()), pa.int64())

    placed = ranked.withColumn("sequence_id", place("class", "rank"))
    within = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "order", "rid")
    offset = F.coalesce(F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         offset.cast("long").alias("offset"))
