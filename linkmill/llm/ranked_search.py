"""Exact top-k lexical search of a query table over all documents, by two trees.

Documents become vectors over the terms of the items. In a task, chunks of vectors form a
tree whose nodes hold the largest value of each term; the items form another one with the
largest weights. The product of two nodes bounds every score below them, and a pair whose
bound is under the weakest k-th score of its items is left out with all its documents.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from linkmill.llm.common import Staged

#: Terms of the items that one pass over the documents takes; more items take more passes.
ITEM_TERMS = 1 << 16
#: Documents of one tree, and their entries at most.
TREE_ROWS, TREE_ENTRIES = 2048, 1 << 19
#: Documents and items under the lowest nodes.
LEAF_ROWS, LEAF_ITEMS = 32, 4
#: Documents, chosen by a hash, whose scores give the first k-th scores to beat.
SAMPLE = 4096
#: Rounds in which the rows of a node are parted between two centres.
ROUNDS = 4
SLICE_BYTES = 1 << 20
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z lower-cased."""
    return _TERM.findall(text.lower())


class Rows:
    """A sparse matrix by rows: columns and values of row i stand from bounds[i] to bounds[i + 1]."""

    def __init__(self, bounds: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.bounds, self.columns, self.values = bounds, columns, values

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = (self.bounds[1:] - self.bounds[:-1])[rows]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Rows(bounds, self.columns[at], self.values[at])

    def times(self, vector: np.ndarray) -> np.ndarray:
        """Product of each row with a dense vector."""
        total = np.concatenate(([0], np.cumsum(self.values * vector[self.columns])))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def merged(self, starts: np.ndarray) -> Rows:
        """Rows of coordinate maxima: row j of those from starts[j] up to starts[j + 1]."""
        group = np.searchsorted(starts, np.repeat(np.arange(len(self)), np.diff(self.bounds)), "right") - 1
        order = np.lexsort((self.values, self.columns, group))
        group, columns, values = group[order], self.columns[order], self.values[order]
        last = np.ones(len(order), bool)
        last[:-1] = (group[1:] != group[:-1]) | (columns[1:] != columns[:-1])
        return Rows(np.searchsorted(group[last], np.arange(len(starts) + 1)), columns[last], values[last])


def by_likeness(rows: Rows, width: int, leaf: int) -> np.ndarray:
    """An order of the rows in which halves, quarters and so on hold like rows."""
    parts = [np.arange(len(rows))]
    while max(map(len, parts)) > leaf:
        halves = []
        for part in parts:
            if len(part) <= leaf:
                halves.append(part)
                continue
            some = rows.take(part)
            row = np.repeat(np.arange(len(part)), np.diff(some.bounds))
            side = np.arange(len(part)) % 2
            for _ in range(ROUNDS):
                likeness = []
                for half in (0, 1):
                    centre = np.bincount(some.columns, some.values * (side[row] == half), width)
                    likeness.append(some.times(centre / (np.linalg.norm(centre) or 1)))
                order = np.argsort(likeness[0] - likeness[1], kind="stable")
                side[order[:len(part) // 2]], side[order[len(part) // 2:]] = 0, 1
            # Halves are filled up to a multiple of the leaf, so that nodes cover equal spans.
            cut = leaf * (1 << max(0, math.ceil(math.log2(len(part) / leaf)) - 1))
            halves += [part[order[:cut]], part[order[cut:]]]
        parts = halves
    return np.concatenate(parts)


class Tree:
    """Rows in an order of likeness, and levels of nodes with the maxima of their rows.

    levels[0] are the lowest nodes; node j of a level covers nodes 2j and 2j + 1 below.
    """

    def __init__(self, rows: Rows, width: int, leaf: int):
        self.leaf, self.order = leaf, by_likeness(rows, width, leaf)
        self.rows = rows.take(self.order)
        self.levels = [self.rows.merged(np.arange(0, len(rows), leaf))]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].merged(np.arange(0, len(self.levels[-1]), 2)))


class Search:
    """Top k documents of each item among those that were shown, with their exact scores."""

    def __init__(self, items: Rows, width: int, k: int, kth: np.ndarray):
        self.tree, self.width, self.k = Tree(items, width, LEAF_ITEMS), width, k
        self.kth = kth[self.tree.order]
        self.found: list[list[tuple]] = [[] for _ in range(len(items))]
        self.pairs = self.scored = 0
        self._weakest()

    def _weakest(self) -> None:
        """The weakest k-th score below each node."""
        self.weak = [np.minimum.reduceat(self.kth, np.arange(0, len(self.kth), LEAF_ITEMS))]
        while len(self.weak[-1]) > 1:
            self.weak.append(np.minimum.reduceat(self.weak[-1], np.arange(0, len(self.weak[-1]), 2)))

    def show(self, docs: Rows, ids: list) -> None:
        tree = Tree(docs, self.width, LEAF_ROWS)
        names = [ids[i] for i in tree.order.tolist()]
        top = len(self.tree.levels) - 1
        # Pairs to visit: a node of documents, and nodes of one level of the items.
        waiting = [(len(tree.levels) - 1, 0, top, np.array([0]))]
        dense = np.zeros(self.width, np.int64)
        while waiting:
            level, node, height, nodes = waiting.pop()
            here = tree.levels[level]
            span = slice(here.bounds[node], here.bounds[node + 1])
            dense[here.columns[span]] = here.values[span]
            nodes = self._kept(dense, height, nodes)
            while level == 0 and height > 0 and len(nodes):
                nodes, height = self._below(height, nodes)
                nodes = self._kept(dense, height, nodes)
            dense[here.columns[span]] = 0
            if not len(nodes):
                continue
            if level == 0:
                self._score(tree.rows, node, names, nodes)
                continue
            if height > 0:
                nodes, height = self._below(height, nodes)
            children = [c for c in (2 * node + 1, 2 * node) if c < len(tree.levels[level - 1])]
            waiting += [(level - 1, c, height, nodes) for c in children]

    def _below(self, height: int, nodes: np.ndarray) -> tuple[np.ndarray, int]:
        children = np.concatenate((2 * nodes, 2 * nodes + 1))
        return np.sort(children[children < len(self.tree.levels[height - 1])]), height - 1

    def _kept(self, dense: np.ndarray, height: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes whose bound reaches the weakest k-th score: a tie may still win by its id."""
        self.pairs += len(nodes)
        bound = self.tree.levels[height].take(nodes).times(dense)
        return nodes[(bound > 0) & (bound >= self.weak[height][nodes])]

    def _score(self, docs: Rows, node: int, names: list, nodes: np.ndarray) -> None:
        first = node * LEAF_ROWS
        rows = np.arange(first, min(first + LEAF_ROWS, len(docs)))
        some = docs.take(rows)
        block = np.zeros((len(rows), self.width), np.int64)
        block[np.repeat(np.arange(len(rows)), np.diff(some.bounds)), some.columns] = some.values
        items = (nodes[:, None] * LEAF_ITEMS + np.arange(LEAF_ITEMS)).ravel()
        items = items[items < len(self.tree.rows)]
        weights = self.tree.rows.take(items)
        total = np.zeros((len(rows), len(weights.columns) + 1), np.int64)
        np.cumsum(block[:, weights.columns] * weights.values, axis=1, out=total[:, 1:])
        scores = total[:, weights.bounds[1:]] - total[:, weights.bounds[:-1]]
        self.scored += scores.size
        hits = np.argwhere((scores > 0) & (scores >= self.kth[items])).tolist()
        if not hits:
            return
        touched = set()
        for row, i in hits:
            name = names[first + row]
            item = int(items[i])
            self.found[item].append((-int(scores[row, i]), name is None, name or 0, name))
            touched.add(item)
        for item in touched:
            best = self.found[item]
            if len(best) >= self.k:
                best = self.found[item] = heapq.nsmallest(self.k, best)
                self.kth[item] = max(self.kth[item], -best[-1][0])
        self._weakest()

    def result(self) -> Iterator[tuple[int, object, int]]:
        """(item, id, score) of all that was kept."""
        for place, item in enumerate(self.tree.order.tolist()):
            for score, _, _, name in self.found[place]:
                yield item, name, -score


def impacts(n: np.ndarray, tf: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Value of a term that stands tf times in a document of n terms, before its weight."""
    m = 75 + 25 * n * documents // words
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def count_terms(docs: DataFrame, codes: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text), terms (codes of those in `codes`), tf, without a shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(codes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value.get
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            ends = np.cumsum([0, *(len(t) for t in texts.to_pylist())])
            row = 0
            while row < len(texts):
                end = min(len(texts), max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, "right")) - 1))
                n, found, size = [], [], []
                for text in texts.slice(row, end - row).to_pylist():
                    words = terms_of(text)
                    known = [c for c in map(code, words) if c is not None]
                    n.append(len(words))
                    size.append(len(known))
                    found += known
                owner = np.repeat(np.arange(end - row), size)
                key, tf = np.unique(owner * np.int64(len(shared.value) + 1) + np.array(found, np.int64), return_counts=True)
                bounds = pa.array(np.searchsorted(key // (len(shared.value) + 1), np.arange(end - row + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(bounds, pa.array(key % (len(shared.value) + 1), pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tf"])
                row = end

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<int>")


def _trees(batch: pa.RecordBatch, documents: int, words: int) -> Iterator[tuple[Rows, list]]:
    """The vectors of a batch in pieces that one tree holds."""
    terms, tf = batch.column("terms"), batch.column("tf")
    bounds, ids = np.asarray(terms.offsets).astype(np.int64), batch.column("doc_id").to_pylist()
    columns, counts = np.asarray(terms.values), np.asarray(tf.values).astype(np.int64)
    n = np.asarray(batch.column("n")).astype(np.int64)
    row = 0
    while row < len(ids):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + TREE_ENTRIES, "right")) - 1)
        end = min(end, row + TREE_ROWS, len(ids))
        span = slice(bounds[row], bounds[end])
        sizes = np.diff(bounds[row:end + 1])
        value = impacts(np.repeat(n[row:end], sizes), counts[span], documents, words)
        yield Rows(bounds[row:end + 1] - bounds[row], columns[span], value), ids[row:end]
        row = end


def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """Best documents of the tasks for the items of one block: row, item_id, doc_id, score."""
    spark = docs.sparkSession
    codes: dict[bytes, int] = {}
    for item in block:
        for term in item.terms:
            codes.setdefault(bytes(term), len(codes))
    vectors = Staged(count_terms(docs, codes), "term-vectors").df
    totals = vectors.where("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    documents, words = totals.documents, totals.words or 0
    weight = np.zeros(len(codes) + 1, np.int64)
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    for term, df in held.collect():  # a row per term of the items at most
        weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    bounds = np.cumsum([0, *(len(item.terms) for item in block)])
    columns = np.array([codes[bytes(t)] for item in block for t in item.terms], np.int64)
    counts = np.array([c for item in block for c in item.counts], np.int64)
    parts = bounds, columns, counts * weight[columns]
    width = len(weight)

    sample = vectors.where(F.size("terms") > 0).orderBy(F.xxhash64("doc_id", "n", "terms")).limit(SAMPLE)
    first = Search(Rows(*parts), width, k, np.ones(len(block), np.int64))
    for batch in sample.toArrow().combine_chunks().to_batches():
        for rows, ids in _trees(batch, documents, words):
            first.show(rows, ids)
    kth = np.ones(len(block), np.int64)
    kth[first.tree.order] = first.kth
    names = [(item.row, item.item_id) for item in block]
    shared = spark.sparkContext.broadcast((parts, kth, names))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, kth, names = shared.value
        found = Search(Rows(*parts), width, k, kth)
        for batch in batches:
            for rows, ids in _trees(batch, documents, words):
                found.show(rows, ids)
        result = list(found.result())
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i][0] for i, _, _ in result], pa.int64()), pa.array([names[i][1] for i, _, _ in result], pa.int64()),
             pa.array([d for _, d, _ in result], pa.int64()), pa.array([s for _, _, s in result], pa.int64())],
            names=["row", "item_id", "doc_id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(search, "row long, item_id long, doc_id long, score long")


def item_vectors(items: DataFrame) -> DataFrame:
    """row, item_id, terms, counts of the items that have a term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                one: dict[bytes, int] = {}
                for term in terms_of(text or b""):
                    one[term] = one.get(term, 0) + 1
                terms.append(list(one))
                counts.append(list(one.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["row", "item_id", "terms", "counts"])

    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(count, "row long, item_id long, terms array<binary>, counts array<long>")
    return found.where(F.size("terms") > 0)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0.

    Every row of `items` is an item and every row of `docs` a document, whether ids repeat
    or are null; of equal scores the smaller doc_id comes first, null last. A null text or
    one without terms matches nothing. Items are taken in blocks of about `ITEM_TERMS` terms,
    each with its own pass over the documents. The k-th scores to beat come from `SAMPLE`
    documents; they only prune, and what they prune could not have been among the k best.
    """
    spark = docs.sparkSession
    queries = Staged(item_vectors(items), "items").df
    size = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-size // ITEM_TERMS)
    if blocks == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = None
    for i in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).collect()
        if block:
            part = _search_block(docs, block, k)
            found = part if found is None else found.union(part)
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
