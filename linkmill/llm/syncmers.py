"""Document fingerprints from closed syncmers.

A k-mer of the text is an anchor if the smallest of its inner s-mers lies at one of its
edges. Whether it is one depends on its own characters only, so an edit elsewhere moves no
anchor. A fingerprint keeps the anchors with the smallest hashes and their places.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.common import mix

K, S = 16, 6
# From this length on every text has an anchor: one of any K - S mers that follow each other is one.
SURE = 2 * K - S - 1
ANCHORS = 64
FLUSH_ROWS = 1_000
_BLOCK = 1 << 18
_BASE = 0x2545F4914F6CDD1D
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    p = np.full(_BLOCK + 2 * K, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Syncmers:
    """Fingerprints of texts and their likeness."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE), _powers(_UNBASE)

    def _mers(self, total: np.ndarray, length: int, at: np.ndarray | slice, salt: int) -> np.ndarray:
        if isinstance(at, slice):
            part = (total[length:] - total[:-length]) * self.down[:len(total) - length]
        else:
            part = (total[at + length] - total[at]) * self.down[at]
        return mix(part + np.uint64(salt))

    def _block(self, codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[:len(codes)], out=total[1:])
        inner = self._mers(total, s, slice(None), s)
        span = k - s + 1
        low, width = inner, 1
        while width < span:
            step = min(width, span - width)
            low = np.minimum(low[:len(low) - step], low[step:])
            width += step
        at = np.flatnonzero((inner[:len(low)] == low) | (inner[span - 1:] == low))
        return self._mers(total, k, at, k) >> np.uint64(32), at

    def anchors(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Up to `ANCHORS` distinct hashes in ascending order with the first place of each.

        A text shorter than `SURE` uses shorter mers, all of them anchors.
        """
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        if n == 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        k, s = (K, S) if n >= SURE else ((n + 2) // 3, (n + 2) // 3)
        kept, places = np.empty(0, np.uint64), np.empty(0, np.int64)
        for start in range(0, n - k + 1, _BLOCK):
            hashes, at = self._block(codes[start:start + _BLOCK + k - 1], k, s)
            hashes, first = np.unique(np.concatenate([kept, hashes]), return_index=True)
            kept, places = hashes[:ANCHORS], np.concatenate([places, at + start])[first[:ANCHORS]]
        return kept, places


def encode(anchors: tuple[np.ndarray, np.ndarray]) -> str:
    """Eight hexadecimal digits of the hash and then the place, anchors parted by a point."""
    return ".".join(f"{h:08x}{p:x}" for h, p in zip(*(x.tolist() for x in anchors)))


def decode(fingerprint: str) -> dict[int, int]:
    return {int(x[:8], 16): int(x[8:], 16) for x in fingerprint.split(".")} if fingerprint else {}


def _likeness(x: dict[int, int], y: dict[int, int]) -> float:
    if x == y:
        return 1.0
    union = sorted(x.keys() | y.keys())[:ANCHORS]
    pairs = sorted((x[h], y[h]) for h in union if h in x and h in y)
    tails: list[int] = []
    for _, place in pairs:
        at = bisect_left(tails, place)
        tails[at:at + 1] = [place]
    return len(tails) / len(union)


def likeness(a: str, b: str) -> float:
    """Share of the smallest anchors of both that occur in both in the same order (0 to 1)."""
    return _likeness(decode(a), decode(b))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket, own rows before borrowed ones, following document next."""
    tool, held, out = Syncmers(), None, []

    def finish(row, following):
        _, doc_id, text, mine = row
        edited = _edited(text, following[2])
        other = tool.anchors(edited)
        x, y = (dict(zip(a[0].tolist(), a[1].tolist())) for a in (mine, other))
        z = dict(zip(following[3][0].tolist(), following[3][1].tolist()))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), encode(mine),
                    encode(other), _likeness(x, y), _likeness(x, z)))

    def flush():
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                           names=[f.split()[0] for f in OUT.split(", ")])
        out.clear()
        return batch

    for batch in batches:
        for bucket, borrowed, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            row = (bucket, doc_id, text, tool.anchors(text))
            if held is not None:
                finish(held, row)
            # A bucket's first borrowed row follows its last own row; then nothing is open.
            held = None if borrowed else row
        yield flush()


def fingerprint_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited form, in which the following document replaces the last third.

    Documents follow each other by descending doc_id (equal ids by text, null ids last), and
    the first follows the last. A null text is empty; two empty texts are alike (1), an empty and
    another text are not (0). Texts are dealt once by ranges of ids. A bucket borrows the first
    document of the bucket below it, so no step sees the order of all rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("cuts")).first().cuts
    cuts = sorted(set(cuts or []))
    edges = np.array(cuts, np.int64)

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, ids.to_numpy(), "right"), pa.int32())

    # A null id counts as the lowest: null ids come last.
    lowest = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = rows.withColumn("bucket", bucket_of(lowest))
    # One row per bucket: the id its first document has, and the bucket that borrows it.
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    above, all_buckets = Window.orderBy("bucket"), Window.partitionBy()
    tops = tops.select("bucket", "top", F.coalesce(F.lead("bucket").over(above), F.min("bucket").over(all_buckets))
                       .alias("borrower"))
    lent = rows.join(F.broadcast(tops), "bucket").where(F.col("doc_id").eqNullSafe(F.col("top")))
    lent = lent.groupBy("borrower").agg(F.max(F.struct("doc_id", F.col("text"))).alias("r"))
    lent = lent.select(F.col("borrower").alias("bucket"), F.lit(True).alias("borrowed"), "r.doc_id", "r.text")
    both = rows.select("bucket", F.lit(False).alias("borrowed"), "doc_id", "text").unionByName(lent)
    dealt = both.repartition("bucket").sortWithinPartitions(
        "bucket", "borrowed", F.col("doc_id").desc_nulls_last(), F.desc("text"))
    return dealt.mapInArrow(_compare, OUT)
