"""Helpers that the operators share: staged tables, words of whole batches, ordered numbering."""

from __future__ import annotations

import re
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18
# Random but fixed numbers of the hash functions.
_RNG = np.random.default_rng(77)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(1 << 40, 1 << 62)) | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
SHIFTS = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; one of our own only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="linkmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_open: list[list[Staged]] = []


@contextmanager
def staged_here() -> Iterator[list[Staged]]:
    """All tables that are staged meanwhile, by whatever operator, for one who knows when they are done with."""
    tables: list[Staged] = []
    _open.append(tables)
    try:
        yield tables
    finally:
        _open.remove(tables)


class Staged:
    """A table written once to the shared folder; `drop()` deletes it when nothing reads it any more."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        for tables in _open:
            tables.append(self)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    return Staged(df, name).df


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: int, kept: dict) -> np.ndarray:
    if base not in kept or len(kept[base]) < n:
        p = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        p[0] = 1
        kept[base] = np.multiply.accumulate(p)
    return kept[base][:n]


def hash_words(data: np.ndarray, bounds: np.ndarray, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in `data` (bytes of several texts), and where each text's words begin."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    space = _SPACE[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = space[:-1]
    first[bounds[bounds < n]] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = first[1:]
    last[:-1] |= space[1:]
    starts = np.flatnonzero(first & ~space)
    ends = np.flatnonzero(last & ~space) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(n, _BASE, kept), out=total[1:])
    hashes = (total[ends] - total[starts]) * _powers(n, _UNBASE, kept)[starts]
    return mix(hashes), np.searchsorted(starts, bounds)


def _hash_long(data: np.ndarray, kept: dict) -> np.ndarray:
    """Word hashes of one long text, piece by piece, cut between words."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data) and not _SPACE[data[end]]:
            gaps = np.flatnonzero(_SPACE[data[end:end + CHUNK_BYTES]])
            end = end + int(gaps[0]) if len(gaps) else min(len(data), end + CHUNK_BYTES)
        piece = data[at:end]
        out.append(hash_words(piece, np.array([0, len(piece)]), kept)[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow array and their bounds; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), bounds


def hashed_texts(texts: pa.Array, kept: dict, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, word hashes, bounds of each row's words) for slices of about `CHUNK_BYTES`."""
    data, bounds = text_bytes(texts)
    row, n = 0, len(texts)
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        part = data[bounds[row]:bounds[end]]
        if lower:
            part = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part)
        if end == row + 1 and len(part) > CHUNK_BYTES:
            hashes = _hash_long(part, kept)
            yield row, hashes, np.array([0, len(hashes)])
        else:
            yield (row, *hash_words(part, bounds[row:end + 1] - bounds[row], kept))
        row = end


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += hashes[j:j + n] * SHIFTS[j]
    return mix(out)


def run_bounds(sizes: np.ndarray) -> np.ndarray:
    """Where runs of the given sizes begin, and the end of the last."""
    return np.concatenate(([0], np.cumsum(sizes)))


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at `starts`, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column, or nulls of that type where the table has none."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def process_cache(name: str) -> dict:
    """A dict that tasks of one worker process share, whatever way their code came there."""
    home = sys.modules.setdefault("_linkmill_worker", types.ModuleType("_linkmill_worker"))
    return home.__dict__.setdefault(name, {})
