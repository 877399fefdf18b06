"""Blocked Bloom filter as a table.

A key falls into one block of eight 64-bit words and sets one bit in each, so
building is one aggregation with map-side combine and probing is one equi-join
with one row per block. Published design: Putze, Sanders and Singler,
"Cache-, hash- and space-efficient Bloom filters".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS = 64
# Largest filter that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def _false_positive_rate(keys_per_block: float) -> float:
    """Expected rate when the keys of a block follow a Poisson distribution."""
    spread = 8 * math.sqrt(keys_per_block) + 8
    total = 0.0
    for n in range(max(0, int(keys_per_block - spread)), int(keys_per_block + spread) + 1):
        weight = math.exp(n * math.log(keys_per_block) - keys_per_block - math.lgamma(n + 1))
        total += weight * (1 - (1 - 1 / BITS) ** n) ** WORDS
    return total


@dataclass(frozen=True)
class BloomSize:
    """Number of blocks for a capacity and an allowed rate of false positives."""

    blocks: int

    @staticmethod
    def of(capacity: int, fpp: float) -> "BloomSize":
        low, high = 1e-3, float(BITS * WORDS)
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if _false_positive_rate(middle) <= fpp else (low, middle)
        return BloomSize(max(1, math.ceil(capacity / low)))

    @property
    def bytes(self) -> int:
        return self.blocks * (WORDS + 1) * 8


def _block(key: Column, size: BloomSize) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint") % F.lit(size.blocks)


def _mask(key: Column, word: int) -> Column:
    digits = F.substring(F.md5(key), 17 + 2 * word, 2)
    bit = F.conv(digits, 16, 10).cast("int").bitwiseAND(BITS - 1)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom_build(df: DataFrame, col: str, size: BloomSize) -> DataFrame:
    """`block, w0 .. w7` of the keys in `col`. Filters of one size merge with `bloom_merge`."""
    key = F.col(col)
    rows = df.filter(key.isNotNull()).select(
        _block(key, size).alias("block"), *[_mask(key, i).alias(f"w{i}") for i in range(WORDS)])
    return bloom_merge(rows)


def bloom_merge(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def bloom_maybe_contains(df: DataFrame, bloom: DataFrame, col: str, size: BloomSize,
                         name: str = "maybe_seen") -> DataFrame:
    """Add a flag: false means the key was never added.

    A filter within the broadcast limit goes to the rows; a larger one is joined
    by block, which the hash spreads evenly.
    """
    key = F.col(col)
    words = bloom.select(F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(WORDS)])
    if size.bytes <= BROADCAST_BYTES:
        words = F.broadcast(words)
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(_mask(key, i)) != 0)
    probed = df.withColumn("_block", _block(key, size)).join(words, "_block", "left")
    return probed.withColumn(name, F.coalesce(hit, F.lit(False))).select(*df.columns, name)
