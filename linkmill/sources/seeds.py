"""Seed URLs: bounded batches from a list, a set or a scored set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.operators.ordered import PARTIAL_LIMIT, first_rows, first_rows_per_slice

# Largest batch whose keys are sent to every executor.
BROADCAST_ROWS = 100_000


def _take(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """First `n` rows of the whole table."""
    whole = df.withColumn("_all", F.lit(0))
    if n < PARTIAL_LIMIT:
        return first_rows_per_slice(whole, n, ["_all"], order).drop("_all").orderBy(*order).limit(n)
    return first_rows(whole, n, ["_all"], order).drop("_all")


def take_seeds(df: DataFrame, n: int, mode: str = "list", seed: int = 0, seq: str = "seq", member: str = "member",
               score: str = "score") -> tuple[DataFrame, DataFrame]:
    """`(batch, rest)` of the waiting seeds.

    `list` takes the oldest rows, `scored` the members with the highest score
    (the last score of a member counts), `set` distinct members in a seeded
    random order.
    """
    if mode == "list":
        batch, key, waiting = _take(df, n, [F.col(seq).asc()]), seq, df
    elif mode == "scored":
        waiting, key = df.groupBy(member).agg(F.max_by(score, seq).alias(score)), member
        batch = _take(waiting, n, [F.col(score).desc(), F.col(member).desc()])
    elif mode == "set":
        waiting, key = df.select(member).distinct(), member
        batch = _take(waiting, n, [F.md5(F.concat(F.col(member), F.lit(f"|{seed}"))).asc(), F.col(member).asc()])
    else:
        raise ValueError(f"unknown mode: {mode!r}")
    taken = batch.select(F.col(key).alias("_taken"))
    # Null-safe, so that batch and rest are complements for a seed without a number or member too.
    return batch, waiting.join(F.broadcast(taken) if n <= BROADCAST_ROWS else taken,
                               F.col(key).eqNullSafe(F.col("_taken")), "left_anti")


def decode_seeds(df: DataFrame, encoding: str = "UTF-8", data: str = "data") -> DataFrame:
    """Messages to URLs; empty ones are skipped. Seeds bypass de-duplication."""
    url = F.decode(F.col(data), encoding)
    return (df.withColumn("url", url).filter(F.col("url") != "").drop(data)
            .withColumn("dont_filter", F.lit(True)))


def parse_seed_json(df: DataFrame, message: str = "message") -> DataFrame:
    """Messages `[url, priority, callback]` to requests; unreadable ones are dropped."""
    parts = F.from_json(F.col(message), "array<string>")
    return (
        df.withColumn("_parts", parts).drop(message)
        .withColumns({
            "url": F.get("_parts", 0),
            "priority": F.coalesce(F.get("_parts", 1).try_cast("int"), F.lit(0)),
            "callback": F.get("_parts", 2),
            "dont_filter": F.lit(False),
        })
        .filter(F.coalesce(F.col("url"), F.lit("")) != "").drop("_parts")
    )
