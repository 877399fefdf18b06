"""Batches, lengths and fetch times of the frontier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions.urls import url_host
from linkmill.operators.ordered import TASK_ROWS, first_rows, ordered_rank

# Largest number of keys that is sent to every executor.
BROADCAST_ROWS = 1_000_000


def batch_order(order: str = "priority", seq: str = "seq", priority: str = "priority") -> list[Column]:
    """Sort columns of a named order: oldest first, newest first, or most urgent first."""
    return {
        "fifo": [F.col(seq).asc()],
        "lifo": [F.col(seq).desc()],
        "priority": [F.col(priority).desc(), F.col(seq).asc()],
    }[order]


def select_batch(frontier: DataFrame, n: int, order: str = "priority", spider: str = "spider",
                 seq: str = "seq", task_rows: int = TASK_ROWS, broadcast_rows: int = BROADCAST_ROWS
                 ) -> tuple[DataFrame, DataFrame]:
    """`(batch, rest)`: the next `n` requests of each spider and what stays.

    Spiders are counted first: while a batch of all of them is small, the rest is
    found without moving the frontier.
    """
    batch = first_rows(frontier, n, [spider], batch_order(order, seq), task_rows=task_rows)
    taken = batch.select(F.col(spider).alias("_spider"), F.col(seq).alias("_seq"))
    if n * frontier.select(spider).distinct().count() <= broadcast_rows:
        taken = F.broadcast(taken)
    same = F.col(spider).eqNullSafe(F.col("_spider")) & F.col(seq).eqNullSafe(F.col("_seq"))
    return batch, frontier.join(taken, same, "left_anti")


def pending_count(frontier: DataFrame, spider: str = "spider") -> DataFrame:
    """`spider, pending`: the length of every queue."""
    return frontier.groupBy(spider).agg(F.count("*").alias("pending"))


def has_pending(frontier: DataFrame) -> bool:
    return not frontier.isEmpty()


def plan_fetch(frontier: DataFrame, delay_seconds: int, start: Column, url: str = "url",
               order: Sequence[Column] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add `host` and `fetch_at`: one request per host and delay, most urgent first."""
    order = batch_order("priority") if order is None else order
    ranked = ordered_rank(frontier.withColumn("host", url_host(url)), ["host"], order, "_rank", task_rows)
    wait = (F.col("_rank") - 1) * F.lit(delay_seconds * 1_000_000)
    at = F.timestamp_micros(F.unix_micros(start) + wait)
    return ranked.withColumn("fetch_at", at).drop("_rank")
