"""Counters and carried values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.operators.ordered import TASK_ROWS, ordered_last


def crawl_stats(df: DataFrame, spider: str = "spider", outcome: str = "outcome") -> DataFrame:
    """`spider, outcome, n`: how often each outcome occurred."""
    return df.groupBy(spider, outcome).agg(F.count("*").alias("n"))


def carry_forward(df: DataFrame, col: str, order: Sequence[str], partition: Sequence[str], name: str | None = None,
                  task_rows: int = TASK_ROWS) -> DataFrame:
    """Replace a null by the most recent value before it, within a partition."""
    out = ordered_last(df, col, partition, [F.col(c) for c in order], "_carried", task_rows)
    if name is None or name == col:
        return out.withColumn(col, F.col("_carried")).drop("_carried")
    return out.withColumnRenamed("_carried", name)
