"""Page tables, in batch and as a stream."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from linkmill import schemas

# Rows that one task writes and parses as pages; at least, while there are idle cores, and at most.
TASK_PAGES = (1_000, 20_000)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: `page_id, url, html`. The schema is given, so nothing is inferred."""
    return spark.read.schema(schemas.PAGE).parquet(path)


def spread(rows: DataFrame, task_pages: tuple[int, int] = TASK_PAGES) -> DataFrame:
    """The narrow rows that pages are written from, dealt evenly over tasks.

    A file of a few megabytes is read by one task, and yet holds rows for hours of parsing. The rows are
    dealt before they become pages, so the page text still never moves. Their number is
    read from the footers of the files.
    """
    least, most = task_pages
    n = rows.count()
    idle = 2 * rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(math.ceil(n / least), idle), math.ceil(n / most))
    return rows.repartition(tasks) if tasks > 1 else rows


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same as an endless stream of bounded pulls."""
    return spark.readStream.schema(schemas.PAGE).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_seeds(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """Seed messages `seq, data, score` as an endless stream of bounded pulls."""
    return spark.readStream.schema(schemas.SEED).option("maxFilesPerTrigger", max_files).parquet(path)
