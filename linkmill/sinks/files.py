"""JSON lines, keyed item feeds, endpoint tables and fan-out to several sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill import schemas

# How dates are written in a serialized item.
ITEM_FORMATS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd"}


def write_json(df: DataFrame, path: str) -> None:
    """One UTF-8 JSON object per line; an earlier file is replaced."""
    df.write.mode("overwrite").json(path)


def item_json(item: Column) -> Column:
    return F.to_json(item, ITEM_FORMATS)


def to_item_feed(df: DataFrame, spider: str | Column, serializer: Callable[[Column], Column] = item_json) -> DataFrame:
    """`key, value`: every record serialized under the feed of its spider."""
    name = F.lit(spider) if isinstance(spider, str) else spider
    return df.select(F.concat(name, F.lit(":items")).alias("key"), serializer(F.struct(*df.columns)).alias("value"))


def write_item_feed(feed: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append to the feeds; with a batch number a repeated batch replaces itself.

    Every task writes its own file per feed, so one large feed is no bottleneck.
    """
    if batch_id is None:
        feed.write.mode("append").partitionBy("key").parquet(path)
    else:
        (feed.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "key").parquet(path))


def endpoint_rows(df: DataFrame) -> DataFrame:
    """Endpoint records as they are stored: the type is always HTTP."""
    return df.withColumn("proxy_type", F.lit("HTTP")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ENDPOINT.fields])


def append_endpoints(df: DataFrame, path: str) -> None:
    endpoint_rows(df).write.mode("append").parquet(path)


def write_all(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Give the same rows to every sink in turn; they are computed once and kept meanwhile."""
    rows = df.persist()
    try:
        for sink in sinks:
            sink(rows)
    finally:
        rows.unpersist()
