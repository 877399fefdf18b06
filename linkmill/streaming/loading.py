"""Continuous loading of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkmill.operators.quality import split_valid
from linkmill.sinks.files import to_item_feed, write_all, write_item_feed
from linkmill.sinks.upsert import append_changes


def observed(df: DataFrame, name: str) -> DataFrame:
    """Count the rows passing by; the number appears in the progress of the query."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def stream_load(records: DataFrame, spider: str, required: Sequence[str], feed_path: str, changes_path: str,
                rejects_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Send complete records to the feed and then to the change log; keep the others apart.

    Every sink writes the folder of its micro-batch, so a repeated batch changes
    nothing. `upsert.read_current` gives the loaded table.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        def good(rows: DataFrame) -> DataFrame:
            return split_valid(rows, required)[0]

        def keep_rejects(rows: DataFrame) -> None:
            (split_valid(rows, required)[1].withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejects_path))

        write_all(batch, [
            lambda rows: write_item_feed(to_item_feed(good(rows), spider), feed_path, batch_id),
            lambda rows: append_changes(good(rows), changes_path, batch_id),
            keep_rejects,
        ])

    return (observed(records, "records").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
