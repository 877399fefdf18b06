"""Continuous admission of requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkmill.operators.dedup import admission_key, admit, append_seen
from linkmill.streaming.counters import RowCount, write_counts

SEEN_TABLE = T.StructType([
    T.StructField("fp", T.StringType()),
    T.StructField("batch_id", T.IntegerType()),
    T.StructField("spider", T.StringType()),
])


def stream_admit(requests: DataFrame, key: Sequence[str] = ("spider", "fp"), seq: str = "seq",
                 dont_filter: str | None = "dont_filter", event_time: str | None = None,
                 within: str | None = None) -> DataFrame:
    """Requests whose key the stream has not seen; the state grows with the keys.

    With `event_time` and `within` only repeats inside that span are recognised and
    the state stays bounded. Use a RocksDB state store for large sets, or
    `admit_batches`, which keeps the set in a table. Which of several equal requests
    of one micro-batch passes is open here; `admit_batches` takes the first.
    """
    *scope, last = key
    keyed = requests.withColumn("_key", admission_key(last, dont_filter, seq))
    if event_time is not None and within is not None:
        fresh = keyed.withWatermark(event_time, within).dropDuplicatesWithinWatermark([*scope, "_key"])
    else:
        fresh = keyed.dropDuplicates([*scope, "_key"])
    return fresh.select(*requests.columns)


def create_seen(spark: SparkSession, path: str) -> None:
    """Make the folder of a seen-set; one that is there keeps its rows."""
    empty = spark.createDataFrame([], SEEN_TABLE)
    empty.write.mode("append").partitionBy("batch_id", "spider").parquet(path)


def read_seen(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """The stored seen-set, as it was before the given batch."""
    seen = spark.read.schema(SEEN_TABLE).parquet(path)
    if before_batch is not None:
        seen = seen.filter(F.col("batch_id") < before_batch)
    return seen.select("spider", "fp")


def admit_batches(requests: DataFrame, seen_path: str, out_path: str, checkpoint: str, seq: str = "seq",
                  trigger: dict | None = None, after: Callable[[DataFrame, int], dict[str, int] | None] | None = None,
                  counts_path: str | None = None, **options) -> StreamingQuery:
    """Admit every micro-batch against a stored seen-set; the first arrival wins.

    A micro-batch only sees keys of earlier ones and overwrites its own folders, so
    repeating it after a failure gives the same tables. A restart goes on with the
    same seen-set. Further options, such as `dedup`, go to `admit`.

    With `counts_path` the requests that were enqueued and those that were filtered are
    counted as they pass, and so is what `after` returns as numbers, such as the requests it
    dequeued (`counters.read_counts`).
    """
    create_seen(requests.sparkSession, seen_path)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        asked = RowCount(batch) if counts_path else None
        admitted, new_seen = admit(asked.df if asked else batch, read_seen(spark, seen_path, batch_id), ("spider", "fp"), seq,
                                   **options)
        passed = RowCount(admitted) if counts_path else None
        ((passed.df if passed else admitted).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))
        # The new keys are read back from what was just written, not computed again.
        written = spark.read.schema(_with_batch(admitted)).parquet(out_path).filter(F.col("batch_id") == batch_id)
        append_seen(written.filter(~F.coalesce("dont_filter", F.lit(False))).select("spider", "fp"), seen_path,
                    batch_id)
        more = after(written.drop("batch_id"), batch_id) if after is not None else None
        if asked and passed:
            counts = {"enqueued": passed.n, "filtered": asked.n - passed.n} | (more or {})
            write_counts(spark, counts, counts_path, batch_id)

    return (requests.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _with_batch(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("batch_id", T.IntegerType())])
