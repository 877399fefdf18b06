"""Insert or update by key.

For a new key the first row is inserted and later rows change only the update
columns. For a known key everything but the update columns stays, nulls included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_changes(rows: DataFrame, key: str, update_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: update columns of the last row, all others of the first.

    Aggregated before the shuffle, so a key with very many changes is no hot spot.
    """
    kept = [c for c in rows.columns if c == key or c not in order]
    at = F.struct(*order)
    first = [c for c in kept if c not in update_cols]
    picks = [F.min_by(F.struct(*first), at).alias("_first")]
    if update_cols:
        picks.append(F.max_by(F.struct(*update_cols), at).alias("_last"))
    folded = rows.groupBy(key).agg(*picks)
    return folded.select(*[F.col(f"_last.{c}" if c in update_cols else f"_first.{c}").alias(c) for c in kept])


def upsert(target: DataFrame, batch: DataFrame, key: str, update_cols: Sequence[str], seq: str = "seq") -> DataFrame:
    """The target after the batch. Presence of the key decides, never a null value."""
    change = fold_changes(batch, key, update_cols, [seq])
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = change.withColumn("_new", F.lit(True)).alias("b")
    joined = old.join(new, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    columns = []
    for c in target.columns:
        if c == key:
            value = F.coalesce(f"t.{c}", f"b.{c}")
        elif c in update_cols:
            value = F.when(F.col("_new"), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            value = F.when(F.col("_old"), F.col(f"t.{c}")).otherwise(F.col(f"b.{c}"))
        columns.append(value.alias(c))
    return joined.select(*columns)


def append_changes(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to the change log; a repeated batch replaces its own folder.

    The cost is that of the batch, whatever the size of the table behind it.
    """
    (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_current(spark: SparkSession, path: str, schema: T.StructType, key: str, update_cols: Sequence[str],
                 seq: str = "seq", base: DataFrame | None = None) -> DataFrame:
    """The table that the change log describes, on top of an optional base."""
    logged = T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())])
    changes = spark.read.schema(logged).parquet(path)
    if base is None:
        return fold_changes(changes, key, update_cols, ["batch_id", seq])
    at = F.struct("batch_id", seq)
    ordered = changes.withColumn("_at", at).drop("batch_id", seq)
    return upsert(base, ordered, key, update_cols, "_at")
