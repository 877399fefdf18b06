"""Ranks and carried values within groups of any size.

A window function brings each group into one task. That is fine until a group
outgrows a task, so the size of the largest group is measured first. Beyond the
limit the rows are range-partitioned by group and order, which spreads one group
over many tasks; each task works on its own slice, and what has to pass from
slice to slice is one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from linkmill.plans.staging import stage

# Rows of one group that one task sorts without trouble.
TASK_ROWS = 2_000_000
# Below this a rank limit is applied by Spark before the shuffle.
PARTIAL_LIMIT = 1000
# Groups of input partitions whose first rows are collected separately.
SLICES = 256


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group; counted before the shuffle, one number comes back."""
    sizes = df.groupBy(*group).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def _slices(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows sorted within range partitions, with the partition number `_part`."""
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order)
    return ranged.sortWithinPartitions(*[F.col(g) for g in group], *order).withColumn(
        "_part", F.spark_partition_id())


def _new_group(batch: pa.RecordBatch, group: Sequence[str], previous) -> tuple[np.ndarray, tuple]:
    """Where a group starts in a sorted batch, and the key of the last row."""
    n = batch.num_rows
    starts = np.zeros(n, dtype=bool)
    columns = [batch.column(batch.schema.get_field_index(g)) for g in group]
    starts[0] = previous != tuple(c[0].as_py() for c in columns)
    for c in columns:
        here, before = c.slice(1), c.slice(0, n - 1)
        same = pc.fill_null(pc.equal(here, before), False)
        both_null = pc.and_(pc.is_null(here), pc.is_null(before))
        starts[1:] |= ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
    return starts, tuple(c[n - 1].as_py() for c in columns)


def _rank_slices(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add `_local`: the position of a row in its group, counted within its partition."""
    def number(batches):
        previous, count = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts, last = _new_group(batch, group, previous)
            at = np.arange(1, batch.num_rows + 1)
            begin = np.maximum.accumulate(np.where(starts, at, 0))
            local = np.where(begin > 0, at - begin + 1, at + count)
            previous, count = last, int(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())],
                                             names=[*batch.schema.names, "_local"])

    sliced = _slices(df, group, order)
    return sliced.mapInArrow(number, T.StructType([*sliced.schema.fields, T.StructField("_local", T.LongType())]))


def _join_earlier_slices(staged: DataFrame, group: Sequence[str], carried: Column, combine) -> DataFrame:
    """Add `_carry`: what a row's group brings from earlier partitions, else null.

    Only the first group of a partition can have begun in an earlier one, where it
    was the last group. So two rows per partition tell everything, and the
    broadcast has one row per partition, however many rows there are.
    """
    key = F.struct(*group)
    ends = staged.groupBy("_part").agg(
        F.min(key).alias("_first"),
        F.max_by(F.struct(key.alias("key"), carried.alias("value")), F.struct(key, "_local")).alias("_end"))
    gives = ends.select("_part", F.col("_end.key").alias("_key"), F.col("_end.value").alias("_value"),
                        F.lit(False).alias("_asks"))
    asks = ends.select("_part", F.col("_first").alias("_key"), F.lit(None).alias("_value"),
                       F.lit(True).alias("_asks"))
    before = W.partitionBy("_key").orderBy("_part").rangeBetween(W.unboundedPreceding, -1)
    carry = gives.unionByName(asks).withColumn("_brought", combine("_value").over(before)).filter("_asks")
    joined = staged.join(F.broadcast(carry.select("_part", "_key", "_brought")), "_part")
    return joined.withColumn("_carry", F.when(key.eqNullSafe(F.col("_key")), F.col("_brought")))


def ordered_rank(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank",
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """`row_number` over `group` and `order`, for groups of any size.

    `order` must be unique within a group, or the ranks of equal rows may swap.
    """
    if largest_group(df, group) <= task_rows:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("bigint"))
    staged = stage(_rank_slices(df, group, order), "rank")
    joined = _join_earlier_slices(staged, group, F.col("_local"), F.sum)
    return joined.withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0))).select(*df.columns, name)


def ordered_last(df: DataFrame, value: str, group: Sequence[str], order: Sequence[Column], name: str,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """The most recent non-null `value` up to each row of its group, for groups of any size."""
    if largest_group(df, group) <= task_rows:
        frame = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(frame))

    def fill(batches):
        previous, held = None, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            starts, last = _new_group(batch, group, previous)
            column = batch.column(batch.schema.get_field_index(value))
            held = held if not starts[0] else None
            # Index into [held, *column]; a group start takes its own row, null or not.
            source = pa.concat_arrays([pa.array([held], column.type), column])
            known = starts | ~pc.is_null(column).to_numpy(zero_copy_only=False)
            at = np.maximum.accumulate(np.where(known, np.arange(1, n + 1), 0))
            filled = source.take(pa.array(at))
            previous, held = last, filled[n - 1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, filled], names=[*batch.schema.names, "_filled"])

    ranked = _rank_slices(df, group, order)
    kind = df.schema[value].dataType
    staged = stage(ranked.mapInArrow(fill, T.StructType([*ranked.schema.fields, T.StructField("_filled", kind)])),
                   "carry")
    joined = _join_earlier_slices(staged, group, F.col("_filled"), lambda v: F.last(v, ignorenulls=True))
    return joined.withColumn(name, F.coalesce("_filled", "_carry")).select(*df.columns, name)


def _limit(df: DataFrame, n: int, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_rows_per_slice(df: DataFrame, n: int, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """At most `n` rows per group and slice, among them the first `n` of each group.

    A slice is a set of input partitions. Each task sends at most `n` rows of a
    group to the slice it belongs to, so no task receives those of all others.
    """
    sliced = df.withColumn("_slice", F.spark_partition_id() % SLICES)
    return _limit(sliced, n, [*group, "_slice"], order).drop("_slice")


def first_rows(df: DataFrame, n: int, group: Sequence[str], order: Sequence[Column],
               partial_limit: int = PARTIAL_LIMIT, task_rows: int = TASK_ROWS) -> DataFrame:
    """The first `n` rows of each group, whatever its size.

    Up to the limit at which Spark prunes ranks before the shuffle this is done in
    two steps over slices. Larger batches are ranked instead.
    """
    if n < partial_limit:
        return _limit(first_rows_per_slice(df, n, group, order), n, group, order)
    return ordered_rank(df, group, order, "_rank", task_rows).filter(F.col("_rank") <= n).drop("_rank")
