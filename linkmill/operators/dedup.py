"""Admission of new requests and the sets that remember the old ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from linkmill.functions.urls import request_fingerprint
from linkmill.operators.bloom import BloomSize, bloom_build, bloom_maybe_contains
from linkmill.plans.staging import stage


def fingerprint(df: DataFrame, url: str = "url", method: str | None = None, body: str | None = None,
                options_col: str | None = None, name: str = "fp") -> DataFrame:
    """Add the fingerprint of the request described by the named columns."""
    return df.withColumn(name, request_fingerprint(url, method, body, options_col))


def admission_key(key: str, dont_filter: str | None, seq: str) -> Column:
    """The key a request is compared by: its own one for each request that always passes.

    So such requests go through the same shuffle as the others, match nothing, and
    the requests are computed only once.
    """
    if dont_filter is None:
        return F.col(key)
    own = F.concat(F.lit("!"), F.col(seq).cast("string"))
    return F.when(F.coalesce(F.col(dont_filter), F.lit(False)), own).otherwise(F.col(key))


def admit(requests: DataFrame, seen: DataFrame | None = None, key: Sequence[str] = ("fp",), seq: str = "seq",
          dont_filter: str | None = "dont_filter", dedup: str = "exact",
          capacity: int = 10_000_000, fpp: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """`(admitted, new_seen)`: requests whose key is new, the first arrival of each.

    `seq` is unique. Requests with `dont_filter` always pass and leave no trace in
    the seen-set. The rank limit is applied before the shuffle, so a key held by a
    third of all rows sends one row per task, and the join with the seen-set uses
    the partitioning of that shuffle. `dedup="bloom+exact"` is for a seen-set much
    larger than the requests: a Bloom filter of the requests, sized for `capacity`
    of them, drops the seen keys that cannot match before they are shuffled. The
    exact comparison follows, so the result does not depend on the filter. A request
    without a key (a null URL) is not admitted: it can neither be fetched nor compared.
    """
    *scope, last = key
    compared = [*scope, "_key"]
    keyed = requests.withColumn("_key", admission_key(last, dont_filter, seq)).filter(F.col("_key").isNotNull())
    if seen is not None and dedup == "bloom+exact":
        keyed = stage(keyed, "requests")  # read twice: for the filter and for the comparison
    rank = F.row_number().over(W.partitionBy(*compared).orderBy(seq))
    fresh = keyed.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    if seen is not None:
        if dedup == "bloom+exact":
            size = BloomSize.of(capacity, fpp)
            bloom = bloom_build(keyed, "_key", size)
            seen = bloom_maybe_contains(seen, bloom, last, size, "_maybe").filter("_maybe").drop("_maybe")
        elif dedup != "exact":
            raise ValueError(f"unknown dedup method: {dedup!r}")
        old = seen.select(*(F.col(c).alias(f"_old_{c}") for c in scope), F.col(last).alias("_old"))
        same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in scope]
        fresh = fresh.join(old, [*same, F.col("_key") == F.col("_old")], "left_anti")
    new_seen = fresh if dont_filter is None else fresh.filter(~F.coalesce(F.col(dont_filter), F.lit(False)))
    return fresh.select(*requests.columns), new_seen.select(*key)


def merge_seen(seen: DataFrame, new_seen: DataFrame) -> DataFrame:
    """The set of all keys of both sides."""
    return seen.unionByName(new_seen).distinct()


def append_seen(new_seen: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch of new keys to the stored set, one folder per batch and spider.

    Admission makes new keys disjoint from the stored ones, so only the new ones
    are written. A repeated batch replaces its own rows.
    """
    (new_seen.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "spider").parquet(path))


def reset_seen(seen: DataFrame, spider: str) -> DataFrame:
    """The set without the keys of one spider; with a partitioned table only its folder is skipped."""
    return seen.filter(~F.col("spider").eqNullSafe(F.lit(spider)))


def merge_pending(frontier: DataFrame, new: DataFrame, key: Sequence[str] = ("spider", "request_key"),
                  seq: str = "seq", priority: str = "priority") -> DataFrame:
    """Sorted-set push: every member once, the last priority wins, the first arrival is kept with all its columns.

    A column that one side lacks is null there. Rows are folded before the shuffle, so a
    member that was pushed very often sends one row per task.
    """
    rows = frontier.unionByName(new, allowMissingColumns=True)
    others = [c for c in rows.columns if c not in (*key, seq, priority)]
    folded = [F.max_by(priority, seq).alias(priority), F.min(seq).alias(seq)]
    if others:
        folded.append(F.min_by(F.struct(*others), seq).alias("_first"))
    merged = rows.groupBy(*key).agg(*folded)
    return merged.select(*(F.col(f"_first.{c}").alias(c) if c in others else F.col(c) for c in rows.columns))
