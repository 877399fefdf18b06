"""A seen-set far larger than a batch, stored in buckets of its key.

Bucketed files are read as if they had been shuffled by the key. So admission shuffles the
batch to the buckets, and the seen-set is never moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

KEY = "_key_text"


def key_text(key: Sequence[str]) -> Column:
    """The whole key as one text, different for different keys: nulls are left out of the JSON."""
    *scope, last = key
    return F.concat(F.col(last).cast("string"), F.lit("|"), F.to_json(F.struct(*scope)) if scope else F.lit(""))


def write_bucketed_seen(seen: DataFrame, name: str, path: str, key: Sequence[str] = ("spider", "fp"),
                        buckets: int = 200) -> None:
    """Store keys as the table `name` in `path`, one sorted file per bucket."""
    rows = seen.select(*key, key_text(key).alias(KEY)).repartition(buckets, KEY)
    (rows.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path)
     .saveAsTable(name))


def append_bucketed_seen(new_seen: DataFrame, name: str, key: Sequence[str] = ("spider", "fp")) -> None:
    """Add keys; every bucket gets one more file, the others stay as they are."""
    spark = new_seen.sparkSession
    rows = new_seen.select(*key, key_text(key).alias(KEY)).repartition(bucket_count(spark, name), KEY)
    rows.write.mode("append").format("parquet").bucketBy(bucket_count(spark, name), KEY).sortBy(KEY).saveAsTable(name)


def open_bucketed_seen(spark: SparkSession, name: str, path: str, kinds: str, buckets: int) -> DataFrame:
    """Make a stored set known to a new session. `kinds` are the key columns as DDL."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({kinds}, {KEY} string) USING parquet "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def admit_bucketed(requests: DataFrame, name: str, key: Sequence[str] = ("spider", "fp"), seq: str = "seq",
                   dont_filter: str | None = "dont_filter") -> tuple[DataFrame, DataFrame]:
    """`admit` against a bucketed set. The batch is shuffled once if the session has as many partitions as buckets.

    With another number of partitions the first arrivals, not the seen-set, move once more.
    """
    spark = requests.sparkSession
    buckets = bucket_count(spark, name)
    passes = F.lit(False) if dont_filter is None else F.coalesce(F.col(dont_filter), F.lit(False))
    # A request that always passes has a key of its own, which no stored one equals.
    own = F.when(passes, F.concat(F.lit("!"), F.col(seq).cast("string"))).otherwise(key_text(key))
    keyed = requests.withColumn(KEY, own).where(F.col(KEY).isNotNull())
    # The limit on the rank is applied before the shuffle, so a frequent key sends one row per task.
    rank = F.row_number().over(W.partitionBy(KEY).orderBy(seq))
    fresh = keyed.withColumn("_rank", rank).where(F.col("_rank") == 1)
    held = F.col("_rank") == 1
    if buckets != int(spark.conf.get("spark.sql.shuffle.partitions")):
        fresh = fresh.repartition(buckets, KEY).withColumn("_held", F.monotonically_increasing_id())
        held &= F.col("_held") >= 0
    # Always true: it holds the join above the limit and the shuffle, which Spark would else move it below.
    old = spark.table(name).select(F.col(KEY).alias("_old"))
    admitted = fresh.join(old, (F.col(KEY) == F.col("_old")) & held, "left_anti")
    return admitted.select(*requests.columns), admitted.where(~passes).select(*key)
