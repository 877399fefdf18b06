"""Counters of a stream: what became of the requests of each micro-batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = T.StructType([T.StructField("outcome", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("batch_id", T.IntegerType())])


class RowCount:
    """Counts the rows of a frame while some action computes it, without another pass."""

    def __init__(self, df: DataFrame):
        self._seen = Observation()
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("n"))

    @property
    def n(self) -> int:
        """The number; only after the action."""
        return self._seen.get["n"]


def write_counts(spark: SparkSession, counts: Mapping[str, int], path: str, batch_id: int) -> None:
    """Store the counters of a micro-batch; a repeated one replaces its own."""
    rows = spark.createDataFrame([(k, v, batch_id) for k, v in counts.items()], COUNTS).coalesce(1)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """`batch_id, outcome, n` of all micro-batches."""
    return spark.read.schema(COUNTS).parquet(path).select("batch_id", "outcome", "n")
