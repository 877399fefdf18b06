"""Tables written between two steps of a job.

A staged table cuts lineage: it lives in the shared folder of the cluster, so it
survives the loss of executors, and every reader sees the same rows.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """The shared folder named in `spark.checkpoint.dir`; on a single machine a local one where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="linkmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and return the written table."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
