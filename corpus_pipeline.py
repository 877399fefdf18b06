"""From documents to packed training sequences, stage by stage.

Each stage reads what the one before it wrote. All but the last return the columns of
`documents`; other columns of the input come along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import Staged, staged_here
from linkmill.llm.mixing import mix_documents
from linkmill.llm.near_text import near_duplicates
from linkmill.llm.packing import pack_documents
from linkmill.llm.queries import tokenizer_path
from linkmill.llm.substrings import strip_repeats
from linkmill.llm.toxicity import THRESHOLD, learn_toxicity, score_toxicity

SIMILAR_PERCENT = 80
WINDOW = 35


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents and leave out those whose score reaches the threshold."""
    model = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, "_toxicity").where(F.col("_toxicity") < THRESHOLD).drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: the one with the smallest id, rows without an id last.

    Every row counts for itself, so of rows that repeat an id, or have none, one stays if they are copies.
    """
    columns = [f"`{c}`" for c in docs.columns]
    # What numbers rows must be written: another reading could number them differently.
    rows = Staged(docs.select(F.monotonically_increasing_id().alias("_row"), *columns), "numbered").df
    ids = rows.select("_row", F.col("doc_id").cast("long").alias("_id"))
    with staged_here() as tables:
        found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), SIMILAR_PERCENT)
        found = found.select(F.col("doc_id").alias("_row"), "component_id").join(ids, "_row")
        first = F.min(F.struct(F.col("_id").isNull().alias("nameless"), "_id", "_row"))
        kept = found.groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
        gone = found.join(kept, "component_id").where("_row <> first._row").select("_row")
    # Numbers of rows are all that is needed further on.
    gone = Staged(gone, "gone").df
    for table in tables:
        table.drop()
    return rows.join(gone, "_row", "left_anti").select(*columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out every passage of `WINDOW` words or more that occurs twice; leave out documents of which nothing is left."""
    return strip_repeats(docs, WINDOW)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target: rows are left out or repeated."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all rows in sequences, a row per piece."""
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return pack_documents(docs, f.read())


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("repeated passages", cut_repeats),
          ("mixing", mix), ("packing", pack)]
# SQL has neither the learned scores nor the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; what a stage wrote goes once the next one has read it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        following = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            before.drop()
        docs, before = following.df, following
    return docs
