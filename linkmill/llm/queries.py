"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkmill.llm.alignment import align_documents
from linkmill.llm.byte_pairs import encoding_report, read_ranks
from linkmill.llm.licences import scan_licences
from linkmill.llm.mixing import mixture_report
from linkmill.llm.near_text import near_duplicates
from linkmill.llm.near_vectors import near_vectors
from linkmill.llm.packing import pack_documents
from linkmill.llm.preference import format_preferences, pair_conversations, spans_text
from linkmill.llm.ranked_search import search
from linkmill.llm.substrings import repeats_report
from linkmill.llm.syncmers import fingerprint_documents
from linkmill.llm.token_counts import read_pieces, token_counts
from linkmill.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed tokenizers; they are not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_near_text(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op2_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture_report(table(spark, folder, "documents"))


@query
def op4_preference(spark: SparkSession, folder: str) -> DataFrame:
    pairs = format_preferences(pair_conversations(table(spark, folder, "conversations")))
    return pairs.select("pair_id", "n_common", "prompt", "chosen", "rejected",
                        spans_text("chosen_spans").alias("chosen_mask"),
                        spans_text("rejected_spans").alias("rejected_mask"))


SQL["op4_preference"] = """
WITH turns AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, (conv_id % 2 + 2) % 2 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n, role, text
  FROM conversations WHERE conv_id IS NOT NULL),
halves AS (SELECT pair_id, coalesce(max(n) FILTER (side = 0), 0) // 2 AS half FROM turns GROUP BY pair_id),
sides AS (
  SELECT pair_id, 'chosen' AS kind, pos, role, text FROM turns WHERE side = 0
  UNION ALL
  SELECT pair_id, 'rejected', pos, role, text FROM turns JOIN halves USING (pair_id)
  WHERE (side = 0 AND pos <= half) OR (side = 1 AND pos > half)),
shown AS (
  SELECT *, '<|im_start|>' || replace(coalesce(role, ''), '<|im_', '< |im_') || chr(10) AS head,
         replace(coalesce(text, ''), '<|im_', '< |im_') || '<|im_end|>' || chr(10) AS tail FROM sides),
differing AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.pos, b.pos)) AS first
  FROM (SELECT * FROM shown WHERE kind = 'chosen') a
  FULL JOIN (SELECT * FROM shown WHERE kind = 'rejected') b ON a.pair_id = b.pair_id AND a.pos = b.pos
  WHERE a.pos IS NULL OR b.pos IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text
  GROUP BY 1),
placed AS (
  SELECT s.*, coalesce(d.first, 9223372036854775807) AS first,
         sum(length(head) + length(tail)) OVER (PARTITION BY s.pair_id, kind, pos >= coalesce(d.first, 9223372036854775807)
                                                ORDER BY pos) - length(tail) AS since
  FROM shown s LEFT JOIN differing d USING (pair_id))
SELECT pair_id,
       CAST(count(*) FILTER (kind = 'chosen' AND pos < first) AS INTEGER) AS n_common,
       coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (kind = 'chosen' AND pos < first), '') AS prompt,
       coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (kind = 'chosen' AND pos >= first), '') AS chosen,
       coalesce(string_agg(head || tail, '' ORDER BY pos) FILTER (kind = 'rejected' AND pos >= first), '') AS rejected,
       coalesce(string_agg(since || '-' || (since + length(tail) - 1), ',' ORDER BY pos)
                FILTER (kind = 'chosen' AND pos >= first AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(since || '-' || (since + length(tail) - 1), ',' ORDER BY pos)
                FILTER (kind = 'rejected' AND pos >= first AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id
"""


@query
def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats_report(table(spark, folder, "documents"), window=35)


@query
def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(table(spark, folder, "documents"))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), *read_pieces(tokenizer_path("piece_bpe_32k.model")))


@query
def op8_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return pack_documents(table(spark, folder, "documents"), f.read())


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    return encoding_report(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


SQL["op12_ranked_search"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
sizes AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM texts WHERE len(terms) > 0),
items AS (
  SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS q FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark) GROUP BY ALL),
held AS (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM texts)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, sizes GROUP BY term),
scores AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words))))) AS BIGINT) AS score
  FROM items JOIN held USING (term) JOIN weights USING (term), sizes GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f, open(tokenizer_path("piece_bpe_32k.model"), "rb") as g:
        return align_documents(table(spark, folder, "documents"), f.read(), g.read(), public_tokenizers.PATTERN)


def named_queries() -> dict[str, Query]:
    return dict(REGISTRY)


def sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express over whole tables."""
    return dict(SQL)
