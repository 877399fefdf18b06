"""Filters and the separation of incomplete records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.operators.records import url_has_digit


def filter_html(df: DataFrame, html: str = "html") -> DataFrame:
    """Pages whose text is HTML."""
    return df.filter(F.col(html).rlike("(?i)<html"))


def filter_url_has_digit(df: DataFrame, url: str = "url") -> DataFrame:
    return df.filter(url_has_digit(F.col(url)))


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """`(good, rejects)`; a reject names the fields it lacks in `missing`."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in required])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.filter(complete), df.filter(~complete).withColumn("missing", missing)


def check_ok(status: Column) -> Column:
    """A status from 200 to 299 is healthy; no status is a failure."""
    return F.coalesce(status.between(200, 299), F.lit(False))


def filter_status_ok(checks: DataFrame, status: str = "status") -> DataFrame:
    return checks.filter(check_ok(F.col(status)))
