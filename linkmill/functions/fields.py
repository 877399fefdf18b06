"""Cleaning functions for extracted values.

All are native column expressions. Functions on arrays follow the record rule:
a null result disappears, an array result is flattened, an absent field stays
absent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnFn = Callable[[Column], Column]


def drop_null(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def _of_value(step: ColumnFn) -> ColumnFn:
    """The step as a function of one parameter: a second one would receive the position."""
    return lambda value: step(value)


def map_compose(values: Column, *steps: ColumnFn) -> Column:
    """Apply each step to every value in turn and drop the nulls it produces."""
    out = drop_null(values)
    for step in steps:
        out = drop_null(F.transform(out, _of_value(step)))
    return out


def flat_map(values: Column, step: ColumnFn) -> Column:
    """Like one step of `map_compose` for a step that returns an array."""
    return drop_null(F.flatten(drop_null(F.transform(drop_null(values), _of_value(step)))))


def take_first(values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.get(F.filter(values, lambda x: x.isNotNull() & (x.cast("string") != "")), 0)


def join_values(values: Column, sep: str = ",") -> Column:
    """All values joined; null where there is no value at all."""
    return F.when(F.size(drop_null(values)) > 0, F.array_join(drop_null(values), sep))


def keep_list(values: Column) -> Column:
    return F.when(F.size(drop_null(values)) > 0, drop_null(values))


def append_suffix(c: Column, *suffixes: str) -> Column:
    return F.concat(c, *[F.lit(s) for s in suffixes])


def parse_date_or(c: Column, fmt: str = "yyyy/M/d", default: Column | dt.date | None = None,
                  parity: bool = False) -> Column:
    """Date in the given form, otherwise `default` (today when not given).

    `parity` keeps a known defect: a date that parses becomes null.
    """
    if default is None:
        default = F.current_date()
    elif not isinstance(default, Column):
        default = F.lit(default)
    parsed = F.try_to_date(c, fmt)
    if parity:
        return F.when(c.isNotNull() & parsed.isNull(), default)
    return F.when(c.isNotNull(), F.coalesce(parsed, default))


def first_int(c: Column) -> Column:
    """First run of digits on the first line, else 0; null stays null, and so does a number beyond bigint."""
    digits = F.regexp_extract(c, r"^.*?(\d+)", 1)
    return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))


def salary_floor(c: Column) -> Column:
    """Lower bound of a range given in thousands: `25k-30k` is 25000; null beyond bigint."""
    return F.try_multiply(first_int(c), F.lit(1000).cast("bigint"))


def first_token(c: Column, sep: str = ",") -> Column:
    return F.split_part(c, F.lit(sep), F.lit(1))


def remove_char(c: Column, ch: str = "/") -> Column:
    return F.replace(c, F.lit(ch), F.lit(""))


def split_once(c: Column, sep: str = " ") -> Column:
    """Array of the text before and after the first `sep`."""
    return F.split(c, rf"\Q{sep}\E", 2)


def strip_tags(c: Column) -> Column:
    """Remove comments and tags; entities stay."""
    return F.regexp_replace(c, r"(?s)<!--.*?-->|</?[^ >/]+.*?>", "")


def clean_lines(c: Column, drop: str | None = None) -> Column:
    """Lines stripped and joined without a separator, leaving out the marker line."""
    lines = F.transform(F.split(c, "\n"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))
    if drop is not None:
        lines = F.filter(lines, lambda s: s != drop)
    return F.array_join(lines, "")


def md5_id(c: Column) -> Column:
    return F.md5(c)


def number_before(c: Column, unit: str) -> Column:
    """Number in front of the unit mark; null when the text is no number."""
    return F.split_part(c, F.lit(unit), F.lit(1)).try_cast("double")


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls of the named columns; arrays are first joined by comma."""
    out = {}
    for name, value in defaults.items():
        if name not in df.columns:
            out[name] = F.lit(value)
            continue
        kind = df.schema[name].dataType
        c = F.col(name)
        if isinstance(kind, T.ArrayType):
            out[name] = F.coalesce(F.array_join(c, ","), F.lit(value))
        else:
            out[name] = F.coalesce(c, F.lit(value).cast(kind))
    return df.withColumns(out)


def stamp(df: DataFrame, name: str = "crawl_time", at: Column | dt.datetime | None = None) -> DataFrame:
    """Add the crawl time: the time of the query, or a given one for repeatable runs."""
    if at is None:
        at = F.current_timestamp()
    elif not isinstance(at, Column):
        at = F.lit(at)
    return df.withColumn(name, at)
