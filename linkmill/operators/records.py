"""Typed records from pages, described by field specifications."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill import schemas
from linkmill.functions import fields as C
from linkmill.operators.nodes import Each, select_nodes

ColumnFn = Callable[[Column], Column]


def each(*steps: ColumnFn) -> ColumnFn:
    """Input processor: apply the steps to every value."""
    return lambda values: C.map_compose(values, *steps)


def each_flat(step: ColumnFn) -> ColumnFn:
    """Input processor: a step giving several values per value."""
    return lambda values: C.flat_map(values, step)


@dataclass(frozen=True)
class FieldSpec:
    """How one column of a record is read from a page.

    `input` processors turn an array into an array, `output` turns it into the
    value. Any function from Column to Column fits, including a Pandas UDF.
    """

    selector: str
    input: tuple[ColumnFn, ...] = field(default=())
    output: ColumnFn = C.take_first


def extract_records(pages: DataFrame, spec: Mapping[str, FieldSpec], html: str = "html") -> DataFrame:
    """One row per page with a column per field; the page text is dropped."""
    keep = [c for c in pages.columns if c != html]
    found = select_nodes(pages, {f"_{n}": s.selector for n, s in spec.items()}, html)
    columns = []
    for name, s in spec.items():
        values = F.col(f"_{name}")
        for step in s.input:
            values = step(values)
        columns.append(s.output(values).alias(name))
    return found.select(*keep, *columns)


# The two marks appended to a title, in order.
TITLE_SUFFIXES = ("-风骚", "男")
# Fixed value: text of the map link inside an address block.
MAP_LINK = "查看地图"
# Fixed value: unit of the speed column of an endpoint list.
SECONDS = "秒"


def article_spec(suffixes: tuple[str, ...] = TITLE_SUFFIXES, date_format: str = "yyyy/M/d",
                 default_date: Column | dt.date | None = None, parity: bool = False) -> dict[str, FieldSpec]:
    """The article page. `parity` keeps the known defects of dates and counters."""
    def number(selector: str) -> FieldSpec:
        if parity:
            return FieldSpec(selector, output=lambda v: F.lit(0).cast("bigint"))
        return FieldSpec(selector, (each(C.first_int),))

    return {
        "title": FieldSpec("#cb_post_title_url span::text", (each(lambda c: C.append_suffix(c, *suffixes)),)),
        "content": FieldSpec("#cnblogs_post_body"),
        "create_date": FieldSpec("#post-date ::text", (
            each(lambda c: C.parse_date_or(c, date_format, default_date, parity)),)),
        "tags": FieldSpec(".postDesc a::text", (each(C.first_token),)),
        "comment_nums": number("#post_comment_count ::text"),
        "praise_nums": number("#post_view_count ::text"),
        "fav_nums": number("#post_view_count ::text"),
    }


JOB_SPEC: dict[str, FieldSpec] = {
    "title": FieldSpec(".job-name::attr(title)"),
    "salary": FieldSpec(".job_request .salary::text", (each(C.salary_floor),)),
    "job_city": FieldSpec("//*[@class='job_request']//span[2]/text()", (each(C.remove_char),)),
    "work_years": FieldSpec("//*[@class='job_request']//span[3]/text()", (each(C.remove_char),)),
    "degree_need": FieldSpec("//*[@class='job_request']//span[4]/text()", (each(C.remove_char),)),
    "job_type": FieldSpec("//*[@class='job_request']//span[5]/text()"),
    "tags": FieldSpec(".position-label li::text", output=C.join_values),
    "publish_time": FieldSpec(".publish_time::text", (each_flat(C.split_once),)),
    "job_advantage": FieldSpec(".job-advantage p::text"),
    "job_desc": FieldSpec(".job_bt div"),
    "job_addr": FieldSpec(".work_addr", (each(C.strip_tags, lambda c: C.clean_lines(c, MAP_LINK)),)),
    "company_name": FieldSpec("#job_company dt a img::attr(alt)"),
    "company_url": FieldSpec("#job_company dt a::attr(href)"),
}


def url_has_digit(url: Column) -> Column:
    # The first line only: a digit after a line break does not count.
    return url.rlike(r"^.*\d")


def _in_layout(df: DataFrame, layout, *lead: str) -> DataFrame:
    columns = []
    for f in layout.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        columns.append(c.cast(f.dataType).alias(f.name))
    return df.select(*lead, *columns)


def extract_articles(pages: DataFrame, spec: Mapping[str, FieldSpec] | None = None) -> DataFrame:
    """Article records of the pages whose URL contains a digit.

    The cover image comes from the listing page: see `enrich.carry_meta`.
    """
    detail = pages.filter(url_has_digit(F.col("url")))
    out = extract_records(detail, article_spec() if spec is None else spec)
    out = out.withColumn("url_object_id", C.md5_id(F.col("url")))
    return _in_layout(out, schemas.ARTICLE, *[c for c in ("page_id",) if c in pages.columns])


def extract_jobs(pages: DataFrame, spec: Mapping[str, FieldSpec] = JOB_SPEC,
                 at: Column | dt.datetime | None = None) -> DataFrame:
    """Job records, stamped with the crawl time."""
    out = extract_records(pages, spec).withColumn("url_object_id", C.md5_id(F.col("url")))
    return _in_layout(C.stamp(out, "crawl_time", at), schemas.JOB,
                      *[c for c in ("page_id",) if c in pages.columns])


def extract_table(pages: DataFrame, rows: str = "#list tr", cells: str = "td::text",
                  speed: str | None = "td:nth-child(6)::text", unit: str = SECONDS,
                  positions: Mapping[str, int] | None = None) -> DataFrame:
    """One record per table row but the first of each page.

    Columns are read by position among all cell texts; `speed` is the number in
    front of the unit, null when missing or not a number.
    """
    positions = positions or {"ip": 0, "port": 1, "proxy_type": 3}
    inner = {"cells": cells} if speed is None else {"cells": cells, "speed": speed}
    found = select_nodes(pages, {"_rows": Each(rows, inner)})
    keep = [c for c in found.columns if c != "_rows"]
    table = found.select(*keep, F.posexplode("_rows").alias("pos", "_row")).filter(F.col("pos") > 0)
    columns = [F.get(F.col("_row.cells"), i).alias(n) for n, i in positions.items()]
    if speed is not None:
        text = F.when(F.size("_row.speed") > 0, F.array_join("_row.speed", ""))
        columns.append(C.number_before(text, unit).alias("speed"))
    return table.select(*keep, "pos", *columns)
