"""The three crawls as chains of operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions import fields as C
from linkmill.functions import urls as U
from linkmill.operators import enrich, quality
from linkmill.operators.dedup import admit, fingerprint
from linkmill.operators.links import (JOB_LINK_RULES, LinkRule, ListingSpec, PagerSpec, extract_links,
                                      listing_requests, route_links)
from linkmill.operators.records import JOB_SPEC, FieldSpec, extract_articles, extract_jobs, extract_table
from linkmill.operators.stats import carry_forward
from linkmill.plans.staging import stage


def admitted_per_host(pages: DataFrame) -> DataFrame:
    """`host, n_links`: distinct link targets of all pages, counted per host."""
    links = extract_links(pages).select(F.struct("page_id", "pos").alias("seq"),
                                        F.col("abs_url").alias("url"))
    admitted, _ = admit(fingerprint(links), dont_filter=None)
    return admitted.groupBy(U.url_host("url").alias("host")).agg(F.count("*").alias("n_links"))


def article_requests(pages: DataFrame, listing: ListingSpec = ListingSpec(),
                     pager: PagerSpec = PagerSpec(), marker: str = ">") -> DataFrame:
    """Requests found on listing pages: the articles, and the next page."""
    rows = listing_requests(pages, listing, pager, marker)
    more = F.col("pos").isNull()
    return fingerprint(rows.select(
        "page_id", "pos", F.col("abs_url").alias("url"),
        F.when(more, F.lit("parse")).otherwise(F.lit("parse_detail")).alias("callback"), more.alias("dont_filter"),
        "front_image_url"))


def article_records(details: DataFrame, requests: DataFrame | None = None,
                    spec: Mapping[str, FieldSpec] | None = None) -> DataFrame:
    """Article records of detail pages, with the image of the listing entry that led to them.

    The join reads both sides more than once, so both are staged: every page is parsed once.
    """
    items = extract_articles(details, spec)
    if requests is None:
        return items
    listing = stage(requests.filter(F.col("callback") == "parse_detail").select(
        "fp", F.struct("page_id", "pos").alias("seq"), "front_image_url"), "listing")
    keyed = stage(fingerprint(items.drop("front_image_url")), "articles")
    carried = enrich.carry_meta(keyed, listing)
    image = F.when(F.col("front_image_url").isNotNull(), F.array("front_image_url"))
    return carried.withColumn("front_image_url", image).select(*items.columns)


def job_frontier(pages: DataFrame, seen: DataFrame | None = None,
                 rules: Sequence[LinkRule] = JOB_LINK_RULES) -> tuple[DataFrame, DataFrame]:
    """`(admitted, new_seen)` of the links that a rule takes."""
    routed = route_links(extract_links(quality.filter_html(pages)), rules)
    requests = routed.select(F.struct("page_id", "pos").alias("seq"), F.col("abs_url").alias("url"), "rule",
                             "callback", "follow", "options")
    return admit(fingerprint(requests, options_col="options"), seen, dont_filter=None)


def job_records(pages: DataFrame, spec: Mapping[str, FieldSpec] = JOB_SPEC, at: Column | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """`(good, rejects)` job records; every field is required."""
    jobs = extract_jobs(pages, spec, at)
    return quality.split_valid(jobs, [c for c in jobs.columns if c != "page_id"])


def endpoint_pool(pages: DataFrame, checks: DataFrame, fill_speed: bool = False) -> DataFrame:
    """Endpoints of the list pages without those whose check failed.

    Carrying the speed measures the rows before it moves them, so they are staged: every page is parsed once.
    """
    rows = extract_table(pages)
    if fill_speed:
        rows = carry_forward(stage(rows, "endpoints"), "speed", ["pos"], ["page_id"])
    return C.with_defaults(enrich.prune_failed(rows, checks), {"proxy_type": "HTTP"})
