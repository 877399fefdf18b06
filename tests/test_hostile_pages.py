"""Pages that are large, broken or odd: right links in linear time, nothing lost."""

import sys
import time

from conftest import rows
from pyspark.sql import functions as F

from linkmill.functions.html import Tree, compile_selector
from linkmill.operators import frontier
from linkmill.operators.dedup import admit, fingerprint, merge_pending
from linkmill.operators.links import JOB_LINK_RULES, JOB_LINK_RULES_PARITY, extract_links, route_links

LINK = '<a href="/end">x</a>'


def links(spark, *pages):
    df = spark.createDataFrame([(i, "http://h.example/d/", html) for i, html in enumerate(pages)],
                               "page_id long, url string, html string")
    found = {i: [] for i in range(len(pages))}
    for r in extract_links(df).orderBy("page_id", "pos").collect():
        found[r.page_id].append(r.abs_url.removeprefix("http://h.example"))
    return found


def test_no_page_stops_the_job(spark):
    pages = ["<a " + "word " * 100_000 + ">" + LINK, "<a " + "k='v' " * 100_000 + "href=/in>" + LINK,
             LINK + "<!-- " * 25_000, LINK + "<script>" * 10_000, "<a x=\"" * 20_000 + LINK, LINK + "<a href='/open",
             "<!-- <a href='/no'> -->" + LINK, LINK + "<!-- <a href='/no'>"]
    links(spark, "warm")
    start = time.perf_counter()
    found = links(spark, *pages)
    assert time.perf_counter() - start < 20
    assert found[0] == ["/end"] and found[1] == ["/in", "/end"] and found[5] == ["/end"]
    assert all(found[i] == ["/end"] for i in (2, 3, 6, 7))


def test_references_are_decoded_once(spark):
    assert links(spark, '<a href="/caf&eacute;?a=1&amp;b=&#47;&#x41;">', '<a href="/&#38;amp;">', '<a href="/x?a=1&region=2&copy=3">',
                 '<a title="x href=\'/no\'" href="/yes">') == {
        0: ["/caf%C3%A9?a=1&b=/A"], 1: ["/&amp;"], 2: ["/x?a=1&region=2&copy=3"], 3: ["/yes"]}


def test_attributes_keep_names_without_semicolon():
    tree = Tree('<a href="/x?a=1&region=2&copy=3&lt;&notit;&not;&amp">t</a>')
    assert compile_selector("a::attr(href)").values(tree) == ["/x?a=1&region=2&copy=3<&notit;¬&"]


def steps(source, *selectors):
    """Lines of the parser and the selectors that run: the work, whatever else the machine does."""
    count = 0

    def traced(frame, event, _):
        nonlocal count
        if not frame.f_code.co_filename.endswith("html.py"):
            return None
        count += event == "line"
        return traced

    before = sys.gettrace()
    sys.settrace(traced)
    try:
        tree = Tree(source)
        for s in selectors:
            for node in compile_selector(s).nodes(tree, tree.root):
                compile_selector("td").nodes(tree, node)
    finally:
        sys.settrace(before)
    return count


def test_work_follows_the_size_of_the_page():
    for make, selector in ((lambda n: "<table>" + "<tr><td>a<td>b" * n, "tr"), (lambda n: "<div>" * n + "</b>" * n, "p"),
                           (lambda n: "<p><table><td>" + "<b>" * n + "<div></div>" * n, "p")):
        assert steps(make(8_000), selector) < 9 * steps(make(1_000), selector)


def test_links_of_long_pages_keep_their_place(spark):
    page = "".join(f'<a href="/p{{}}/{k}">x</a>' for k in range(1500))
    df = spark.createDataFrame([(i, "http://h.example/", page.replace("{}", str(i))) for i in (1, 2)],
                               "page_id long, url string, html string")
    requests = fingerprint(extract_links(df).select(F.struct("page_id", "pos").alias("seq"), F.col("abs_url").alias("url")))
    assert requests.select("seq").distinct().count() == 3000
    admitted, _ = admit(requests, dont_filter=None)
    assert admitted.count() == 3000


def test_batch_and_rest_with_null_spiders(spark):
    df = spark.createDataFrame([(1, None, 0), (2, None, 0), (3, "s", 0), (None, "t", 0), (5, "t", 0)],
                               "seq long, spider string, priority int")
    for n in (1, 2, 3):
        for broadcast_rows in (0, 10**6):
            batch, rest = frontier.select_batch(df, n, broadcast_rows=broadcast_rows)
            assert sorted(map(str, rows(batch) + rows(rest))) == sorted(map(str, rows(df)))


def test_requests_without_url_are_not_admitted(spark):
    df = fingerprint(spark.createDataFrame([(1, None), (2, None), (3, "http://h.example/")], "seq long, url string"))
    admitted, seen = admit(df, dont_filter=None)
    assert [r.seq for r in admitted.collect()] == [3] and seen.count() == 1


def test_pending_requests_keep_their_columns(spark):
    schema = "spider string, request_key string, seq long, priority int, url string, options map<string,string>"
    old = spark.createDataFrame([("s", "k", 1, 5, "u1", {"a": "1"}), (None, "n", 2, 1, "u2", None)], schema)
    new = spark.createDataFrame([("s", "k", 7, 9, "u7", {}), ("s", "m", 8, 2, "u8", {"b": "2"}), (None, "n", 9, 4, "u9", None)],
                                schema)
    got = {r.request_key: tuple(r) for r in merge_pending(old, new).collect()}
    assert got == {"k": ("s", "k", 1, 9, "u1", {"a": "1"}), "m": ("s", "m", 8, 2, "u8", {"b": "2"}),
                   "n": (None, "n", 2, 4, "u2", None)}


def test_default_job_rules(spark):
    urls = ["http://h/jobs/12.html", "http://h/gongsi/j123.html", "http://h/guangzhou-zhaopin/x", "http://h/jobs/12xhtml"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, abs_url string")
    got = {r.page_id: r.rule for r in route_links(df, JOB_LINK_RULES).collect()}
    assert got == {0: "job", 1: "company", 2: "city"}
    assert {r.page_id for r in route_links(df, JOB_LINK_RULES_PARITY).collect()} == {0, 2, 3}
