"""Selectors, links and records on small pages."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkmill import schemas
from linkmill.functions.html import Tree, compile_selector
from linkmill.operators import links as L
from linkmill.operators import records as R
from linkmill.operators.nodes import Each, select_nodes
from linkmill.operators.quality import split_valid
from linkmill.operators.stats import carry_forward
from linkmill.plans import crawls
from linkmill.sinks.files import endpoint_rows

LISTING = """<html><body>
<div class="post-item"><div class="post-item-text"><a href="/u/a/p/101.html">A</a><p class="post-item-summary"><img src="//img.example.com/a.png">Text</p></div></div>
<div class="post-item"><div class="post-item-text"><a href="102.html">B</a><p class="post-item-summary">No image</p></div></div>
<div class="pager"><a href="/p/1">1</a><a href="/p/2">&gt;</a></div>
</body></html>"""
BODY = '<div id="cnblogs_post_body"><p>Body <b>x</b></p></div>'
ARTICLE = f"""<a id="cb_post_title_url"><span>Title one</span></a>
{BODY}
<div class="postDesc"><span id="post-date">2020/04/22</span> <span id="post_view_count">7</span> <span id="post_comment_count">3</span> <a href="#">tagA,tagB</a><a href="#">tagC</a></div>"""
JOB = """<div class="job-name" title="Dev"></div>
<dd class="job_request"><h3><span class="salary">25k-30k</span><span>/广州 /</span><span>经验3-5年 /</span><span>本科 /</span><span>全职</span></h3>
<ul class="position-label"><li>Spark</li><li>SQL</li></ul><p class="publish_time">20:02 发布</p></dd>
<dd class="job-advantage"><p>Good</p></dd><dd class="job_bt"><div><p>Desc</p></div></dd>
<div class="work_addr">
<a>广州</a> -
<a>天河区</a>
<a>查看地图</a>
</div>
<dl id="job_company"><dt><a href="http://c.example.com"><img alt="Acme"></a></dt></dl>"""
TABLE = """<div id="list"><table><tr><th>IP</th></tr>
<tr><td>192.0.2.1</td><td>80</td><td>x</td><td>HTTP</td><td>y</td><td>0.5秒</td></tr>
<tr><td>192.0.2.2</td><td>81</td><td>x</td><td>HTTP</td><td>y</td><td></td></tr>
<tr><td>192.0.2.3</td><td>82</td><td>x</td><td>HTTPS</td><td>y</td><td>abc</td></tr></table></div>"""
BROKEN = """<ul><li>a<b>x</b>c<li class="k z">d</ul><p>one<p id=q>two<br>three</p><table><tr><td>1<td>2<tr><td>3</table>
</zz><div class=x><span>1</span><i></i><span>2</span></div><script>var a="</p><li>no</li>";</script>a <b>u &lt; &amp;<!-- c -->v"""


def page(spark, html, url="http://h.example.com/1"):
    return spark.createDataFrame([(1, url, html)], schemas.PAGE)


@pytest.mark.parametrize("selector, expected", [
    ("li::text", ["a", "c", "d"]),
    ("li ::text", ["a", "x", "c", "d"]),
    ("li", ["<li>a<b>x</b>c", '<li class="k z">d']),
    ("li:last-child::text", ["d"]),
    ("li.z.k::text", ["d"]),
    ("li.zz::text", []),
    ("p", ["<p>one", "<p id=q>two<br>three</p>"]),
    ("#q::text", ["two", "three"]),
    ("p::attr(id)", ["q"]),
    ("td", ["<td>1", "<td>2", "<td>3"]),
    ("tr td:nth-child(2)::text", ["2"]),
    ("//*[@class='x']//span[2]/text()", ["2"]),
    ("//*[@class='k']//b/text()", []),
    ("//p/@id", ["q"]),
    ("ul b::text", ["x"]),
    ("script::text", ['var a="</p><li>no</li>";']),
    ("div span:nth-child(3)::text", ["2"]),
    ("b::text", ["x", "u < &", "v"]),
])
def test_selectors_on_broken_markup(selector, expected):
    assert compile_selector(selector).values(Tree(BROKEN)) == expected


@pytest.mark.parametrize("text", ["a > b", "a:hover", "a[href]", "//a[last()]/text()"])
def test_unsupported_selectors_are_refused(text):
    with pytest.raises(ValueError):
        compile_selector(text)


def test_odd_markup_ends():
    for html in ("", "<", "a<b", "<a href='x", "<!-- open", "<script>x", "</p>", "<p", "<div " + "a" * 5000, "<b>" * 3000):
        Tree(html)
    assert compile_selector("a::attr(title)").values(Tree("<a title=don't href='x>y'>z</a>")) == ["don't"]


def test_select_nodes_keeps_other_columns_and_handles_null(spark):
    df = spark.createDataFrame([(1, "k", "<p>a</p>"), (2, "l", None)], "page_id long, tag string, html string")
    assert sorted(rows(select_nodes(df, {"p": "p::text"}))) == [(1, "k", ["a"]), (2, "l", [])]


def test_pages_with_escaped_class_names_are_not_skipped(spark):
    df = spark.createDataFrame([(1, '<i class="na&#109;e">x</i>'), (2, "<i>x</i>")], "page_id long, html string")
    assert sorted(rows(select_nodes(df, {"v": ".name::text"}))) == [(1, ["x"]), (2, [])]


def test_each_selects_inside_the_node(spark):
    df = select_nodes(page(spark, "<ul><li>a<b>1</b></li><li>b</li></ul>"), {
        "items": Each("li", {"own": "li::text", "b": "li b::text", "above": "ul li::text"})})
    assert [tuple(i) for i in df.first()["items"]] == [(["a"], ["1"], []), (["b"], [], [])]


def test_extract_links(spark):
    html = ("<!-- <a href='/no'>x</a> --><script>'<a href=\"/no\">'</script><a href='/a?x=1&amp;y=2'>1</a>"
            "<A class=\"c\" HREF=b.html>2</A><a href=\"/a?x=1&amp;y=2\">3</a><area shape=rect href=' /f.zip '>"
            "<a href='mailto:x@y'>4</a><a data-href='/no' name=q>5</a><abbr href='/no'>6</abbr><a\nhref='../é'>7</a>")
    links = L.extract_links(page(spark, html, "http://h.example.com/d/1"))
    assert sorted(rows(links.select("pos", "abs_url"))) == [
        (0, "http://h.example.com/a?x=1&y=2"), (1, "http://h.example.com/d/b.html"), (5, "http://h.example.com/%C3%A9")]
    assert L.extract_links(page(spark, html), unique=False).count() == 4


def test_base_tag(spark):
    html = '<base href="http://other.example.com/x/"><a href="y">1</a>'
    assert L.extract_links(page(spark, html)).first().abs_url == "http://other.example.com/x/y"


def test_no_shuffle_for_links(spark):
    plan = L.extract_links(page(spark, "<a href=x>")) ._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_route_links(spark):
    html = '<a href="jobs/1">1</a><a href="about">2</a><a href="jobs/1">3</a>'
    rules = [L.LinkRule("r1", r"jobs/\d+", callback="c", options={"k": "v"}), L.LinkRule("r2", ".*", follow=False)]
    routed = L.route_links(L.extract_links(page(spark, html)), rules).select("href", "rule", "callback", "follow", "options")
    assert sorted(rows(routed)) == [("about", "r2", None, False, {}), ("jobs/1", "r1", "c", True, {"k": "v"})]
    assert L.route_links(L.extract_links(page(spark, html)), rules[:1]).count() == 1


def test_domains(spark):
    assert L.domain_list("a.com,,b.com") == ["a.com", "b.com"]
    df = spark.createDataFrame([(f"http://{h}/",) for h in ("a.com", "x.b.com", "xb.com")], "url string")
    assert sorted(rows(L.filter_domains(df, "a.com,,b.com"))) == [("http://a.com/",), ("http://x.b.com/",)]
    assert L.filter_domains(df, "").count() == 3


def test_listing_and_pager(spark):
    p = page(spark, LISTING, "http://list.example.com/p/1")
    assert rows(L.extract_listing(p).orderBy("pos").select("abs_url", "front_image_url")) == [
        ("http://list.example.com/u/a/p/101.html", "https://img.example.com/a.png"),
        ("http://list.example.com/p/102.html", "")]
    assert rows(L.next_page(p).select("abs_url", "dont_filter")) == [("http://list.example.com/p/2", True)]
    assert L.next_page(page(spark, LISTING.replace("&gt;", "5"))).count() == 0


def test_article(spark):
    p = page(spark, ARTICLE, "http://blog.example.com/u/p/12.html")
    row = R.extract_articles(p, R.article_spec(default_date=dt.date(2000, 1, 1))).first()
    assert row.title == "Title one" + "".join(R.TITLE_SUFFIXES)
    assert (row.content, row.create_date, row.tags) == (BODY, dt.date(2020, 4, 22), "tagA")
    assert (row.comment_nums, row.praise_nums, row.fav_nums) == (3, 7, 7)
    assert row.url_object_id == "1c3fabc561af0a3fd4c7c5ad138c1454"
    same = R.extract_articles(p, R.article_spec(parity=True)).first()
    assert (same.comment_nums, same.praise_nums, same.fav_nums, same.create_date) == (0, 0, 0, None)
    assert R.extract_articles(page(spark, ARTICLE, "http://blog.example.com/u")).count() == 0


def test_article_gets_the_image_of_its_listing(spark):
    requests = crawls.article_requests(page(spark, LISTING, "http://list.example.com/p/1"))
    assert requests.count() == 3
    details = spark.createDataFrame([(2, "http://list.example.com/u/a/p/101.html", ARTICLE),
                                     (3, "http://list.example.com/p/102.html", ARTICLE)], schemas.PAGE)
    got = {r.page_id: r.front_image_url for r in crawls.article_records(details, requests).collect()}
    assert got == {2: ["https://img.example.com/a.png"], 3: None}


def test_job(spark):
    at = dt.datetime(2024, 1, 1)
    good, rejects = crawls.job_records(page(spark, JOB, "http://jobs.example.com/jobs/9.html"), at=F.lit(at))
    assert good.first().asDict() == {
        "page_id": 1, "title": "Dev", "url": "http://jobs.example.com/jobs/9.html",
        "url_object_id": "06925de94f1db1e84f180b5a44489657", "salary": 25000, "job_city": "广州 ",
        "work_years": "经验3-5年 ", "degree_need": "本科 ", "job_type": "全职", "publish_time": "20:02",
        "job_advantage": "Good", "job_desc": "<div><p>Desc</p></div>", "job_addr": "广州 -天河区",
        "company_name": "Acme", "company_url": "http://c.example.com", "tags": "Spark,SQL", "crawl_time": at}
    assert rejects.count() == 0
    good, rejects = crawls.job_records(page(spark, JOB.replace("publish_time", "other")))
    assert good.count() == 0 and rejects.first().missing == ["publish_time"]


def test_table(spark):
    table = R.extract_table(page(spark, TABLE))
    assert rows(table.orderBy("pos").select("ip", "port", "speed")) == [
        ("192.0.2.1", "80", 0.5), ("192.0.2.2", "81", None), ("192.0.2.3", "82", None)]
    filled = carry_forward(table, "speed", ["pos"], ["page_id"])
    assert [r.speed for r in filled.orderBy("pos").collect()] == [0.5, 0.5, 0.5]
    assert {r.proxy_type for r in endpoint_rows(table).collect()} == {"HTTP"}


def test_endpoint_pool(spark):
    checks = spark.createDataFrame([("192.0.2.2", 300), ("192.0.2.3", None), ("192.0.2.1", 299)], "ip string, status int")
    assert [r.ip for r in crawls.endpoint_pool(page(spark, TABLE), checks).collect()] == ["192.0.2.1"]


def test_job_frontier(spark):
    html = '<html><a href="/jobs/1.html">1</a><a href="/guangzhou-zhaopin/x">2</a><a href="/about">3</a></html>'
    admitted, new_seen = crawls.job_frontier(page(spark, html))
    assert sorted(r.rule for r in admitted.collect()) == ["city", "job"]
    assert crawls.job_frontier(page(spark, html), new_seen)[0].count() == 0


def test_split_valid(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 3)], "i int, a string, b int")
    good, rejects = split_valid(df, ["a", "b"])
    assert rows(good) == [(2, "b", 3)] and rows(rejects) == [(1, "a", None, ["b"])]
