from urllib.parse import urljoin

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkmill.functions import urls as U

BASES = ["http://h.example.com/a/b", "http://h.example.com", "https://h.example.com/a/b/?q=1&r=2#frag",
         "http://u:p@H.example.com:80/x/../y/z.html?k"]
HREFS = ["c", "../c", "?q=2", "#z", "//k.example.com/y", "/r", "", "./", "..", "../../../../d/e", "/a/./b/../c",
         "http:foo", "http://x.org/a#", "http://x.org/a?", "/b?", "mailto:a@b", "g;x=1/../y", "a//b", "/a//b", "/..",
         "/.", "../", "x?y=../z", "HTTP://z/../q", "?", "#", "/a?b#c", "https:bar/../baz", "c/.", "/b?#x", "/c.d/.e"]


def test_resolve_like_the_standard_library(spark):
    data = [(b, h, urljoin(b, h)) for b in BASES for h in HREFS]
    df = spark.createDataFrame(data, "b string, h string, e string").withColumn(
        "r", U.resolve_url("b", "h"))
    assert rows(df.filter("not (r <=> e)")) == []


@pytest.mark.parametrize("fn, cases", [
    (lambda c: U.fix_scheme(F.col(c)), [("//i.example.com/a", "https://i.example.com/a"), ("/a", "/a"), ("", "")]),
    (U.canonical_url, [
        ("http://E.example.com/a?b=2&a=1#f", "http://e.example.com/a?a=1&b=2"),
        ("http://a.b", "http://a.b/"),
        ("http://a.b/x y/é?q=é z&p", "http://a.b/x%20y/%C3%A9?p=&q=%C3%A9+z"),
        ("http://a.b/%7euser/%2f%c3%a9%a3?x=%7e&x=%20+", "http://a.b/~user/%2F%C3%A9%A3?x=++&x=~"),
        ("http://a.b:/p?", "http://a.b/p"),
        ("HTTP://A.b/p?a=b=c&&d=*", "http://a.b/p?a=b%3Dc&d=%2A"),
        ("http://a.b/?%zz=1", "http://a.b/?%25zz=1"),
        ("http://a.b/?b=%C3%A9&b=a", "http://a.b/?b=a&b=%C3%A9"),
    ]),
    (lambda c: U.canonical_url(c, keep_fragments=True), [("http://a.b/#é", "http://a.b/#%C3%A9")]),
    (U.url_host, [("http://u:p@H.example.com:80/x", "h.example.com"), ("http://h?x=/y", "h")]),
    (U.request_fingerprint, [("http://e.example.com/a?b=2&a=1#f", "c088e167ffd15d40ebfd5c596490186ffc40e2cc")]),
    (U.safe_url, [("/a b%20é?x={1}#ü", "/a%20b%20%C3%A9?x=%7B1%7D#%C3%BC"), ("/a,b", "/a,b")]),
])
def test_single_column_functions(spark, fn, cases):
    df = spark.createDataFrame(cases, "u string, e string").withColumn("r", fn("u"))
    assert rows(df.filter("not (r <=> e)")) == []


def test_options_change_the_fingerprint_whatever_their_order(spark):
    df = spark.createDataFrame([(1, {"a": "1", "url": "http://X.b/?b=1&a=2"}), (2, {"url": "http://x.b/?a=2&b=1", "a": "1"}),
                                (3, {}), (4, None), (5, {"a": "2"})], "i int, o map<string,string>")
    fp = {r.i: r.fp for r in df.select("i", U.request_fingerprint("'http://x.b/'", options="o")
                                       .alias("fp")).collect()}
    assert fp[1] == fp[2] and fp[3] == fp[4] and len(set(fp.values())) == 3
