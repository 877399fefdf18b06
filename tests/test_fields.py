import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from linkmill import schemas
from linkmill.functions import fields as C

DEFAULT = dt.date(2000, 1, 1)


def run(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(rows(df.select("i", fn(F.col("v")))))]


def test_take_first(spark):
    assert run(spark, [["", None, "x", "y"], [], None], C.take_first, "array<string>") == ["x", None, None]
    assert run(spark, [[None, 0, 3]], C.take_first, "array<bigint>") == [0]


def test_map_compose_drops_nulls_and_keeps_order(spark):
    def fn(v):
        return C.map_compose(v, F.upper, lambda x: F.when(x != "B", x))
    assert run(spark, [["a", "b", None, "c"], None], fn, "array<string>") == [["A", "C"], None]


def test_steps_with_default_arguments_get_the_value_only(spark):
    assert run(spark, [["a,b", "c,d"]], lambda v: C.map_compose(v, C.first_token), "array<string>") == [["a", "c"]]
    assert run(spark, [["a b c", "d"]], lambda v: C.flat_map(v, C.split_once), "array<string>") == [["a", "b c", "d"]]


def test_join_values(spark):
    assert run(spark, [["Spark", "SQL"], []], C.join_values, "array<string>") == ["Spark,SQL", None]


def test_append_suffix(spark):
    assert run(spark, ["T"], lambda c: C.append_suffix(c, "-x", "y")) == ["T-xy"]


def test_parse_date_or(spark):
    texts = ["2020/04/22", "2020-04-22 10:11", "2020/4/2", None]
    assert run(spark, texts, lambda c: C.parse_date_or(c, default=DEFAULT)) == [
        dt.date(2020, 4, 22), DEFAULT, dt.date(2020, 4, 2), None]
    assert run(spark, texts, lambda c: C.parse_date_or(c, default=DEFAULT, parity=True)) == [
        None, DEFAULT, None, None]


def test_first_int_and_salary(spark):
    texts = ["阅读(123)评论45", "abc", "", "a\n12", "99999999999999999999", None]
    assert run(spark, texts, C.first_int) == [123, 0, 0, 0, None, None]
    assert run(spark, ["25k-30k", "面议"], C.salary_floor) == [25000, 0]
    assert run(spark, ["a99999999999999999999", "9223372036854775807k"], C.first_int) == [None, 2**63 - 1]
    assert run(spark, ["a99999999999999999999", "9223372036854775807k", None], C.salary_floor) == [None, None, None]


def test_tokens(spark):
    assert run(spark, ["a,b", "a"], C.first_token) == ["a", "a"]
    assert run(spark, ["/广州 /"], C.remove_char) == ["广州 "]
    assert run(spark, ["20:02 发布 于", " 发布 x"], lambda c: C.take_first(C.split_once(c))) == ["20:02", "发布 x"]


def test_markup_and_lines(spark):
    assert run(spark, ["<b>x</b> <!-- c -->y", "a < b > c &amp;"], C.strip_tags) == ["x y", "a < b > c &amp;"]
    text = "\n广州 -\n 天河区 \n查看地图\n"
    assert run(spark, [text], lambda c: C.clean_lines(c, "查看地图")) == ["广州 -天河区"]


def test_md5_and_number(spark):
    assert run(spark, ["http://cnblogs.com"], C.md5_id) == ["b31f586ca63018e49a7cd4ace7999e6e"]
    assert run(spark, ["0.5秒", "abc", None], lambda c: C.number_before(c, "秒")) == [0.5, None, None]


def test_defaults_of_an_empty_article(spark):
    df = spark.createDataFrame([tuple([None] * len(schemas.ARTICLE.fields))], schemas.ARTICLE)
    row = C.with_defaults(df, schemas.ARTICLE_LOAD_DEFAULTS).first()
    assert (row.title, row.front_image_url, row.praise_nums, row.create_date) == ("", "", 0, dt.date(1970, 7, 1))


def test_stamp(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows(C.stamp(spark.range(1), "t", at).select("t")) == [(at,)]
    assert C.stamp(spark.range(1)).first().crawl_time is not None
