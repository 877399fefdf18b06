"""Record layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

REQUEST = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("spider", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("dont_filter", T.BooleanType()),
    T.StructField("callback", T.StringType()),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    T.StructField("options", T.MapType(T.StringType(), T.StringType())),
])

ARTICLE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("url_object_id", T.StringType()),
    T.StructField("front_image_url", T.ArrayType(T.StringType())),
    T.StructField("front_image_path", T.StringType()),
    T.StructField("praise_nums", T.LongType()),
    T.StructField("comment_nums", T.LongType()),
    T.StructField("fav_nums", T.LongType()),
    T.StructField("tags", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("create_date", T.DateType()),
])

JOB = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("url_object_id", T.StringType()),
    T.StructField("salary", T.LongType()),
    T.StructField("job_city", T.StringType()),
    T.StructField("work_years", T.StringType()),
    T.StructField("degree_need", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("publish_time", T.StringType()),
    T.StructField("job_advantage", T.StringType()),
    T.StructField("job_desc", T.StringType()),
    T.StructField("job_addr", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("company_url", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("crawl_time", T.TimestampType()),
])

ENDPOINT = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("port", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("proxy_type", T.StringType()),
])

SEED = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("score", T.DoubleType()),
])

SEEN = T.StructType([
    T.StructField("spider", T.StringType()),
    T.StructField("fp", T.StringType()),
])

# Loading defaults of an article whose field is absent.
ARTICLE_LOAD_DEFAULTS = {
    "title": "",
    "url": "",
    "url_object_id": "",
    "front_image_url": "",
    "front_image_path": "",
    "praise_nums": 0,
    "comment_nums": 0,
    "fav_nums": 0,
    "tags": "",
    "content": "",
    "create_date": "1970-07-01",
}

# Columns an insert of an already known key may change.
ARTICLE_UPDATE = ["create_date"]
ARTICLE_SYNC_UPDATE = ["fav_nums"]
JOB_UPDATE = ["salary", "job_desc"]
