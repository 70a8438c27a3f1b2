"""Schemas of the raw cells, the records and the target tables."""

from pyspark.sql import types as T

CELL = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])

# The rows of Spark's binaryFile source, which a stream has to be told.
FILE = "path string, modificationTime timestamp, length bigint, content binary"

# One row holds up to ``chunk_rows`` rows of one sheet, with what header detection needs.
CHUNK = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("sheets", T.ArrayType(T.StringType())),
    T.StructField("sheet", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("sheet_rows", T.LongType()),
    T.StructField("first_row", T.LongType()),
    T.StructField("head", T.ArrayType(T.ArrayType(CELL))),
    T.StructField("later", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(CELL))),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("attachments", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("content", T.BinaryType()),
    ]))),
])

_METRICS = "impressions bigint, clicks bigint, likes bigint, comments bigint, shares bigint, reach bigint"

POST_RECORD = (
    "post_id string, company_id string, post_content string, post_date timestamp, "
    f"{_METRICS}, engagement_rate double, ctr double, post_type string, post_url string, "
    "post_title string, hashtags array<string>, mentions array<string>"
)
TABLES = {
    "post_analytics": POST_RECORD + ", date_collected timestamp, created_at timestamp, updated_at timestamp",
    "post_metrics_history": (
        "company_id string, post_id string, observed_at timestamp, observed_date date, "
        f"post_date timestamp, {_METRICS}, ctr double, engagement_rate double"
    ),
    "follower_analytics": (
        "company_id string, date_collected timestamp, total_followers bigint, new_followers bigint, "
        "demographic_type string, demographic_value string, count bigint, percentage double"
    ),
    "company_analytics": (
        "company_id string, company_name string, followers_count bigint, impressions bigint, "
        "unique_impressions bigint, clicks bigint, engagement_rate double, reach bigint, "
        "total_posts bigint, avg_post_engagement double, date_collected timestamp"
    ),
    "analytics_history": (
        "company_id string, company_name string, followers_count bigint, impressions bigint, "
        "unique_impressions bigint, clicks bigint, engagement_rate double, reach bigint, "
        "total_posts bigint, avg_post_engagement double, date_collected timestamp, batch_id string"
    ),
    "file_ledger": (
        "path string, file_name string, mtime timestamp, n_bytes bigint, kind string, "
        "rows bigint, status string, error string, batch_id string, processed_at timestamp"
    ),
    "rejected_rows": "path string, record string, reason string, batch_id string",
}
SNAPSHOT = (
    "timestamp string, total_posts bigint, "
    "company_metrics struct<followers_count:bigint,total_posts:bigint,engagement_rate:double,"
    "impressions:bigint,clicks:bigint,reach:bigint>, "
    "posts array<struct<post_id:string,content:string,post_date:string,impressions:bigint,clicks:bigint,"
    "likes:bigint,comments:bigint,shares:bigint,engagement_rate:double,reach:bigint,post_type:string,"
    "post_url:string,hashtags:array<string>,mentions:array<string>,media_type:string>>"
)
