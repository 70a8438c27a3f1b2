"""Queries through the file readers: tables are rendered as export files, then read back.

The number of rows in one rendered file is bounded by its key, whatever the
size of the table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as K
from ..config import Settings
from ..operators import demographics, maintenance, posts, reports, rollups
from ..session import scratch, written
from ..sources import mail
from ..sources.csv_files import posts_from_csv_folder, read_csv_folder
from ..sources.files import decode_chunks, file_route, line_breaks_in_cells, read_large_csv
from ..sources.snapshots import read_snapshots, snapshot_metrics, snapshot_posts
from ..sources.tables import PageTables
from ..streaming.folder import start_batches, stream_files
from . import ingest
from . import sqltext as q
from .adapters import activity, as_binary, as_csv_files, hourly_export, hourly_posts, quoted, split_events
from .queries_tables import _KIND, _fold_sql, _rollup_sql, _shown, HOURLY, MERGE_MAX_SQL, NOW
from .queries_values import by_turn, turn_sql
from .registry import query, table
from .workbooks import archive_bytes, workbook_bytes

# --- posts out of CSV --------------------------------------------------------------------
_DOC_URL = turn_sql(
    "doc_id", "'https://page.example.com/urn:li:activity:' || doc_id", "'https://page.example.com/pulse/' || doc_id",
    "''", "'https://page.example.com/' || doc_id || '.png'",
)
_DOC_TYPES = ["Video", "Article", "", "Text", "Organic"]
_DOC_KIND = turn_sql("doc_id", *[f"'{t}'" for t in _DOC_TYPES])
_DOC_DAY = "DATE '2024-01-01' + CAST(doc_id % 28 AS INT)"


def _document_export(documents: DataFrame, *keep: str) -> DataFrame:
    """Whole texts as post titles, with metrics in several spellings."""
    key, size = F.col("doc_id"), F.col("n_chars")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int"))
    return documents.select(
        F.col("text").alias(" Post title "),
        by_turn(
            key,
            F.concat(F.lit("https://page.example.com/urn:li:activity:"), key.cast("string")),
            F.concat(F.lit("https://page.example.com/pulse/"), key.cast("string")),
            F.lit(""),
            F.concat(F.lit("https://page.example.com/"), key.cast("string"), F.lit(".png")),
        ).alias("Post link"),
        by_turn(key, *[F.lit(t) for t in _DOC_TYPES]).alias("Content Type"),
        F.date_format(day, "MMM d, yyyy").alias("Created date"),
        F.when(key % 6 == 0, "").otherwise(F.format_number(size, 0)).alias("Impressions"),
        (size + 1).cast("string").alias("Views"),
        (key % 50).cast("string").alias("Clicks"),
        F.when(key % 7 == 0, F.concat((key % 9).cast("string"), F.lit(".5%"))).alias("Click through rate (CTR)"),
        (key % 11).cast("string").alias("Likes"),
        (key % 5).cast("string").alias("Comments"),
        (key % 3).cast("string").alias("Reposts"),
        *keep,
    )


_DOC_POSTS = f"""WITH t AS (SELECT doc_id, n_chars, {q.strip('text')} AS title, {_DOC_URL} AS url, lower({_DOC_KIND}) AS word,
    {_DOC_DAY} AS day, CASE WHEN doc_id % 6 = 0 THEN n_chars + 1 ELSE CASE WHEN n_chars = 0 THEN 1 ELSE n_chars END END
      AS impressions, doc_id % 50 AS clicks, doc_id % 11 AS likes, doc_id % 5 AS comments, doc_id % 3 AS shares,
    CASE WHEN doc_id % 7 = 0 THEN (doc_id % 9) + 0.5 ELSE 0.0 END AS file_ctr FROM documents),
  u AS (SELECT *, lower(concat_ws(' ', title, url, title)) AS txt, CASE WHEN word = 'organic' THEN '' ELSE word END AS kind,
    coalesce(regexp_extract(url, '(urn:li:(?:activity|ugcPost):[0-9]+)', 1), '') AS urn FROM t WHERE title <> '')
  SELECT substr(md5(coalesce(nullif(urn, ''), nullif(url, ''), substr(title, 1, 100) || '|' || strftime(day, '%Y-%m-%d'))), 1, 16)
      AS post_id, md5(substr(title, 1, 2000)) AS content, md5(substr(title, 1, 500)) AS title,
    strftime(day, '%Y-%m-%d') AS post_date, impressions, clicks, likes, comments, shares, {q.engagement()} AS engagement_rate,
    CASE WHEN file_ctr > 0 THEN file_ctr ELSE {q.percent('clicks', 'impressions', 4)} END AS ctr,
    {q.post_type('kind', 'txt')} AS post_type, url AS post_url, {q.tags('title', '#')} AS hashtags,
    {q.tags('title', '@')} AS mentions FROM u"""


def _digested(records: DataFrame) -> DataFrame:
    def fingerprint(name: str):
        return F.md5(F.col(name).cast("binary"))

    return records.select(
        "post_id", fingerprint("post_content").alias("content"), fingerprint("post_title").alias("title"),
        F.date_format("post_date", "yyyy-MM-dd").alias("post_date"), "impressions", "clicks", "likes", "comments", "shares",
        "engagement_rate", "ctr", "post_type", "post_url",
        F.array_join("hashtags", " ").alias("hashtags"), F.array_join("mentions", " ").alias("mentions"),
    )


@query(_DOC_POSTS)
def export_records(spark: SparkSession, folder: str) -> DataFrame:
    """Export rows to the full post record, from a DataFrame."""
    return _digested(posts.posts_from_table(_document_export(table(spark, folder, "documents")), NOW, "all"))


@query(_DOC_POSTS)
def csv_exports(spark: SparkSession, folder: str) -> DataFrame:
    """The same through CSV files with quotes and line breaks inside cells."""
    documents = table(spark, folder, "documents")
    rows = _document_export(documents, "doc_id")
    files = as_csv_files(rows, F.format_string("posts-%06d.csv", F.floor(F.col("doc_id") / 200)), "doc_id")
    return _digested(posts.posts_from_chunks(decode_chunks(files), NOW))


def _csv_folder(spark: SparkSession, folder: str) -> str:
    """The export as text files of 1000 posts: every other one below two lines and with its columns turned round, and
    after each tenth post a row with too many cells."""
    rows = _document_export(table(spark, folder, "documents"), "doc_id")
    shown = [c for c in rows.columns if c != "doc_id"]
    number, key = F.floor(F.col("doc_id") / 1000), F.col("doc_id")
    turned = number % 2 == 1

    def line(values: list[Column]) -> Column:
        return F.when(turned, F.concat_ws(",", *values[::-1])).otherwise(F.concat_ws(",", *values))

    names = [F.lit(f'"{c}"') for c in shown]
    heads = rows.groupBy(number.alias("file")).agg(F.min("doc_id").alias("doc_id")).select(
        "file", F.lit(-1).cast("long").alias("n"),
        F.concat(F.when(turned, F.lit("Report of the page\n\n")).otherwise(""), line(names)).alias("value"),
    )
    body = line([quoted(F.col(f"`{c}`")) for c in shown])
    lines = rows.select(number.alias("file"), key.alias("n"), F.when(key % 10 == 3, F.concat(body, F.lit("\n"), body, F.lit(',"x","y"'))).otherwise(body).alias("value"))
    path = scratch(spark, "csv-folder")
    lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "n").select("file", "value").write.partitionBy("file").text(path)
    return path


@query(_DOC_POSTS)
def csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Files of two layouts, some with lines above the header, through Spark's CSV reader."""
    found = read_csv_folder(spark, _csv_folder(spark, folder), NOW)
    return _digested(posts_from_csv_folder(found, NOW))


@query("SELECT 'more cells than the header' AS reason, count(*) AS n FROM documents WHERE doc_id % 10 = 3")
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that no column can be told for, kept aside by a batch into the tables."""
    tables = PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=8))
    ingest.ingest_csv_folder(spark, _csv_folder(spark, folder), tables, NOW, "b1")
    return tables.read("rejected_rows").groupBy("reason").agg(F.count("*").alias("n"))


@query(
    """SELECT 'Café #é' || c_custkey || ', ' || c_name AS title, CAST(c_custkey AS BIGINT) AS impressions,
      ['utf-8', 'utf-16', 'cp1252', 'utf-8-sig'][1 + c_custkey // 300 % 4] AS encoding FROM customer"""
)
def encoded_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files in four encodings, found by reading their bytes."""
    key = F.col("c_custkey")
    customer = table(spark, folder, "customer").select(
        F.concat(F.lit("Café #é"), key.cast("string"), F.lit(", "), F.col("c_name")).alias("Post title"),
        key.alias("Impressions"), key.alias("n"),
    )
    number = F.floor(F.col("n") / 300)
    kinds = [("UTF-8", ""), ("UTF-16", ""), ("ISO-8859-1", ""), ("UTF-8", "\ufeff")]
    parts = [
        as_csv_files(customer.where(number % 4 == i), F.format_string("posts-%06d.csv", number), "n", charset, lead)
        for i, (charset, lead) in enumerate(kinds)
    ]
    files = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    chunks = decode_chunks(files)
    encodings = chunks.where("first_row = 0").select(F.col("file_name").alias("source_file"), "encoding")
    read = posts.posts_from_chunks(chunks, NOW).select("source_file", F.col("post_title").alias("title"), "impressions")
    return read.join(encodings, "source_file").drop("source_file")


# --- workbooks and archives --------------------------------------------------------------------
_ORDER_SQL = """SELECT substr(md5('https://page.example.com/' || o_orderkey), 1, 16) AS post_id,
    strftime(o_orderdate, '%Y-%m-%d %H:%M') AS post_date, CAST(trunc(o_totalprice) AS BIGINT) AS impressions,
    o_orderkey % 40 AS clicks, 'Order ' || o_orderkey || ' & more' AS title FROM orders"""


def _workbooks(orders: DataFrame) -> DataFrame:
    """Workbooks of at most 1000 orders: a notes sheet, then posts below a title line, with typed cells."""

    def render(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        body = [
            [f"Order {k} & more", f"https://page.example.com/{k}", d.to_pydatetime(), float(p), int(k % 40)]
            for k, d, p in zip(rows.o_orderkey, rows.o_orderdate, rows.o_totalprice)
        ]
        head = ["Post title", "Post link", "Created date", "Impressions", "Clicks"]
        sheets = [("Notes", [["nothing here"]]), ("All posts", [["Made for you"], head, *body])]
        content = workbook_bytes(sheets, inline=key[0] % 2 == 0)
        return pd.DataFrame({"file": [f"content_{key[0]:06d}.xlsx"], "content": [content]})

    numbered = orders.withColumn("n", F.floor(F.col("o_orderkey") / 1000))
    return as_binary(numbered.groupBy("n").applyInPandas(render, "file string, content binary"))


def _order_posts(records: DataFrame) -> DataFrame:
    return records.select(
        "post_id", F.date_format("post_date", "yyyy-MM-dd HH:mm").alias("post_date"), "impressions", "clicks",
        F.col("post_title").alias("title"),
    )


@query(_ORDER_SQL)
def xlsx_exports(spark: SparkSession, folder: str) -> DataFrame:
    """The posts sheet of workbooks: shared and inline strings, numbers, date cells, a line above the header."""
    return _order_posts(posts.posts_from_chunks(decode_chunks(_workbooks(table(spark, folder, "orders"))), NOW))


@query(_ORDER_SQL)
def zip_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Archives with several members; the one named like posts is read, here a workbook that is really CSV or one that is not."""

    def pack(batches):
        for files in batches:
            members = [
                archive_bytes({"readme.txt": "hello", "other.csv": "Title,Clicks\nwrong,1\n", "in/All_Posts.xlsx": c})
                for c in files.content
            ]
            yield pd.DataFrame({"file": [p.split("/")[-1].replace("xlsx", "zip") for p in files.path], "content": members})

    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    even = _workbooks(orders.where(F.floor(key / 1000) % 2 == 0))
    rows = orders.where(F.floor(key / 1000) % 2 == 1).select(
        F.concat(F.lit("Order "), key.cast("string"), F.lit(" & more")).alias("Title"),
        F.concat(F.lit("https://page.example.com/"), key.cast("string")).alias("URL"),
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm").alias("Published"),
        F.format_number(F.floor("o_totalprice"), 0).alias("Impressions"), (key % 40).alias("Link clicks"), key.alias("n"),
    )
    odd = as_csv_files(rows, F.format_string("content_%06d.xlsx", F.floor(F.col("n") / 1000)), "n")
    packed = as_binary(even.unionAll(odd).select("path", "content").mapInPandas(pack, "file string, content binary"))
    return _order_posts(posts.posts_from_chunks(decode_chunks(packed), NOW))


_SEGMENT_SHEETS = {
    "AUTOMOBILE": "Job seniority", "BUILDING": "Company industry", "FURNITURE": "Location",
    "HOUSEHOLD": "Seniority level", "MACHINERY": "My Sheet",
}


def _segment_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """One workbook per region, a sheet per segment with a row per nation."""
    nation = table(spark, folder, "nation")
    counted = table(spark, folder, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.count_if(F.col("c_acctbal") > 0).alias("n"), (F.count_if(F.col("c_acctbal") <= 0) * 7.5).alias("share")
    )
    rows = counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))

    def render(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sheets = []
        for segment, found in rows.sort_values(["c_mktsegment", "n_nationkey"]).groupby("c_mktsegment"):
            body = [[n, int(c), float(s)] for n, c, s in zip(found.n_name, found.n, found.share)]
            sheets.append((_SEGMENT_SHEETS[segment], [["Name", "Followers count", "%"], *body, [None, 5, 1]]))
        return pd.DataFrame({"file": [f"followers_{key[0]}.xlsx"], "content": [workbook_bytes(sheets)]})

    return as_binary(rows.groupBy("n_regionkey").applyInPandas(render, "file string, content binary"))


def _follower_sql(kind: str, keep: str) -> str:
    return f"""SELECT 'company' AS company_id, {kind} AS demographic_type, n_name AS demographic_value,
      CAST(count(*) FILTER (WHERE c_acctbal > 0) AS BIGINT) AS count,
      CAST(least(count(*) FILTER (WHERE c_acctbal <= 0) * 7.5, 100.0) AS DOUBLE) AS percentage
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name HAVING {keep}"""


@query(_follower_sql(_KIND, "true"))
def demographic_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets of workbooks to follower records."""
    records = demographics.demographics_from_chunks(decode_chunks(_segment_workbooks(spark, folder)), NOW)
    return records.select("company_id", "demographic_type", "demographic_value", "count", "percentage")


_OLDER = Settings(as_of=NOW.as_of, profile="manual")


@query(
    _follower_sql(
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'job_function' ELSE " + _KIND + " END",
        "count(*) FILTER (WHERE c_acctbal > 0) > 0",
    )
)
def older_demographics(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the older rules: other categories, a count is required."""
    records = demographics.demographics_from_chunks(decode_chunks(_segment_workbooks(spark, folder)), _OLDER)
    return records.select("company_id", "demographic_type", "demographic_value", "count", "percentage")


@query(
    f"""SELECT substr(md5(concat_ws('|', 'company', substr(t, 1, 100), strftime({_DOC_DAY}, '%Y-%m-%d'))), 1, 16) AS post_id,
      strftime({_DOC_DAY}, '%Y-%m-%d') AS post_date, CAST(CASE WHEN doc_id % 6 = 0 THEN 0 ELSE n_chars END AS BIGINT) AS impressions,
      doc_id % 50 AS clicks,
      CAST(CASE WHEN doc_id % 7 = 0 THEN doc_id % 9 + 0.5 ELSE 0 END AS DOUBLE) AS engagement_rate, {_DOC_KIND} AS post_type,
      md5(substr(t, 1, 2000)) AS content
    FROM (SELECT *, {q.strip('text')} AS t FROM documents)"""
)
def older_records(spark: SparkSession, folder: str) -> DataFrame:
    """Export rows by the older rules: ids from text and day, type and rate as the file has them.

    Their names for the rate fit the click-through column, so that is what is taken.
    """
    export = _document_export(table(spark, folder, "documents"))
    records = posts.posts_from_table(export, _OLDER, "all")
    return records.select(
        "post_id", F.date_format("post_date", "yyyy-MM-dd").alias("post_date"), "impressions", "clicks", "engagement_rate",
        "post_type", F.md5(F.col("post_content").cast("binary")).alias("content"),
    )


# --- mails ------------------------------------------------------------------------------------
@query(
    """SELECT 'm' || conv_id || '-' || turn AS name, CASE WHEN role = 'user' THEN 'Your Page: été' ELSE 'Content export' END AS subject,
      CASE WHEN role = 'user' THEN md5(replace(text, chr(13), ' ')) END AS body,
      CASE WHEN role <> 'user' THEN 'a_b-' || turn || '.csv' END AS attachment
    FROM conversations WHERE role <> 'system'"""
)
def mail_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Message files: encoded headers, a text body or an attached export; other senders are left out."""
    words = F.replace(F.col("text"), F.lit("\r"), F.lit(" "))
    sender = F.when(F.col("role") == "system", "x@mail.example").otherwise("Page <notify@linkedin.example>")
    plain = F.concat(
        F.lit("Subject: =?utf-8?q?Your_Page:_=C3=A9t=C3=A9?=\r\nFrom: "), sender,
        F.lit("\r\nMIME-Version: 1.0\r\nContent-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n"),
        F.base64(F.encode(words, "UTF-8")), F.lit("\r\n"),
    )
    attached = F.concat(
        F.lit("Subject: Content export\r\nFrom: "), sender,
        F.lit('\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="xyz"\r\n\r\n--xyz\r\n'
              "Content-Type: text/html; charset=utf-8\r\n\r\n<p>see below</p>\r\n--xyz\r\n"
              'Content-Type: text/csv\r\nContent-Disposition: attachment; filename="a/b-'),
        F.col("turn").cast("string"), F.lit('.csv"\r\n\r\nTitle,Clicks\r\nx,1\r\n--xyz--\r\n'),
    )
    files = table(spark, folder, "conversations").select(
        F.concat(F.lit("memory:/m"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("path"),
        F.encode(F.when(F.col("role") == "user", plain).otherwise(attached), "UTF-8").alias("content"),
    )
    messages = written(mail.decode_messages(files), "messages")  # two selections follow; a mail is parsed once
    name = F.regexp_extract("path", "memory:/(m[0-9-]+)", 1).alias("name")
    read = mail.digests(messages).select(
        name, "subject", F.md5(F.col("body").cast("binary")).alias("body"), F.lit(None).cast("string").alias("attachment")
    )
    saved = mail.attached_files(messages).select(
        name, F.lit("Content export").alias("subject"), F.lit(None).cast("string").alias("body"),
        F.element_at(F.split("path", "/"), -1).alias("attachment"),
    )
    return read.unionAll(saved)


# --- snapshots, large files, reports -------------------------------------------------------------
@query(
    f"""SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS posts, CAST(sum(impressions) AS BIGINT) AS impressions,
      CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS page_impressions
    FROM ({HOURLY}) GROUP BY day"""
)
def json_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Nested page snapshots, written as JSON and read back: page numbers beside the sum over posts."""
    rows = activity(table(spark, folder, "events"), F.col("user_id"), F.to_date("ts").alias("day"), F.hour("ts").alias("h"))
    post = F.struct(
        F.concat_ws("-", "user_id", "h").alias("post_id"), F.col("Impressions").alias("impressions"),
        F.col("Clicks").alias("clicks"), F.array(F.lit("#a")).alias("hashtags"),
    )
    # A snapshot holds the posts of at most 50 users in a day.
    pages = rows.groupBy("day", F.floor(F.col("user_id") / 50).alias("page")).agg(
        F.collect_list(post).alias("posts"), F.sum("Impressions").alias("i"), F.sum("Clicks").alias("c")
    )
    path = scratch(spark, "snapshots")
    pages.select(
        F.date_format("day", "yyyyMMdd_000000").alias("timestamp"),
        F.struct(F.col("i").alias("impressions"), F.col("c").alias("clicks")).alias("company_metrics"),
        "posts", F.size("posts").alias("total_posts"),
    ).write.json(path)
    snapshots = read_snapshots(spark, path, multiline=False)
    day = F.date_format("taken_at", "yyyy-MM-dd").alias("day")
    per_post = snapshot_posts(snapshots).groupBy(day).agg(
        F.count("*").alias("posts"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")
    )
    per_page = snapshot_metrics(snapshots).groupBy(day).agg(F.sum("impressions").alias("page_impressions"))
    return per_post.join(per_page, "day")


def _written_exports(spark: SparkSession, folder: str, label: str) -> str:
    """The hourly export as CSV files whose names and rows follow the days; a day of many users spans files."""
    export = hourly_export(table(spark, folder, "events"))
    path = scratch(spark, label)
    ordered = export.repartitionByRange("source_file", F.col("arrival.row")).sortWithinPartitions("source_file", "arrival")
    ordered.drop("source_file", "arrival").write.option("header", True).option("maxRecordsPerFile", 100_000).csv(path)
    return path


def _arrive_in_turn(spark: SparkSession, path: str) -> None:
    """Give files times in the order of their names: a stream takes files by their times, and tasks that write side by side
    end in any order, so exports of later days would arrive before those of earlier ones."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    found = [f for f in system.listStatus(place) if not f.getPath().getName().startswith(("_", "."))]
    places = {f.getPath().getName(): f.getPath() for f in found}
    last = max((f.getModificationTime() for f in found), default=0)
    for back, name in enumerate(sorted(places, reverse=True)):
        system.setTimes(places[name], last - 1000 * back, -1)


@query(_rollup_sql(4, ""))
def large_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV through Spark's splittable reader."""
    rows = read_large_csv(spark, _written_exports(spark, folder, "large"), multiline=False)
    return rollups.company_rollup(posts.posts_from_table(rows, NOW), ["company_id"])


@query("SELECT count(*) AS rows, max(CASE WHEN contains(text, chr(10)) THEN 1 ELSE 0 END) = 1 AS line_breaks_in_cells, true AS utf8 FROM documents")
def csv_layout_check(spark: SparkSession, folder: str) -> DataFrame:
    """Which reader large files need, found line by line in parallel."""
    path = scratch(spark, "layout")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    documents.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    checked = line_breaks_in_cells(spark, path).agg(
        F.bool_or("line_breaks_in_cells").alias("line_breaks_in_cells"), F.bool_and("utf8").alias("utf8")
    )
    rows = read_large_csv(spark, path, multiline=True).agg(F.count("*").alias("rows"))
    return rows.withColumns({c: checked.select(c).scalar() for c in ("line_breaks_in_cells", "utf8")})


@query(
    f"""SELECT strftime(day, '%Y-%m-%d') AS source_file, count(*) AS posts, CAST(sum(impressions) AS BIGINT) AS impressions,
      '["@user' || min(user_id) || '"]' AS mentions FROM ({HOURLY}) GROUP BY day"""
)
def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The audit CSV, one folder per source file, lists as JSON."""
    records = hourly_posts(table(spark, folder, "events"), NOW)
    path = maintenance.write_validation_report(records, scratch(spark, "validation"), "b1")
    read = spark.read.option("header", True).option("escape", "\\").csv(path)
    user = F.regexp_extract("mentions", "@user([0-9]+)", 1).cast("bigint")
    return read.groupBy(F.date_format("source_file", "yyyy-MM-dd").alias("source_file")).agg(
        F.count("*").alias("posts"), F.sum(F.col("impressions").cast("bigint")).alias("impressions"),
        F.min_by("mentions", user).alias("mentions"),
    )


# --- files: profile and ledger ----------------------------------------------------------------------
def _order_files(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    rows = orders.select(
        key.alias("n"), F.col("o_orderpriority").alias("Post title"), F.col("o_custkey").alias("Clicks")
    )
    return as_csv_files(rows, F.format_string("orders_%04d_followers.csv", F.floor(F.col("n") / 500)), "n")


_ORDER_FILES = "SELECT printf('orders_%04d_followers.csv', o_orderkey // 500) AS file_name, count(*) AS data_rows FROM orders GROUP BY 1"


@query(f"SELECT file_name, 'demographics' AS route, data_rows, 'Post title|Clicks' AS names FROM ({_ORDER_FILES})")
def file_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.file_profile(decode_chunks(_order_files(table(spark, folder, "orders"))), NOW)
    return found.select(
        "file_name", file_route(F.col("file_name")).alias("route"), "data_rows", F.array_join("names", "|").alias("names")
    )


@query(
    f"""SELECT file_name, data_rows + 1 AS rows, 'ok' AS status FROM ({_ORDER_FILES})
    WHERE file_name >= 'orders_0010_followers.csv'"""
)
def open_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files the ledger does not hold yet."""
    chunks = decode_chunks(_order_files(table(spark, folder, "orders")))
    ledger = maintenance.ledger_rows(chunks, NOW, "b1")
    done = ledger.where(F.col("file_name") < "orders_0010_followers.csv")
    return maintenance.unprocessed(ledger, done).select("file_name", "rows", "status")


# --- whole runs ----------------------------------------------------------------------------------------
def _hourly_files(events: DataFrame) -> DataFrame:
    """Posts exports of a day and at most 100 users each."""
    export = hourly_export(events)
    page = F.floor(F.col("arrival.row") / 2400)
    name = F.concat(F.lit("posts-"), "source_file", F.format_string("-%06d.csv", page))
    rows = export.select(*[F.col(f"`{c}`") for c in export.columns if c not in ("source_file", "arrival")], name.alias("f"),
                         F.col("arrival.row").alias("n"))
    return as_csv_files(rows, F.col("f"), "n", hide=("f",))


@query(MERGE_MAX_SQL)
def ingest_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of export files through decoding, records, staging and the keyed merge."""
    early, late = split_events(spark, folder)
    first = NOW.at(NOW.as_of.replace(month=1, day=16, hour=0))
    tables = PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=8))
    ingest.ingest_files(_hourly_files(early), tables, first, "b1")
    ingest.ingest_files(_hourly_files(late), tables, NOW, "b2")
    return _shown(tables.read("post_analytics"))


@query(
    f"""SELECT post_id, impressions, clicks, likes, comments, shares, impressions AS reach, ctr, engagement_rate,
      strftime(day, '%Y-%m-%d') AS post_date FROM ({_fold_sql(HOURLY)})"""
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a stream, some per batch, until all are in."""
    exports = _written_exports(spark, folder, "stream")
    _arrive_in_turn(spark, exports)
    tables = PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=8))
    files = stream_files(spark, exports, max_files=4)
    start_batches(
        files, lambda batch, n: ingest.ingest_files(batch, tables, NOW, f"stream-{n}"), scratch(spark, "offsets")
    ).awaitTermination()
    return _shown(tables.read("post_analytics")).drop("created", "updated")


_HALVES = """(SELECT user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'b1' ELSE 'b2' END AS batch FROM events)"""


def _user_files(events: DataFrame) -> DataFrame:
    """Posts exports with one post per user, at most 100 users a file."""
    key = F.col("user_id").cast("string")
    rows = activity(events, F.col("user_id"))
    metrics = [c for c in rows.columns if c != "user_id"]
    return as_csv_files(
        rows.select(
            F.concat(F.lit("Post of "), key).alias("Post title"),
            F.concat(F.lit("https://page.example.com/feed/update/urn:li:activity:"), key).alias("Post link"),
            F.lit("01/05/2024").alias("Created date"), *metrics, F.col("user_id").alias("n"),
            F.format_string("posts-%06d.csv", F.floor(F.col("user_id") / 100)).alias("f"),
        ),
        F.col("f"), "n", hide=("f",),
    )


@query(
    f"""WITH posts AS (SELECT batch, user_id, count(*) FILTER (WHERE event_type = 'view') AS seen FROM {_HALVES} GROUP BY ALL),
    files AS (SELECT batch, user_id // 100 AS file, count(*) AS n, sum(seen) AS seen FROM posts GROUP BY ALL)
    SELECT 'history' AS name, CASE batch WHEN 'b1' THEN '2024-01-16' ELSE '2024-02-01' END AS part, count(*) AS n,
      CAST(sum(seen) AS BIGINT) AS total FROM posts GROUP BY batch
    UNION ALL SELECT 'ledger', batch, count(*), CAST(sum(n + 1) AS BIGINT) FROM files GROUP BY batch
    UNION ALL SELECT 'summaries', batch, count(*), CAST(sum(seen) AS BIGINT) FROM files GROUP BY batch
    UNION ALL SELECT 'summaries', 'd1', count(*), CAST(sum(c_custkey + 6) AS BIGINT) FROM customer
    UNION ALL SELECT 'company', 'company', 1, max(c_custkey) + 6 FROM customer
    UNION ALL SELECT 'posts', 'kept', count(DISTINCT user_id), 0 FROM posts WHERE batch = 'b2'
      AND user_id NOT IN (SELECT user_id FROM posts WHERE batch = 'b1') HAVING count(DISTINCT user_id) > 0"""
)
def stored_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All stored tables after two batches, each given twice, digests under a used id, and a clean-up."""
    early, late = split_events(spark, folder)
    first = NOW.at(NOW.as_of.replace(month=1, day=16, hour=0))
    tables = PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=4))
    for _ in range(2):
        ingest.ingest_files(_user_files(early), tables, first, "b1")
        ingest.ingest_files(_user_files(late), tables, NOW, "b2")
    mails = table(spark, folder, "customer").select(
        F.format_string("m%012d", "c_custkey").alias("path"),
        F.concat((F.col("c_custkey") + 6).cast("string"), F.lit(" impressions, 7 followers")).alias("body"),
    )
    ingest.ingest_digests(mails, tables, NOW, "b1")
    ingest.clean_up(tables, NOW, "b1", days=10)

    def told(rows: DataFrame, name: str, part: Column, total: Column) -> DataFrame:
        return rows.groupBy(part.cast("string").alias("part")).agg(
            F.count("*").alias("n"), F.sum(total).cast("long").alias("total")
        ).select(F.lit(name).alias("name"), "part", "n", "total")

    summaries = tables.read("analytics_history")
    from_mails = F.col("followers_count") == 7
    return (
        told(tables.read("post_metrics_history"), "history", F.col("observed_date"), F.col("impressions"))
        .unionByName(told(tables.read("file_ledger"), "ledger", F.col("batch_id"), F.col("rows")))
        .unionByName(told(summaries, "summaries", F.when(from_mails, "d1").otherwise(F.col("batch_id")),
                          F.col("impressions")))
        .unionByName(told(tables.read("company_analytics"), "company", F.col("company_id"), F.col("impressions")))
        .unionByName(told(tables.read("post_analytics"), "posts", F.lit("kept"), F.lit(0)))
    )


# --- changes, versions and upkeep of the stored tables ---------------------------------------------------
_SHOWN_FOLD = f"""SELECT post_id, impressions, clicks, likes, comments, shares, impressions AS reach, ctr, engagement_rate,
      strftime(day, '%Y-%m-%d') AS post_date FROM ({_fold_sql(HOURLY)})"""


def _stored_batch(tables: PageTables, key: str, rows: DataFrame, settings: Settings = NOW) -> None:
    """Posts of a DataFrame as one batch of changes."""
    tables.begin(key, lambda: key)
    ingest.store_posts(tables, key, key, rows, settings)
    tables.finish(key)


def _thirds(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The days up to the 9th, those up to the 19th, and the rest."""
    posted = written(hourly_posts(table(spark, folder, "events"), NOW), "hourly-posts")  # each third is read several times
    day = F.dayofmonth("post_date")
    return [posted.where(day < 10), posted.where(day.between(10, 19)), posted.where(day > 19)]


@query(f"SELECT s.state, f.* FROM ({_SHOWN_FOLD}) f CROSS JOIN (VALUES ('changes'), ('base'), ('both')) s(state)")
def change_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches read as changes alone, as the base they were folded into, and as a base with later changes."""
    thirds = _thirds(spark, folder)
    one, two = (PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=8)) for _ in range(2))
    for n, part in enumerate(thirds):
        _stored_batch(one, f"b/{n}", part)
        _stored_batch(two, f"b/{n}", part)
        if n == 1:
            two.compact("first")
    changes, both = one.read("post_analytics"), two.read("post_analytics")
    one.compact("all")
    states = {"changes": changes, "base": one.read("post_analytics"), "both": both}
    shown = [_shown(rows).drop("created", "updated").withColumn("state", F.lit(name)) for name, rows in states.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query(_SHOWN_FOLD)
def exports_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """The latest export wins, though it arrives first."""
    settings = Settings(as_of=NOW.as_of, by_export_time=True, key_buckets=8)
    tables = PageTables(spark, scratch(spark, "tables"), settings)
    for n, part in reversed(list(enumerate(_thirds(spark, folder)))):
        exported = F.timestamp_seconds(F.lit(1_704_067_200 + 864_000 * n))
        _stored_batch(tables, f"b/{n}", part.withColumn("arrival", F.struct(exported.alias("exported_at"), "arrival.*")), settings)
    return _shown(tables.read("post_analytics")).drop("created", "updated")
