"""Queries over whole runs into the stored tables: both profiles, filters, reports, watched folders."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..operators import maintenance, posts
from ..session import scratch
from ..sources.tables import PageTables
from ..streaming.folder import watch_folder
from ..streaming.mails import watch_mails
from . import ingest
from .adapters import as_csv_files, hourly_export, hourly_posts, split_events
from .queries_files import _SHOWN_FOLD, _written_exports
from .queries_tables import HOURLY, NOW, _shown
from .queries_values import ambiguous_dates
from .registry import SQL, query, table

OLDER = Settings(as_of=NOW.as_of, profile="manual")


def _stored(spark: SparkSession, settings: Settings = NOW) -> PageTables:
    return PageTables(spark, scratch(spark, "tables"), Settings(key_buckets=8, policy=settings.policy, profile=settings.profile))


def _posts_batch(tables: PageTables, key: str, rows: DataFrame, settings: Settings) -> None:
    tables.begin(key, lambda: key)
    staged, _ = tables.stage(key, "posts", lambda: rows)
    ingest.store_posts(tables, key, key, staged, settings)
    tables.finish(key)


def _followers_batch(tables: PageTables, key: str, rows: DataFrame, settings: Settings) -> None:
    tables.begin(key, lambda: key)
    ingest.store_demographics(tables, key, rows, settings)
    tables.finish(key)


# --- the older profile ---------------------------------------------------------------------
_OLD_DAY = "DATE '2024-01-13' + CAST(doc_id % 15 AS INT)"


@query(
    f"""SELECT 'https://page.example.com/' || doc_id AS post_url, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Doc ' || doc_id END AS content,
      CASE WHEN doc_id % 3 <> 0 THEN strftime({_OLD_DAY}, '%Y-%m-%d') END AS post_date
    FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 3 <> 0"""
)
def older_undated(spark: SparkSession, folder: str) -> DataFrame:
    """Older rules: dates in six spellings; rows with neither text nor date are no posts."""
    key = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-13").cast("date"), (key % 15).cast("int"))
    shapes = ["yyyy-MM-dd", "MM/dd/yyyy", "dd MMM yyyy", "MMM d, yyyy", "yyyy/MM/dd", "MMMM d, yyyy"]
    spelled = F.coalesce(*[F.when(F.floor(key / 3) % len(shapes) == i, F.date_format(day, s)) for i, s in enumerate(shapes)])
    export = table(spark, folder, "documents").select(
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("Doc "), key.cast("string"))).alias("Update"),
        F.concat(F.lit("https://page.example.com/"), key.cast("string")).alias("URL"),
        F.when(key % 3 != 0, spelled).alias("Date"), F.lit("1").alias("Impressions"),
    )
    found = posts.posts_from_table(export, OLDER, "all")
    return found.select("post_url", F.col("post_content").alias("content"), F.date_format("post_date", "yyyy-MM-dd").alias("post_date"))


@query(
    f"""SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS posts, CAST(sum(impressions) AS BIGINT) AS impressions,
      CASE WHEN day < DATE '2024-01-16' THEN '2024-01-16' ELSE '2024-02-01' END AS collected
    FROM ({HOURLY}) GROUP BY day"""
)
def older_posts_run(spark: SparkSession, folder: str) -> DataFrame:
    """Older rules into the tables: what is stored stays, though it comes again with other numbers."""
    events = table(spark, folder, "events")
    early, _ = split_events(spark, folder)
    tables, first = _stored(spark, OLDER), OLDER.at(NOW.as_of.replace(month=1, day=16, hour=0))
    _posts_batch(tables, "b/1", posts.posts_from_table(hourly_export(early), first), first)
    again = posts.posts_from_table(hourly_export(events), OLDER).withColumn(
        "impressions", F.when(F.col("post_date") < "2024-01-16", -1).otherwise(F.col("impressions"))
    )
    _posts_batch(tables, "b/2", again, OLDER)
    return tables.read("post_analytics").groupBy(
        F.date_format("post_date", "yyyy-MM-dd").alias("day"), F.date_format("date_collected", "yyyy-MM-dd").alias("collected")
    ).agg(F.count("*").alias("posts"), F.sum("impressions").alias("impressions"))


def _customer_followers(spark: SparkSession, folder: str, settings: Settings, count: Column) -> DataFrame:
    """A follower record per customer."""
    return table(spark, folder, "customer").select(
        F.lit("company").alias("company_id"), settings.now.alias("date_collected"), F.lit(1000).cast("long").alias("total_followers"),
        F.lit(0).cast("long").alias("new_followers"), F.lit("location").alias("demographic_type"),
        F.col("c_name").alias("demographic_value"), count.cast("long").alias("count"), F.lit(0.0).alias("percentage"),
        F.lit("f").alias("source_file"), F.struct(F.col("c_custkey").alias("row")).alias("arrival"), F.col("c_custkey").alias("key"),
    )


@query(
    """SELECT c_name AS demographic_value, '2024-02-01' AS day, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS count FROM customer
    UNION ALL SELECT c_name, '2024-02-02', 3 FROM customer"""
)
def older_followers_run(spark: SparkSession, folder: str) -> DataFrame:
    """Older rules: a value counts as stored when its day matches, whatever the hour."""
    tables = _stored(spark, OLDER)
    for n, (hours, keep) in enumerate([(0, F.col("key") % 2 == 0), (3, F.lit(True)), (25, F.lit(True))], 1):
        settings = OLDER.at(NOW.as_of + timedelta(hours=hours))
        rows = _customer_followers(spark, folder, settings, F.lit(n)).where(keep).drop("key")
        _followers_batch(tables, f"b/{n}", rows, settings)
    stored = tables.read("follower_analytics")
    return stored.select("demographic_value", F.date_format("date_collected", "yyyy-MM-dd").alias("day"), "count")


# --- the current profile -----------------------------------------------------------------------
@query(
    """SELECT c_name AS demographic_value, CAST(CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE 1 END AS BIGINT) AS count, 'stored' AS state FROM customer
    UNION ALL SELECT c_name, CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE 1 END, 'compacted' FROM customer"""
)
def followers_run(spark: SparkSession, folder: str) -> DataFrame:
    """The last record of a value and time wins, within a batch and between batches."""
    tables = _stored(spark)
    first = _customer_followers(spark, folder, NOW, F.lit(1))
    again = first.where("key % 2 = 0")
    last = again.withColumns({"count": F.lit(5).cast("long"), "arrival": F.struct((F.col("key") + 1).alias("row"))})
    _followers_batch(tables, "b/1", first.drop("key"), NOW)
    _followers_batch(tables, "b/2", last.unionByName(again.withColumn("count", F.lit(4).cast("long"))).drop("key"), NOW)
    stored = tables.read("follower_analytics")
    tables.compact("k")
    states = {"stored": stored, "compacted": tables.read("follower_analytics")}
    shown = [rows.select("demographic_value", "count", F.lit(name).alias("state")) for name, rows in states.items()]
    return shown[0].unionByName(shown[1])


@query(
    """SELECT 'Place ' || c_custkey AS demographic_value, CAST(c_custkey AS BIGINT) AS count, 'followers-' || lpad(CAST(c_custkey // 500 AS VARCHAR), 6, '0') || '.csv' AS file_name
    FROM customer WHERE c_custkey > 0"""
)
def demographics_run(spark: SparkSession, folder: str) -> DataFrame:
    """Follower files through decoding, roles, records and the tables; the ledger names each file."""
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        F.concat(F.lit("Place "), key.cast("string")).alias("Location"), key.alias("Members"), key.alias("n")
    )
    files = as_csv_files(rows, F.format_string("followers-%06d.csv", F.floor(F.col("n") / 500)), "n")
    tables = _stored(spark)
    ingest.ingest_files(files, tables, NOW, "b1")
    ledger = tables.read("file_ledger").where("status = 'ok'").select("file_name")
    number = F.format_string("followers-%06d.csv", F.floor(F.col("count") / 500))
    stored = tables.read("follower_analytics").select("demographic_value", "count", number.alias("file_name"))
    return stored.join(ledger, "file_name").select("demographic_value", "count", "file_name")


@query(
    f"""SELECT 'p' || o_orderkey AS post_id, CASE WHEN o_orderkey % 4 = 3 THEN 'Article' WHEN o_orderkey % 3 = 0 THEN 'video' ELSE 'text' END AS post_type,
      o_orderkey % 4 <> 3 AS changed, CAST(o_custkey AS BIGINT) AS impressions FROM orders"""
)
def reclassified_run(spark: SparkSession, folder: str) -> DataFrame:
    """Stored posts under a distribution word get a real type; their numbers and rates stay."""
    key = F.col("o_orderkey")
    given = F.when(key % 4 == 0, "Organic").when(key % 4 == 1, "sponsored").when(key % 4 == 2, "").otherwise("Article")
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("p"), key.cast("string")).alias("post_id"), F.lit("company").alias("company_id"),
        F.when(key % 3 == 0, "my video").otherwise("hello").alias("post_title"), F.lit("").alias("post_content"), F.lit("").alias("post_url"),
        given.alias("post_type"), F.col("o_custkey").cast("long").alias("impressions"),
    )
    tables = _stored(spark)
    tables.begin("b/1", lambda: "b")
    tables.change("post_analytics", "b/1", lambda: rows)
    tables.finish("b/1")
    ingest.reclassify_posts(tables, NOW, "r1")
    return tables.read("post_analytics").select("post_id", "post_type", F.col("updated_at").isNotNull().alias("changed"), "impressions")


@query(
    f"""WITH h AS (SELECT post_id, max(impressions) AS impressions, max(day) AS day, count(*) AS days FROM ({HOURLY}) GROUP BY post_id)
    SELECT 'company' AS filter, count(*) AS n FROM h UNION ALL SELECT 'other company', 0
    UNION ALL SELECT 'since', count(*) FROM h WHERE day >= DATE '2024-01-20'
    UNION ALL SELECT 'before', count(*) FROM h WHERE day < DATE '2024-01-20'
    UNION ALL SELECT 'ids', count(*) FROM h WHERE impressions > 1"""
)
def stored_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Stored posts by company, by key set and by date on either side."""
    tables = _stored(spark)
    _posts_batch(tables, "b/1", hourly_posts(table(spark, folder, "events"), NOW), NOW)
    stored = tables.read("post_analytics")
    wanted = stored.where("impressions > 1").select("post_id")
    filters = {
        "company": stored.where(F.col("company_id") == "company"), "other company": stored.where(F.col("company_id") == "other"),
        "since": stored.where(F.col("post_date") >= "2024-01-20"), "before": stored.where(F.col("post_date") < "2024-01-20"),
        "ids": stored.join(wanted, "post_id", "left_semi"),
    }
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("filter"), "n") for name, rows in filters.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query(f"SELECT post_url, raw_created, dmy, mdy, campaign_start, chosen FROM ({SQL['ambiguous_dates']})")
def date_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of ambiguous dates as CSV, read back."""
    path = maintenance.write_date_report(ambiguous_dates(spark, folder), scratch(spark, "dates"), "b1")
    return spark.read.option("header", True).csv(path)


@query(_SHOWN_FOLD)
def watched_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Finished downloads as they land: a polling stream that is stopped, and one that goes on where it was."""
    place, landing = _written_exports(spark, folder, "watched"), scratch(spark, "landing")
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().toString() for f in system.listStatus(files.Path(place)) if f.getPath().getName().startswith("part-"))
    system.mkdirs(files.Path(landing))
    tables, offsets = _stored(spark), scratch(spark, "offsets")

    def land(some: list[str], at: int) -> None:
        for n, part in enumerate(some, at):
            system.rename(files.Path(part), files.Path(f"{landing}/my_posts_{n:05d}.csv"))
            system.create(files.Path(f"{landing}/my_posts_{n:05d}.csv.crdownload"), True).close()

    half = len(parts) // 2
    land(parts[:half], 0)
    polling = watch_folder(spark, landing, tables, NOW, offsets, every="1 second", max_files=50, clock=lambda: NOW.as_of)
    polling.processAllAvailable()
    polling.stop()
    land(parts[half:], half)
    watch_folder(spark, landing, tables, NOW, offsets, max_files=50, clock=lambda: NOW.as_of).awaitTermination()
    return _shown(tables.read("post_analytics")).drop("created", "updated")


@query(
    """SELECT 'digests' AS kind, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS followers, CAST(sum(s_suppkey * 2) AS BIGINT) AS impressions
    FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT 'posts', count(*), 0, CAST(sum(s_suppkey) AS BIGINT) FROM supplier WHERE s_suppkey % 2 = 1
    UNION ALL SELECT 'files', count(*), 0, 0 FROM supplier WHERE s_suppkey % 2 = 1"""
)
def mail_run(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of mails into the tables: digests and attached exports, each once, though the stream is started twice."""
    key = F.col("s_suppkey").cast("string")
    lead = F.concat(F.lit("From: Updates <updates@linkedin.example>\nMIME-Version: 1.0\nSubject: "))
    digest = F.concat(
        lead, F.lit("Your page update\nContent-Type: text/plain\n\n"), key, F.lit(" followers and "),
        (F.col("s_suppkey") * 2).cast("string"), F.lit(" impressions\n"),
    )
    attached = F.concat(
        lead, F.lit('Content export\nContent-Type: multipart/mixed; boundary="b"\n\n--b\nContent-Type: text/plain\n\nsee file\n--b\n'),
        F.lit('Content-Type: text/csv\nContent-Disposition: attachment; filename="posts_'), key,
        F.lit('.csv"\n\nPost title,Post link,Impressions\nPost '), key, F.lit(",https://page.example.com/"), key, F.lit(","), key, F.lit("\n--b--\n"),
    )
    place, offsets, tables = scratch(spark, "mails"), scratch(spark, "offsets"), _stored(spark)
    mails = table(spark, folder, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, digest).otherwise(attached).alias("value"))
    # A file per mail: many tasks write them, and each puts its own in place (the driver would move them one by one).
    mails.repartition(8 * spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", 1).option(
        "mapreduce.fileoutputcommitter.algorithm.version", 2
    ).text(place)
    for _ in range(2):
        watch_mails(spark, place, tables, NOW, offsets, max_files=5000, clock=lambda: NOW.as_of).awaitTermination()
    none = F.lit(0).cast("long")
    told = [
        tables.read("analytics_history").where("total_posts = 0").agg(
            F.count("*").alias("n"), F.sum("followers_count").alias("followers"), F.sum("impressions").alias("impressions")
        ).select(F.lit("digests").alias("kind"), "n", "followers", "impressions"),
        tables.read("post_analytics").agg(F.count("*").alias("n"), none.alias("followers"), F.sum("impressions").alias("impressions")).select(
            F.lit("posts").alias("kind"), "n", "followers", "impressions"
        ),
        tables.read("file_ledger").where("status = 'ok'").agg(F.count("*").alias("n")).select(
            F.lit("files").alias("kind"), "n", none.alias("followers"), none.alias("impressions")
        ),
    ]
    return told[0].unionByName(told[1]).unionByName(told[2])
