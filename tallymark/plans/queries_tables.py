"""Queries over records and tables: roll-ups, merges, history, lookups, reports, checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..config import Settings
from ..functions import numbers
from ..functions.digest import with_digest_numbers
from ..operators import demographics, maintenance, merge, reports, rollups
from . import sqltext as q
from .adapters import activity, hourly_posts, split_events
from .queries_values import DIGEST_SQL, _digest_body, by_turn, turn_sql
from .registry import query, table

NOW = Settings(as_of=datetime(2024, 2, 1, 12))
_FIRST = NOW.at(datetime(2024, 1, 16))

# The hourly posts of the adapter: one row per post and day, as SQL.
HOURLY = f"""SELECT *, 'https://page.example.com/feed/update/urn:li:activity:' || number AS url,
    substr(md5('urn:li:activity:' || number), 1, 16) AS post_id,
    {q.percent('clicks', 'impressions', 4)} AS ctr, {q.engagement()} AS engagement_rate
  FROM (SELECT user_id, hour(ts) AS h, CAST(ts AS DATE) AS day, user_id * 24 + hour(ts) AS number,
      count(*) FILTER (WHERE event_type = 'view') AS impressions, count(*) FILTER (WHERE event_type = 'click') AS clicks,
      count(*) FILTER (WHERE event_type = 'signup') AS likes, count(*) FILTER (WHERE event_type = 'error') AS comments,
      count(*) FILTER (WHERE event_type = 'purchase') AS shares
    FROM events GROUP BY ALL)"""
_METRIC_LIST = "impressions, clicks, likes, comments, shares"


# --- roll-ups and rates ------------------------------------------------------------------
def _rollup_sql(scale: int, by: str) -> str:
    mean = "round_even(CAST(sum(CAST(engagement_rate AS DECIMAL(18, 6))) AS DOUBLE) / count(*), %d)" % scale
    return f"""SELECT 'company' AS company_id{by}, CAST(sum(impressions) AS BIGINT) AS impressions,
      CAST(sum(impressions) AS BIGINT) AS unique_impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
      {mean} AS engagement_rate, CAST(sum(impressions) AS BIGINT) AS reach, count(*) AS total_posts,
      {mean} AS avg_post_engagement FROM ({HOURLY})"""


@query(_rollup_sql(4, ", strftime(day, '%Y-%m-%d') AS source_file") + " GROUP BY day")
def company_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: an event log read as exports, to post records, rolled up per file."""
    posts = hourly_posts(table(spark, folder, "events"), NOW)
    return rollups.company_rollup(posts, ["company_id", "source_file"])


@query(_rollup_sql(2, ""))
def table_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Over the whole table, rounded as the older rules do."""
    return rollups.company_rollup(hourly_posts(table(spark, folder, "events"), NOW), ["company_id"], scale=2)


@query(
    f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'view') AS impressions,
        count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'signup') AS likes,
        count(*) FILTER (WHERE event_type = 'error') AS comments, count(*) FILTER (WHERE event_type = 'purchase') AS shares
      FROM events GROUP BY ALL)
    SELECT user_id, strftime(day, '%Y-%m-%d') AS day, {q.percent('clicks', 'impressions', 4)} AS ctr,
      {q.percent('clicks', 'impressions', 6)} AS merged_ctr, {q.engagement()} AS engagement_rate FROM d"""
)
def post_rates(spark: SparkSession, folder: str) -> DataFrame:
    daily = activity(table(spark, folder, "events"), F.col("user_id"), F.to_date("ts").alias("day"))
    renamed = daily.withColumnRenamed("Reposts", "shares")
    fresh = numbers.recomputed_rates()
    return renamed.select(
        "user_id",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        numbers.compute_ctr(F.col("clicks"), F.col("impressions")).alias("ctr"),
        fresh["ctr"].alias("merged_ctr"),
        fresh["engagement_rate"].alias("engagement_rate"),
    )


# --- keyed merge ---------------------------------------------------------------------------
def _stored(posts: DataFrame) -> DataFrame:
    """Posts as the table holds them after one merge into nothing."""
    return (
        merge.fold_posts(posts).drop("arrival", "source_file", "date_missing")
        .withColumns({"date_collected": _FIRST.now, "created_at": _FIRST.now, "updated_at": F.lit(None).cast("timestamp")})
    )


def _fold_sql(source: str) -> str:
    """Per post id: highest metrics, the rest from the last day, rates again when days were folded."""
    return f"""SELECT post_id, max(impressions) AS impressions, max(clicks) AS clicks, max(likes) AS likes,
        max(comments) AS comments, max(shares) AS shares, max(day) AS day, any_value(url) AS url,
        CASE WHEN count(*) > 1 THEN {q.percent('max(clicks)', 'max(impressions)', 6)} ELSE max(ctr) END AS ctr,
        CASE WHEN count(*) > 1 THEN least({q.percent('max(likes) + max(comments) + max(shares) + max(clicks)',
            'max(impressions)', 6)}, 100.0) ELSE max(engagement_rate) END AS engagement_rate
      FROM ({source}) GROUP BY post_id"""


_EARLY = f"SELECT * FROM ({HOURLY}) WHERE day < DATE '2024-01-16'"
_LATE = f"SELECT * FROM ({HOURLY}) WHERE day >= DATE '2024-01-16'"
_LAST = "SELECT * FROM (%s) QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY day DESC) = 1" % _LATE


def _best(name: str) -> str:
    return f"greatest(coalesce(b.{name}, 0), coalesce(i.{name}, 0)) AS {name}"


_DB_SQL = """CASE WHEN b.post_id IS NULL THEN '2024-02-01 12:00' ELSE '2024-01-16 00:00' END AS created,
      CASE WHEN b.post_id IS NOT NULL AND i.post_id IS NOT NULL THEN '2024-02-01 12:00' END AS updated"""


def _shown(table_after: DataFrame) -> DataFrame:
    minute = "yyyy-MM-dd HH:mm"
    return table_after.select(
        "post_id", *K.METRICS, "ctr", "engagement_rate", F.date_format("post_date", "yyyy-MM-dd").alias("post_date"),
        F.date_format("created_at", minute).alias("created"), F.date_format("updated_at", minute).alias("updated"),
    )


MERGE_MAX_SQL = f"""WITH m AS (SELECT coalesce(b.post_id, i.post_id) AS post_id, {_best('impressions')}, {_best('clicks')}, {_best('likes')},
        {_best('comments')}, {_best('shares')}, coalesce(i.day, b.day) AS day,
        b.post_id IS NOT NULL AND i.post_id IS NOT NULL AS merged, coalesce(i.ctr, b.ctr) AS old_ctr,
        coalesce(i.engagement_rate, b.engagement_rate) AS old_er, {_DB_SQL}
      FROM ({_fold_sql(_EARLY)}) b FULL JOIN ({_fold_sql(_LATE)}) i ON b.post_id = i.post_id)
    SELECT post_id, {_METRIC_LIST}, impressions AS reach,
      CASE WHEN merged THEN {q.percent('clicks', 'impressions', 6)} ELSE old_ctr END AS ctr,
      CASE WHEN merged THEN {q.engagement()} ELSE old_er END AS engagement_rate,
      strftime(day, '%Y-%m-%d') AS post_date, created, updated FROM m"""


@query(MERGE_MAX_SQL)
def merge_max(spark: SparkSession, folder: str) -> DataFrame:
    """A later export never lowers a metric."""
    early, late = split_events(spark, folder)
    return _shown(merge.merge_posts(_stored(hourly_posts(early, NOW)), hourly_posts(late, NOW), NOW))


@query(
    f"""SELECT coalesce(b.post_id, i.post_id) AS post_id,
      {', '.join(f'CASE WHEN i.post_id IS NULL THEN b.{m} ELSE i.{m} END AS {m}' for m in _METRIC_LIST.split(', '))},
      CASE WHEN i.post_id IS NULL THEN b.impressions ELSE i.impressions END AS reach,
      coalesce(i.ctr, b.ctr) AS ctr, coalesce(i.engagement_rate, b.engagement_rate) AS engagement_rate,
      strftime(coalesce(i.day, b.day), '%Y-%m-%d') AS post_date, {_DB_SQL}
    FROM ({_fold_sql(_EARLY)}) b FULL JOIN ({_LAST}) i ON b.post_id = i.post_id"""
)
def merge_new(spark: SparkSession, folder: str) -> DataFrame:
    """The incoming row as it is."""
    early, late = split_events(spark, folder)
    newest = Settings(as_of=NOW.as_of, policy="new")
    return _shown(merge.merge_posts(_stored(hourly_posts(early, NOW)), hourly_posts(late, NOW), newest))


@query(
    f"""SELECT post_id, {_METRIC_LIST}, strftime(day, '%Y-%m-%d') AS post_date FROM ({_LATE}) i
    WHERE NOT EXISTS (SELECT 1 FROM ({_EARLY}) b WHERE b.post_id = i.post_id)
    QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY day) = 1"""
)
def insert_only(spark: SparkSession, folder: str) -> DataFrame:
    early, late = split_events(spark, folder)
    stored = _stored(hourly_posts(early, NOW))
    fresh = merge.insert_only(stored, hourly_posts(late, NOW), K.POST_KEY)
    day = F.date_format("post_date", "yyyy-MM-dd").alias("post_date")
    return fresh.select("post_id", "impressions", "clicks", "likes", "comments", "shares", day)


@query(
    f"""WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) // 12 AS run,
        count(*) FILTER (WHERE event_type = 'view') AS impressions, count(*) FILTER (WHERE event_type = 'click') AS clicks,
        count(*) FILTER (WHERE event_type = 'signup') AS likes, count(*) FILTER (WHERE event_type = 'error') AS comments,
        count(*) FILTER (WHERE event_type = 'purchase') AS shares
      FROM events GROUP BY ALL)
    SELECT 'company' AS company_id, CAST(user_id AS VARCHAR) AS post_id, strftime(day, '%Y-%m-%d') AS observed_date,
      {_METRIC_LIST}, impressions AS reach, {q.percent('clicks', 'impressions', 4)} AS ctr, {q.engagement()} AS engagement_rate
    FROM a QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY run DESC) = 1"""
)
def daily_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs a day; the second overwrites the snapshots of the first."""
    day, run = F.to_date("ts").alias("day"), F.floor(F.hour("ts") / 12).alias("run")
    rows = activity(table(spark, folder, "events"), F.col("user_id"), day, run).withColumnRenamed("Reposts", "shares")
    posts = rows.select(
        F.col("user_id").cast("string").alias("post_id"), F.col("day").cast("timestamp").alias("post_date"), "day", "run",
        "impressions", "clicks", "likes", "comments", "shares", F.col("impressions").alias("reach"),
        numbers.compute_ctr(F.col("clicks"), F.col("impressions")).alias("ctr"),
        numbers.recomputed_rates()["engagement_rate"].alias("engagement_rate"),
        F.struct("run").alias("arrival"),
    )
    first = merge.history_rows(posts.where("run = 0"), NOW, F.col("day"))
    second = merge.history_rows(posts.where("run = 1"), NOW, F.col("day"))
    return merge.upsert(first, second, K.HISTORY_KEY).drop("observed_at", "post_date").withColumn(
        "observed_date", F.date_format("observed_date", "yyyy-MM-dd")
    )


# --- followers -------------------------------------------------------------------------------
_SHEETS = {
    "AUTOMOBILE": ("Job seniority", "job_function"), "BUILDING": ("Company industry", "company_size"),
    "FURNITURE": ("Location", "location"), "HOUSEHOLD": ("Seniority level", "seniority"),
    "MACHINERY": ("My Sheet", "my_sheet"),
}
_KIND = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN '{k}'" for s, (_, k) in _SHEETS.items()) + " END"


def _segment_rows(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers per segment and nation, as demographic rows with a share of 7 each."""
    counted = customer.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count_if(F.col("c_acctbal") > 0).alias("Members"), F.count_if(F.col("c_acctbal") <= 0).alias("owing")
    )
    return counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("Name"), "Members", (F.col("owing") * 7.5).alias("Percent"), "c_mktsegment",
        F.lit("f").alias("source_file"), F.struct(F.col("n_nationkey").alias("row")).alias("arrival"),
    )


@query(
    f"""WITH s AS (SELECT {_KIND} AS demographic_type, n_name AS demographic_value,
        count(*) FILTER (WHERE c_acctbal > 0) AS n, count(*) FILTER (WHERE c_acctbal <= 0) * 7.5 AS share
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name),
    k AS (SELECT * FROM s WHERE n > 0 OR share > 0)
    SELECT 'company' AS company_id, demographic_type, demographic_value, '2024-02-01' AS day,
      CAST(CASE WHEN demographic_type IN ('location', 'seniority') THEN 900 ELSE 0 END AS BIGINT) AS total_followers,
      CASE WHEN demographic_type IN ('location', 'seniority') THEN n + 1 ELSE n END AS count,
      CAST(least(share, 100.0) AS DOUBLE) AS percentage FROM k"""
)
def followers_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Demographic sheets to records; two sheets arrive again on the same day and replace their rows."""
    rows = _segment_rows(table(spark, folder, "customer"), table(spark, folder, "nation"))
    sheet = F.coalesce(*[F.when(F.col("c_mktsegment") == s, F.lit(name)) for s, (name, _) in _SHEETS.items()])
    stored = demographics.demographics_from_table(rows.withColumn("sheet", sheet).drop("c_mktsegment"), F.col("sheet"), NOW)
    again = stored.where(F.col("demographic_type").isin("location", "seniority")).withColumns(
        {"total_followers": F.lit(900).cast("bigint"), "count": F.col("count") + 1}
    )
    # The first record of the day and its repetition arrive as one batch as well.
    batch = again.withColumn("arrival", F.struct(F.lit(1).alias("row"))).unionByName(
        again.withColumns({"count": F.lit(-1).cast("bigint"), "arrival": F.struct(F.lit(0).alias("row"))})
    )
    kept = stored.drop("arrival", "source_file")
    return merge.upsert(kept, batch.drop("source_file"), K.FOLLOWER_KEY, "arrival").select(
        "company_id", "demographic_type", "demographic_value", F.date_format("date_collected", "yyyy-MM-dd").alias("day"),
        "total_followers", "count", "percentage",
    )


@query(
    """WITH a AS (SELECT o_custkey AS company_id, arg_max(o_orderkey % 4, (o_orderdate, o_orderkey % 4)) AS v
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
      b AS (SELECT o_custkey AS company_id, arg_max(o_orderkey % 3, (o_orderdate, o_orderkey % 3)) AS v
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT coalesce(a.company_id, b.company_id) AS company_id,
      coalesce(nullif(a.v, 0), nullif(b.v, 0), 0) AS followers, coalesce(nullif(a.v, 0), nullif(b.v, 0), 1000) AS older
    FROM a FULL JOIN b ON a.company_id = b.company_id"""
)
def current_followers(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("company_id"), F.col("o_orderdate").alias("date_collected"), "o_orderstatus", "o_orderkey"
    )
    follower = orders.where("o_orderstatus = 'F'").withColumn("total_followers", F.col("o_orderkey") % 4)
    company = orders.where("o_orderstatus <> 'F'").withColumn("followers_count", F.col("o_orderkey") % 3)
    unknown = F.nullif(F.col("followers"), F.lit(-1))
    return rollups.current_followers(follower, company, default=-1).select(
        "company_id", F.coalesce(unknown, F.lit(0)).alias("followers"), F.coalesce(unknown, F.lit(1000)).alias("older")
    )


@query(
    f"""SELECT CAST(c_nationkey AS VARCHAR) AS company_id, arg_max(followers_count, c_custkey) AS followers_count,
      arg_max(impressions, c_custkey) AS impressions, CAST(0 AS BIGINT) AS clicks,
      CAST(0 AS BIGINT) AS total_posts FROM ({DIGEST_SQL}) GROUP BY c_nationkey"""
)
def digest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Digest mails into the company table; the last mail of a company stays."""
    key = F.col("c_custkey")
    messages = table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("string").alias("company_id"), key.alias("arrival"), _digest_body(key).alias("body")
    )
    parsed = with_digest_numbers(messages).drop("body")
    stored = parsed.drop("arrival").limit(0)
    after = merge.upsert(stored, parsed, K.COMPANY_KEY, "arrival")
    return after.select("company_id", "followers_count", "impressions", "clicks", "total_posts")


# --- maintenance -------------------------------------------------------------------------------
@query(
    """SELECT event_type, count(*) AS kept FROM events
    WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 15 DAY GROUP BY 1"""
)
def retention(spark: SparkSession, folder: str) -> DataFrame:
    """Fifteen days; rows without a date (here: errors) stay."""
    dated = table(spark, folder, "events").withColumn(
        "date_collected", F.when(F.col("event_type") != "error", F.col("ts"))
    )
    return maintenance.retained(dated, NOW, days=15).groupBy("event_type").agg(F.count("*").alias("kept"))


@query(
    """SELECT count(*) AS total_posts, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-07-02') AS recent_posts
    FROM orders"""
)
def recent_and_total(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "orders").select(F.col("o_orderdate").alias("post_date"))
    return rollups.post_counts(posts, Settings(as_of=datetime(2001, 8, 1)))


# --- listings -----------------------------------------------------------------------------------
@query("SELECT c_nationkey AS company_id, count(DISTINCT c_mktsegment) AS segments FROM customer GROUP BY 1")
def segments(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.demographic_segments(
        table(spark, folder, "customer").select(
            F.col("c_nationkey").alias("company_id"), F.col("c_mktsegment").alias("demographic_type")
        )
    )


@query("SELECT DISTINCT lower(p_type) AS post_type FROM part")
def distinct_types(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.distinct_post_types(table(spark, folder, "part").select(F.col("p_type").alias("post_type")))


_TOTALS = f"""SELECT user_id AS post_id, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(likes) AS likes,
    sum(comments) AS comments, sum(shares) AS shares, max(day) AS day FROM ({HOURLY}) GROUP BY user_id"""


def _user_posts(events: DataFrame) -> DataFrame:
    """One post per user, with all metrics of the month."""
    rows = events.groupBy("user_id").agg(
        F.max("ts").alias("created_at"),
        F.count_if(F.col("event_type") == "view").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "signup").alias("likes"),
        F.count_if(F.col("event_type") == "error").alias("comments"),
        F.count_if(F.col("event_type") == "purchase").alias("shares"),
    )
    fresh = numbers.recomputed_rates()
    return rows.select(
        F.col("user_id").alias("post_id"), "created_at", F.date_trunc("day", "created_at").alias("post_date"),
        F.lit("text").alias("post_type"), "impressions", "clicks", "likes", "comments", "shares",
        F.concat(F.lit("Update of user "), F.col("user_id").cast("string"), F.repeat(F.lit(" and more"), 20)).alias(
            "post_content"
        ),
        *[fresh[r].alias(r) for r in ("ctr", "engagement_rate")],
    )


@query(
    f"""SELECT post_id, substr('Update of user ' || post_id || repeat(' and more', 20), 1, 100) || '...' AS content,
      CAST(impressions AS BIGINT) AS impressions, {q.engagement()} AS engagement_rate
    FROM ({_TOTALS}) ORDER BY impressions DESC, post_id LIMIT 1"""
)
def top_post(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_post(_user_posts(table(spark, folder, "events")))


@query(
    f"""SELECT post_id, strftime(day, '%Y-%m-%d') AS post_date, CAST(impressions AS BIGINT) AS impressions,
      CAST(clicks AS BIGINT) AS clicks, {q.percent('clicks', 'impressions', 6)} AS ctr, {q.engagement()} AS engagement_rate
    FROM ({_TOTALS}) JOIN (SELECT user_id, max(ts) AS created_at FROM events GROUP BY 1) ON user_id = post_id
    ORDER BY created_at DESC, post_id LIMIT 20"""
)
def latest_posts(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.latest_posts(_user_posts(table(spark, folder, "events")))
    day = F.date_format("post_date", "yyyy-MM-dd").alias("post_date")
    return found.select("post_id", day, "impressions", "clicks", "ctr", "engagement_rate")


@query(
    """SELECT c_mktsegment AS demographic_type, n_name AS demographic_value, count(*) AS count,
      CAST(count(*) AS DOUBLE) AS percentage, strftime(DATE '2024-01-01' + CAST(n_regionkey AS INT), '%Y-%m-%d') AS day
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    ORDER BY day DESC, demographic_type, demographic_value LIMIT 50"""
)
def latest_demographics(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    counted = table(spark, folder, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("count"))
    followers = counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_mktsegment").alias("demographic_type"), F.col("n_name").alias("demographic_value"), "count",
        F.col("count").cast("double").alias("percentage"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_regionkey")).cast("timestamp").alias("date_collected"),
    )
    found = reports.latest_demographics(followers)
    return found.withColumn("day", F.date_format("date_collected", "yyyy-MM-dd")).drop("date_collected")


# --- checks and reports ------------------------------------------------------------------------------
@query("SELECT md5(text) AS post_id, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_posts(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "documents").select(F.md5(F.col("text").cast("binary")).alias("post_id"))
    return reports.duplicate_keys(posts, K.POST_KEY)


@query("SELECT user_id, CAST(ts AS DATE)::VARCHAR AS day, event_type, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_history(spark: SparkSession, folder: str) -> DataFrame:
    """The same check over a key of three columns."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return reports.duplicate_keys(
        table(spark, folder, "events").select("user_id", day, "event_type"), ["user_id", "day", "event_type"]
    )


@query(
    """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_update,
      CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-01') AS INT) AS age_days FROM events"""
)
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.freshness(table(spark, folder, "events").select(F.col("ts").alias("date_collected")), NOW)
    return found.withColumn("last_update", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss"))


@query(
    "SELECT 'customer' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'events', count(*) FROM events "
    "UNION ALL SELECT 'orders', count(*) FROM orders"
)
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.table_counts({n: table(spark, folder, n) for n in ("customer", "events", "orders")})


@query(
    f"""WITH t AS ({_TOTALS}),
      c AS (SELECT arg_max(c_custkey, (c_acctbal, c_custkey)) AS followers, max(c_acctbal) AS rate FROM customer)
    SELECT 'Company' AS company_name, (SELECT followers FROM c) AS current_count,
      (SELECT count(DISTINCT c_mktsegment) FROM customer) AS demographic_segments, (SELECT count(*) FROM t) AS total_posts,
      (SELECT count(*) FROM t WHERE day >= DATE '2024-01-30') AS posts_last_30_days,
      (SELECT CAST(followers * 3 AS BIGINT) FROM c) AS total_impressions, (SELECT rate FROM c) AS avg_engagement_rate,
      substr('Update of user ' || post_id || repeat(' and more', 20), 1, 100) || '...' AS top_content,
      CAST(impressions AS BIGINT) AS top_impressions, {q.engagement()} AS top_rate, 'Active' AS data_collection_status,
      (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders WHERE o_orderstatus = 'F') AS last_file
    FROM t ORDER BY impressions DESC, post_id LIMIT 1"""
)
def summary_report(spark: SparkSession, folder: str) -> DataFrame:
    settings = NOW.at(datetime(2024, 2, 29))
    customer = table(spark, folder, "customer")
    company = customer.select(
        F.lit("company").alias("company_id"), F.col("c_custkey").alias("followers_count"),
        (F.col("c_custkey") * 3).alias("impressions"), F.col("c_acctbal").alias("avg_post_engagement"),
        F.col("c_acctbal").alias("date_collected"),
    )
    followers = customer.select(F.lit("company").alias("company_id"), F.col("c_mktsegment").alias("demographic_type"))
    ledger = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("mtime"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("empty").alias("status")
    )
    report = reports.summary_report(_user_posts(table(spark, folder, "events")), followers, company, ledger, settings)
    return report.select(
        "company_name", "followers.*", "content.*",
        F.col("top_performing_post.content").alias("top_content"),
        F.col("top_performing_post.impressions").alias("top_impressions"),
        F.col("top_performing_post.engagement_rate").alias("top_rate"),
        "data_collection_status",
        F.date_format("last_file_processed", "yyyy-MM-dd").alias("last_file"),
    )
