"""Reports, quality checks and ordered listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings
from ..functions import dates
from ..functions.strings import strip
from . import cells, columns, headers
from .posts import is_posts_sheet


# --- listings -------------------------------------------------------------------------
def report_text(content: Column) -> Column:
    return F.concat(F.substring(content, 1, K.REPORT_TEXT_LENGTH), F.lit("..."))


def top_post(posts: DataFrame) -> DataFrame:
    """The post with the most impressions."""
    return (
        posts.orderBy(F.desc("impressions"), "post_id").limit(1)
        .select("post_id", report_text(F.col("post_content")).alias("content"), "impressions", "engagement_rate")
    )


def latest_posts(posts: DataFrame, n: int = 20) -> DataFrame:
    return posts.orderBy(F.desc("created_at"), "post_id").limit(n).select(
        "post_id", "post_date", "post_type", "impressions", "clicks", "likes", "comments", "shares", "ctr",
        "engagement_rate",
    )


def latest_demographics(followers: DataFrame, n: int = 50) -> DataFrame:
    return followers.orderBy(F.desc("date_collected"), "demographic_type", "demographic_value").limit(n).select(
        "demographic_type", "demographic_value", "count", "percentage", "date_collected"
    )


# --- checks -----------------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def freshness(table: DataFrame, settings: Settings) -> DataFrame:
    """The newest row and its age in days."""
    return table.agg(F.max("date_collected").alias("last_update")).select(
        "last_update", F.datediff(settings.today, F.to_date("last_update")).alias("age_days")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionAll(other)
    return result


# --- summary ---------------------------------------------------------------------------
def summary_report(
    posts: DataFrame, followers: DataFrame, company: DataFrame, ledger: DataFrame | None, settings: Settings,
    company_only: bool = False,
) -> DataFrame:
    """The one-row report. Posts are read once for all their numbers; the rest are scalar subqueries."""
    mine = F.col("company_id") == settings.company_id
    if company_only:
        posts = posts.where(mine)
    since = settings.now - F.make_dt_interval(F.lit(30))
    newest = company.where(mine).agg(
        F.max_by(
            F.struct("followers_count", "impressions", "avg_post_engagement"),
            F.struct("date_collected", "followers_count"),
        ).alias("c")
    )
    segments = followers.where(mine).agg(F.countDistinct("demographic_type"))
    files = F.lit(None).cast("timestamp")
    if ledger is not None:
        files = ledger.where(F.col("status") == "ok").agg(F.max("mtime")).scalar()
    best = F.min_by(
        F.struct("post_content", "impressions", "engagement_rate"), F.struct(-F.col("impressions"), F.col("post_id"))
    )
    numbers = posts.agg(
        F.count("*").alias("total_posts"),
        F.count_if(F.col("post_date") >= since).alias("posts_last_30_days"),
        best.alias("best"),
    ).withColumn("c", newest.scalar())
    return numbers.select(
        F.lit(settings.company_name).alias("company_name"),
        F.lit(settings.company_id).alias("company_id"),
        settings.now.alias("report_generated"),
        F.struct(
            F.coalesce("c.followers_count", F.lit(0)).alias("current_count"),
            segments.scalar().alias("demographic_segments"),
        ).alias("followers"),
        F.struct(
            "total_posts",
            "posts_last_30_days",
            F.coalesce("c.impressions", F.lit(0)).alias("total_impressions"),
            F.coalesce("c.avg_post_engagement", F.lit(0.0)).alias("avg_engagement_rate"),
        ).alias("content"),
        F.struct(
            F.coalesce(report_text(F.col("best.post_content")), F.lit("None")).alias("content"),
            F.coalesce("best.impressions", F.lit(0)).alias("impressions"),
            F.coalesce("best.engagement_rate", F.lit(0.0)).alias("engagement_rate"),
        ).alias("top_performing_post"),
        F.lit("Active").alias("data_collection_status"),
        files.alias("last_file_processed"),
    )


# --- ambiguous dates ----------------------------------------------------------------------
def ambiguous_dates(rows: DataFrame, raw: Column, campaign: Column, settings: Settings, url: Column) -> DataFrame:
    """Dates readable as day/month and as month/day, with both readings and the likelier one."""
    text, start = F.col("raw_created"), F.col("campaign_start")
    parts = rows.select(url.alias("post_url"), raw.alias("raw_created"), campaign.alias("campaign_start")).where(
        dates.is_ambiguous(text)
    )
    day, shift = dates.split_clock(strip(text))
    parts = parts.withColumns({"day": day, "shift": shift})
    readings = F.struct(*[
        dates.join_clock(dates.parse_day(F.col("day"), day_first), F.col("shift")).alias(name)
        for name, day_first in (("dmy", True), ("mdy", False))
    ])
    # A generator, so that the filter is not moved below it, where it would parse every date again.
    readings = parts.select("post_url", "raw_created", F.inline(F.array(readings)), "campaign_start").where(
        F.col("dmy").isNotNull() & F.col("mdy").isNotNull()
    )
    first = F.make_timestamp(*[F.lit(v) for v in (K.PLAUSIBLE_FIRST_YEAR, 1, 1, 0, 0, 0)])
    last = F.make_timestamp(*[F.lit(v) for v in (settings.as_of.year + 1, 12, 31, 0, 0, 0)])
    chosen = dates.choose_order(F.col("dmy"), F.col("mdy"), start, first, last)
    return readings.withColumn("chosen", chosen)


def ambiguous_dates_from_chunks(chunks: DataFrame, settings: Settings) -> DataFrame:
    """The same for decoded files; cells that already hold a date are not ambiguous."""
    wanted = {k: K.POST_COLUMNS[k] for k in ("link", "created", "campaign_start")}
    sheet = headers.with_header(chunks.where(is_posts_sheet()), settings)
    rows = headers.sheet_rows(
        sheet, *[columns.position_of(F.col("keys"), c).alias(f"at_{l}") for l, c in wanted.items()]
    )
    cell = {l: F.get(F.col("cells"), F.col(f"at_{l}")) for l in wanted}
    text = F.when(cell["created"]["ts"].isNull(), cell["created"]["s"])
    start = F.coalesce(cell["campaign_start"]["ts"], dates.parse_date(cell["campaign_start"]["s"], day_first=True))
    return ambiguous_dates(rows, text, start, settings, cells.as_text(cell["link"]))


# --- file profile --------------------------------------------------------------------------
def file_profile(chunks: DataFrame, settings: Settings) -> DataFrame:
    """Per file and sheet: route, size, columns, number of data rows and the first three of them."""
    first = chunks.where(F.col("first_row") == 0)
    sheets = headers.with_header(first, settings)
    below = F.slice(F.slice("head", F.col("header_row") + 2, F.lit(K.HEADER_SEARCH_ROWS)), 1, 3)
    return sheets.select(
        "path", "file_name", "kind", "encoding", "n_bytes", "sheet", "header_row", "names",
        (F.col("sheet_rows") - F.col("header_row") - 1).alias("data_rows"),
        F.transform(below, lambda r: F.transform(r, lambda c: c["s"])).alias("sample"),
    )
