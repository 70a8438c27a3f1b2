"""Roll-ups per file, per company, and the follower lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings


def exact_mean(rate: Column) -> Column:
    """Mean of rates with six decimals. Summed as decimals, so no order of rows changes it."""
    return F.sum(rate.cast("decimal(18,6)")).cast("double") / F.count("*")


def company_rollup(posts: DataFrame, by: list[str], scale: int = 4) -> DataFrame:
    """Totals and the unweighted mean rate of each group of posts.

    ``by`` is ``["company_id", "source_file"]`` for one summary per file, or
    ``["company_id"]`` for the whole table.
    """
    totals = posts.groupBy(*by).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.bround(exact_mean(F.col("engagement_rate")), scale).alias("engagement_rate"),
        F.count("*").alias("total_posts"),
    )
    return totals.select(
        *by,
        "impressions",
        F.col("impressions").alias("unique_impressions"),
        "clicks",
        "engagement_rate",
        F.col("impressions").alias("reach"),
        "total_posts",
        F.col("engagement_rate").alias("avg_post_engagement"),
    )


def summary_rows(rollup: DataFrame, settings: Settings, followers: DataFrame | None = None) -> DataFrame:
    """Company summaries: the roll-up with name, follower count and time."""
    unknown = F.lit(settings.unknown_followers).cast("bigint")
    if followers is None:
        rows = rollup.withColumn("followers_count", unknown)
    else:
        rows = rollup.join(followers, "company_id", "left").withColumn(
            "followers_count", F.coalesce("followers", unknown)
        ).drop("followers")
    return rows.withColumn("company_name", F.lit(settings.company_name)).withColumn("date_collected", settings.now)


def current_followers(followers: DataFrame, company: DataFrame, default: int = 0, newest: bool = False) -> DataFrame:
    """``(company_id, followers)``: the newest demographic total, else the newest summary count.

    Zero counts as unknown. ``newest`` prefers whichever source is younger.
    """
    demographic = followers.groupBy("company_id").agg(
        F.max_by("total_followers", F.struct("date_collected", "total_followers")).alias("a"),
        F.max("date_collected").alias("a_at"),
    )
    summary = company.groupBy("company_id").agg(
        F.max_by("followers_count", F.struct("date_collected", "followers_count")).alias("b"),
        F.max("date_collected").alias("b_at"),
    )
    a, b = F.nullif(F.col("a"), F.lit(0)), F.nullif(F.col("b"), F.lit(0))
    picked = F.coalesce(a, b)
    if newest:
        picked = F.when(F.col("b_at") > F.col("a_at"), F.coalesce(b, a)).otherwise(picked)
    return demographic.join(summary, "company_id", "full_outer").select(
        "company_id", F.coalesce(picked, F.lit(default)).cast("bigint").alias("followers")
    )


def post_counts(posts: DataFrame, settings: Settings, days: int = 30) -> DataFrame:
    """All posts, and those of the last days."""
    since = settings.now - F.make_dt_interval(F.lit(days))
    return posts.agg(
        F.count("*").alias("total_posts"),
        F.count_if(F.col("post_date") >= since).alias("recent_posts"),
    )


def demographic_segments(followers: DataFrame) -> DataFrame:
    return followers.groupBy("company_id").agg(F.countDistinct("demographic_type").alias("segments"))


def distinct_post_types(posts: DataFrame) -> DataFrame:
    return posts.select(F.lower("post_type").alias("post_type")).distinct()
