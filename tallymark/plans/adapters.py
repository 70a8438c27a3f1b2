"""The test tables seen as page exports.

Events become the activity of posts: views are impressions, clicks are clicks,
signups are likes, errors are comments, purchases are shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..operators.posts import posts_from_table
from .registry import table

_METRIC_EVENTS = {
    "Impressions": "view", "Clicks": "click", "Likes": "signup", "Comments": "error", "Reposts": "purchase",
}


def activity(events: DataFrame, *by: Column) -> DataFrame:
    """Event counts as export columns, per group. One shuffle, counted before it."""
    return events.groupBy(*by).agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in _METRIC_EVENTS.items()]
    )


def hourly_export(events: DataFrame) -> DataFrame:
    """One export row per post (a user's hour of the day) and day; a day is one file."""
    hour, day = F.hour("ts").alias("hour"), F.to_date("ts").alias("day")
    rows = activity(events, F.col("user_id"), hour, day)
    number = F.col("user_id") * 24 + F.col("hour")
    return rows.select(
        F.concat(
            F.lit("Update "), F.col("user_id").cast("string"), F.lit(" #h"), F.col("hour").cast("string"),
            F.lit(" @user"), F.col("user_id").cast("string"),
        ).alias("Post title"),
        F.concat(F.lit("https://page.example.com/feed/update/urn:li:activity:"), number.cast("string")).alias("Post link"),
        F.date_format("day", "MM/dd/yyyy").alias("Created date"),
        *_METRIC_EVENTS,
        F.date_format("day", "yyyy-MM-dd").alias("source_file"),
        F.struct(
            F.date_format("day", "yyyy-MM-dd").alias("file"), F.lit(0).cast("bigint").alias("block"), number.alias("row")
        ).alias("arrival"),
    )


def hourly_posts(events: DataFrame, settings: Settings) -> DataFrame:
    return posts_from_table(hourly_export(events), settings)


def split_events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The first half of the month and the rest."""
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    return events.where(~late), events.where(late)


# --- files out of tables ---------------------------------------------------------------
def quoted(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def as_csv_files(
    rows: DataFrame, file: Column, order: str, encoding: str = "UTF-8", lead: str = "", hide: tuple[str, ...] = ()
) -> DataFrame:
    """Rows as ``binaryFile`` rows of CSV text, one file per value of ``file``.

    Meant for keys that bound the rows of one file. The ``order`` column and
    those to ``hide`` are not written.
    """
    shown = [c for c in rows.columns if c not in (order, *hide)]
    header = ",".join(f'"{c}"' for c in shown)
    line = F.concat_ws(",", *[quoted(F.col(f"`{c}`")) for c in shown])
    lines = rows.select(file.alias("file"), F.struct(F.col(order).alias("k"), line.alias("line")).alias("l"))
    files = lines.groupBy("file").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    text = F.concat(
        F.lit(lead + header + "\n"), F.array_join(F.transform("ls", lambda l: l["line"]), "\n"), F.lit("\n")
    )
    return as_binary(files.select("file", F.encode(text, encoding).alias("content")))


def as_binary(files: DataFrame) -> DataFrame:
    """``file`` and ``content`` shaped like the rows of the ``binaryFile`` source."""
    return files.select(
        F.concat(F.lit("memory:/exports/"), "file").alias("path"),
        F.lit("2024-02-01").cast("timestamp").alias("modificationTime"),
        F.length("content").cast("bigint").alias("length"),
        "content",
    )
