"""Post records out of export rows, for both profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings
from ..functions import numbers, text
from ..functions.strings import has_any
from ..session import built_once
from . import cells, columns, headers


def is_posts_sheet(manual: bool = False) -> Column:
    """The sheet that holds the posts: the first one named so, else the first of the file."""
    words = K.MANUAL_POSTS_SHEET_WORDS if manual else K.POSTS_SHEET_WORDS
    named = columns.position_where(F.col("sheets"), lambda s: has_any(F.lower(s), words))
    return F.col("sheet_idx") == F.coalesce(named, F.lit(0))


def _mapping(manual: bool) -> dict[str, list[str]]:
    return K.MANUAL_POST_COLUMNS if manual else K.POST_COLUMNS


@built_once
def _places(manual: bool) -> list[Column]:
    return [
        columns.position_of(F.col("keys"), candidates, word_match=manual).alias(f"at_{logical}")
        for logical, candidates in _mapping(manual).items()
    ]


def posts_from_chunks(chunks: DataFrame, settings: Settings) -> DataFrame:
    """Decoded files, each with its own header, to post records."""
    mapping = _mapping(settings.manual)
    sheet = headers.with_header(chunks.where(is_posts_sheet(settings.manual)), settings)
    rows = headers.sheet_rows(sheet, F.col("path"), *_places(settings.manual))
    if settings.drop_notes:
        rows = rows.where(columns.is_data_row(F.col("cells")))
    found = {
        logical: F.get(F.col("cells"), F.col(f"at_{logical}")) for logical in mapping
    }
    absent = {logical: F.col(f"at_{logical}").isNull() for logical in mapping}
    return post_records(rows, found, settings, absent)


def posts_from_table(df: DataFrame, settings: Settings, source_file: str | None = None) -> DataFrame:
    """Rows of one layout, as read by Spark itself, to post records.

    ``df`` may bring ``source_file`` and ``arrival`` (see ``read_large_csv``).
    """
    own = [c for c in df.columns if c not in ("source_file", "arrival")]
    found = columns.flat_cells(df.select(*[F.col(f"`{c}`") for c in own]), _mapping(settings.manual), settings.manual)
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(source_file))
    if "arrival" not in df.columns:
        df = df.withColumn(
            "arrival",
            F.struct(
                F.col("source_file").alias("file"),
                F.lit(0).cast("bigint").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ),
        )
    names = {l: columns.find_column(own, c, settings.manual) for l, c in _mapping(settings.manual).items()}
    absent = {l: F.lit(n is None) for l, n in names.items()}
    return post_records(df, found, settings, absent)


def post_records(rows: DataFrame, found: dict[str, Column], settings: Settings, absent: dict[str, Column]) -> DataFrame:
    """The record projection; ``rows`` brings ``source_file`` and ``arrival``."""
    if settings.manual:
        return _manual_records(rows, found, settings, absent)
    rows = rows.select("source_file", "arrival", *[c.alias(f"{l}_cell") for l, c in found.items()])
    got = cells.with_date_parts_settled(rows.select("source_file", "arrival", *_values()).where(F.col("title") != ""), "created")
    return finish_posts(got.withColumn("post_date", cells.date_from_parts("created", settings)), settings)


@built_once
def _values() -> list[Column]:
    """The values out of the cells, before those of a row are settled together."""
    found = {l: F.col(f"{l}_cell") for l in K.POST_COLUMNS}
    return [
        cells.as_text(found["title"]).alias("title"),
        cells.as_text(found["link"]).alias("url"),
        cells.as_text(found["content_type"]).alias("raw_type"),
        *cells.date_parts(found["created"], "created"),
        cells.as_int(found["impressions"]).alias("shown"),
        cells.as_int(found["views"]).alias("views"),
        *[cells.as_int(found[m]).alias(m) for m in ("clicks", "likes", "comments", "shares")],
        cells.as_rate(found["ctr"]).alias("file_ctr"),
        cells.as_rate(found["engagement_rate"]).alias("file_engagement"),
    ]


def finish_posts(got: DataFrame, settings: Settings) -> DataFrame:
    """Clean values to records: fallbacks, rates, type, id, tags."""
    df = got.withColumn("impressions", F.when(F.col("shown") == 0, F.col("views")).otherwise(F.col("shown")))
    df = text.with_post_type(df, F.col("raw_type"), F.col("title"), F.col("url"))
    return df.select(*_record(settings.company_id))


@built_once
def _record(company_id: str) -> list[Column]:
    title, url = F.col("title"), F.col("url")
    clicks, impressions = F.col("clicks"), F.col("impressions")
    computed = numbers.engagement(F.col("likes"), F.col("comments"), F.col("shares"), clicks, impressions)
    return [
        text.make_post_id(text.urn_of(url), url, title, F.col("post_date")).alias("post_id"),
        F.lit(company_id).alias("company_id"),
        F.substring(title, 1, K.CONTENT_LENGTH).alias("post_content"),
        *[F.col(c) for c in ("post_date", "impressions", "clicks", "likes", "comments", "shares")],
        impressions.alias("reach"),
        numbers.cap_percent(F.when(impressions > 0, computed).otherwise(F.col("file_engagement"))).alias(
            "engagement_rate"
        ),
        F.when(F.col("file_ctr") > 0, F.col("file_ctr"))
        .otherwise(numbers.compute_ctr(clicks, impressions)).alias("ctr"),
        F.col("post_type"),
        url.alias("post_url"),
        F.substring(title, 1, K.TITLE_LENGTH).alias("post_title"),
        text.hashtags(title).alias("hashtags"),
        text.mentions(title).alias("mentions"),
        F.col("post_date").isNull().alias("date_missing"),
        F.col("source_file"),
        F.col("arrival"),
    ]


def _manual_records(
    rows: DataFrame, found: dict[str, Column], settings: Settings, absent: dict[str, Column]
) -> DataFrame:
    """The older rules: rate and type as the file gives them, id from company, text and day."""
    typed = F.when(absent["content_type"], "text").otherwise(cells.as_text(found["content_type"]))
    rows = rows.select(
        "source_file", "arrival", typed.alias("post_type"), *[c.alias(f"{l}_cell") for l, c in found.items()]
    )
    found = {l: F.col(f"{l}_cell") for l in found}
    content = cells.as_text(found["title"])
    given = (content != "") | found["created"]["s"].isNotNull()
    got = rows.where(given).select(
        "source_file",
        "arrival",
        content.alias("content"),
        cells.as_text(found["link"]).alias("post_url"),
        "post_type",
        *cells.date_parts(found["created"], "created"),
        *[cells.as_int(found[m]).alias(m) for m in ("impressions", "clicks", "likes", "comments", "shares")],
        numbers.cap_percent(cells.as_float(found["engagement_rate"])).alias("engagement_rate"),
    )
    got = cells.with_date_parts_settled(got, "created")
    got = got.withColumn("post_date", cells.date_from_parts("created", settings))
    company = F.lit(settings.company_id)
    return got.select(
        text.unique_id(company, F.substring("content", 1, 100), text.day_text(F.col("post_date"))).alias("post_id"),
        company.alias("company_id"),
        F.substring("content", 1, K.CONTENT_LENGTH).alias("post_content"),
        "post_date", "impressions", "clicks", "likes", "comments", "shares",
        F.col("impressions").alias("reach"),
        "engagement_rate", "post_type", "post_url",
        settings.now.alias("date_collected"),
        F.col("post_date").isNull().alias("date_missing"),
        "source_file", "arrival",
    )
