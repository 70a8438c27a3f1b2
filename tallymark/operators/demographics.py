"""Follower records out of demographic sheets, for both profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings
from ..functions import numbers
from ..functions.strings import has_any
from ..session import built_once
from . import cells, columns, headers
from .posts import is_posts_sheet


def demographic_type(sheet: Column, manual: bool = False) -> Column:
    """The category a sheet name stands for. The order of the tests is the meaning."""
    name = F.lower(F.coalesce(F.nullif(sheet, F.lit("")), F.lit("general")))
    result = F.replace(name, F.lit(" "), F.lit("_"))
    for kind, words in reversed(K.MANUAL_DEMOGRAPHIC_TYPES if manual else K.DEMOGRAPHIC_TYPES):
        result = F.when(has_any(name, words), kind).otherwise(result)
    return result


def role_positions(keys: Column, manual: bool = False) -> dict[str, Column]:
    """Positions of the value, count and percentage columns in an array of tidy names.

    One column may fill several roles; in the older rules only one.
    """
    value = columns.keyword_position(keys, K.DEMOGRAPHIC_VALUE_WORDS)
    count = columns.keyword_position(keys, K.DEMOGRAPHIC_COUNT_WORDS, [value] if manual else [])
    percent = columns.keyword_position(keys, K.DEMOGRAPHIC_PERCENT_WORDS, [value, count] if manual else [])
    return {
        "value": F.coalesce(value, F.when(F.size(keys) > 0, 0)),
        "count": F.coalesce(count, F.when(F.size(keys) > 1, 1)),
        "percentage": percent,
    }


def role_columns(names: list[str], manual: bool = False) -> dict[str, str | None]:
    """The same over the column names of a DataFrame."""
    tidy = [n.strip().lower() for n in names]

    def first(words: list[str], taken: set[int]) -> int | None:
        return next((i for i, n in enumerate(tidy) if i not in taken and any(w in n for w in words)), None)

    taken: set[int] = set()
    found = {}
    for role, words in (
        ("value", K.DEMOGRAPHIC_VALUE_WORDS),
        ("count", K.DEMOGRAPHIC_COUNT_WORDS),
        ("percentage", K.DEMOGRAPHIC_PERCENT_WORDS),
    ):
        found[role] = first(words, taken)
        if manual and found[role] is not None:
            taken.add(found[role])
    if found["value"] is None and names:
        found["value"] = 0
    if found["count"] is None and len(names) > 1:
        found["count"] = 1
    return {role: None if i is None else names[i] for role, i in found.items()}


def effective_sheet() -> Column:
    """Only a plain workbook has sheet names that mean a category."""
    return F.when(F.col("kind") == "xlsx", F.col("sheet")).otherwise(F.lit("demographics"))


@built_once
def _of_sheet(manual: bool) -> list[Column]:
    """What is told of a sheet once: the category and the positions of the roles."""
    places = role_positions(F.col("keys"), manual)
    kind = demographic_type(effective_sheet(), manual).alias("demographic_type")
    return [kind, *[p.alias(f"at_{role}") for role, p in places.items()]]


def demographics_from_chunks(chunks: DataFrame, settings: Settings, followers: DataFrame | None = None) -> DataFrame:
    """Every sheet of a workbook, or the one sheet of any other file, to follower records."""
    sheets = headers.with_header(chunks.where((F.col("kind") == "xlsx") | is_posts_sheet()), settings)
    rows = headers.sheet_rows(sheets, *_of_sheet(settings.manual))
    found = {role: F.get(F.col("cells"), F.col(f"at_{role}")) for role in ("value", "count", "percentage")}
    if settings.manual:
        rows = rows.where(F.col("at_value").isNotNull() & F.col("at_count").isNotNull())
    return demographic_records(rows, found, settings, followers)


def demographics_from_table(
    df: DataFrame, sheet: str | Column, settings: Settings, followers: DataFrame | None = None
) -> DataFrame:
    """Rows of sheets with one layout. ``sheet`` is their name, or the column ``sheet`` that holds it."""
    names = [c for c in df.columns if c not in ("source_file", "arrival", "sheet")]
    sheet = F.lit(sheet) if isinstance(sheet, str) else sheet
    roles = role_columns(names, settings.manual)
    found = {
        role: columns.blank_cell() if n is None else columns.cell_of(F.col(f"`{n}`"), df.schema[n].dataType)
        for role, n in roles.items()
    }
    typed = df.withColumn("demographic_type", demographic_type(sheet, settings.manual))
    for name in ("source_file", "arrival"):
        if name not in df.columns:
            typed = typed.withColumn(name, F.lit(None))
    return demographic_records(typed, found, settings, followers)


def demographic_records(
    rows: DataFrame, found: dict[str, Column], settings: Settings, followers: DataFrame | None
) -> DataFrame:
    """``rows`` brings ``demographic_type``, ``source_file`` and ``arrival``.

    ``followers`` is the result of ``current_followers``: one row per company,
    joined once instead of looked up per row.
    """
    share = cells.as_rate(found["percentage"]) if settings.demographic_as_rate else cells.as_float(found["percentage"])
    got = rows.select(
        F.lit(settings.company_id).alias("company_id"),
        (settings.now if settings.manual else settings.midnight).alias("date_collected"),
        F.lit(0).cast("bigint").alias("new_followers"),
        "demographic_type",
        F.substring(cells.as_text(found["value"]), 1, K.DEMOGRAPHIC_VALUE_LENGTH).alias("demographic_value"),
        cells.as_int(found["count"]).alias("count"),
        share.alias("share"),
        "source_file",
        "arrival",
    )
    counted = F.col("count") > 0
    kept = got.where((F.col("demographic_value") != "") & (counted if settings.manual else counted | (F.col("share") > 0)))
    unknown = F.lit(settings.unknown_followers).cast("bigint")
    if followers is None:
        kept = kept.withColumn("total_followers", unknown)
    else:
        # One company, hence one row: the bound that makes this broadcast safe.
        one = followers.where(F.col("company_id") == settings.company_id).limit(1)
        kept = kept.join(F.broadcast(one), "company_id", "left").withColumn(
            "total_followers", F.coalesce("followers", unknown)
        )
    return kept.select(
        "company_id", "date_collected", "total_followers", "new_followers", "demographic_type",
        "demographic_value", "count", numbers.cap_percent(F.col("share")).alias("percentage"),
        "source_file", "arrival",
    )
