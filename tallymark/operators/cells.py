"""Values out of raw cells: typed cells as they are, text through the text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings
from ..functions import dates, numbers
from ..functions.strings import strip, text_or_blank
from ..session import built_once


def as_text(cell: Column) -> Column:
    return text_or_blank(cell["s"])


def as_int(cell: Column) -> Column:
    """The sign is dropped for typed numbers too, as it is in texts."""
    return F.when(cell["num"].isNotNull(), numbers.or_zero(F.abs(cell["num"]).try_cast("bigint"))).otherwise(
        numbers.safe_int(cell["s"])
    )


def as_float(cell: Column) -> Column:
    return F.when(cell["num"].isNotNull(), F.abs(cell["num"])).otherwise(numbers.safe_float(cell["s"]))


def as_rate(cell: Column) -> Column:
    return F.when(cell["num"].isNotNull(), numbers.fraction_to_percent(cell["num"])).otherwise(
        numbers.clean_rate(cell["s"])
    )


def date_parts(cell: Column, name: str) -> list[Column]:
    """First of two steps to a date: the typed date, the text's date part and its time of day.

    In two projections, because one expression for all spellings would outgrow
    what Spark compiles into one method.
    """
    day, shift = dates.split_clock(strip(cell["s"]))
    return [cell["ts"].alias(f"{name}_ts"), day.alias(f"{name}_day"), shift.alias(f"{name}_shift")]


def with_date_parts_settled(rows: DataFrame, name: str) -> DataFrame:
    """Between both steps: a generator of one row, so that a filter on the date is not moved below the first step,
    where it would split every text again, in one expression too large to compile."""
    parts = [f"{name}_day", f"{name}_shift"]
    others = [c for c in rows.columns if c not in parts]
    return rows.select(*others, F.inline(F.array(F.struct(*parts))).alias(*parts))


def date_from_parts(name: str, settings: Settings) -> Column:
    """Second step: a timestamp, NULL or ``as_of`` when there is none."""
    moment = _moment(name, settings.day_first, settings.tz_offset_hours)
    return F.coalesce(moment, settings.now) if settings.missing_date == "now" else moment


@built_once
def _moment(name: str, day_first: bool, tz_offset_hours: float) -> Column:
    day = dates.parse_day(F.col(f"{name}_day"), day_first)
    moment = F.coalesce(F.col(f"{name}_ts"), dates.join_clock(day, F.col(f"{name}_shift")))
    if tz_offset_hours:
        moment = F.timestamp_micros(F.unix_micros(moment) + F.lit(int(tz_offset_hours * 3600000000)))
    return moment
