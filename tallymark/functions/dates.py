"""Dates in many spellings, as native column expressions.

Two steps. The first settles the classes of tokens: it takes the clock off, wherever it
stands, and writes what is left as numbers in one of few shapes. The shapes exclude each
other, so the second step casts once. For ``a/b/year`` the preferred order of day and
month counts if that date exists, else the other order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import AMBIGUOUS_DATE_PATTERN
from .strings import strip

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    "(jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|"
    "sep|sept|september|oct|october|nov|november|dec|december)"
)
_WEEKDAY = "(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?"
_CENTURIES = [
    (r"^(\d{1,2}([/.-])\d{1,2}\2)(69|[7-9]\d)$", "$119$3"),
    (r"^(\d{1,2}([/.-])\d{1,2}\2)(\d{2})$", "$120$3"),
]
_SLASHED = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})$"
_DAYS = [
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"(?s)^(?!\d{4}-\d{1,2}-\d{1,2}\z).*$", ""),  # all else is no date
]
_LATE = r"3[2-9]|[4-9]\d"  # two digits that can only be a year
_PLAIN = rf"^(?!(?:{_LATE})\D)\d{{1,2}}([/.-])\d{{1,2}}\1(?:\d{{4}}|\d{{2}})$|^\d{{4}}([/-])\d{{1,2}}\2\d{{1,2}}$|^\d{{8}}$"
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?:\s*[AaPp][Mm])?+(?:\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?+"
_EARLY_TIME = rf"^(.*?)(?<![\d:])({_TIME})(?![\w:+-])[\s,]+(.*\S.*)$"
_CLOCK = (
    r"^(.*?)(?:(?<=\d)T|[\s,]+T?)\s*"
    r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp][Mm])?\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"
)
_BARE_HOUR = r"(?<![\d:.,])(\d{1,2})\s*([AaPp][Mm])\b"
# Tokens: numbers, "m" for the name of a month, "o" behind an ordinal; one blank between them.
_TOKENS = [
    (rf"(?<![a-z])(?:{_WEEKDAY}|of|at|on)(?![a-z])", " "),
    (rf"(?<![a-z]){_MONTH}(?![a-z])", " m "),
    (r"(?<=\d)(?:st|nd|rd|th)(?![a-z])", "o"),
    (r"^\d+\s*([/.-])\s*\d+\s*(?!\1)[/.-]\s*\d+$", "?"),  # two kinds of marks
    (r"[\s,./;'-]+", " "),
    (r"^ | $", ""),
    (r"^(.+?) m( .+)?$", "m $1$2"),
]
_SHAPES = [
    (r"^m (\d{4})$", "$1-m-1"),
    (rf"^m (\d{{4}}|{_LATE}) (\d{{1,2}})o?$", "$1-m-$2"),
    (r"^m (\d{2}) (\d{1,2})o$", "$1-m-$2"),
    (r"^m (\d{1,2})o? (\d{4}|\d{2})$", "$2-m-$1"),
    (r"^(1[789]\d\d|2[01]\d\d)$", "$1-1-1"),
    (r"^(\d{4}) (\d{1,2})$", "$1-$2-1"),
    (r"^(\d{1,2}) (\d{4})$", "$2-$1-1"),
    (rf"^(\d{{4}}|{_LATE}) (\d{{1,2}})o? (\d{{1,2}})o?$", "$1-$2-$3"),
    (r"^(\d{1,2})o? (\d{1,2})o? (\d{4}|\d{2})$", "$1/$2/$3"),
    (r"^(69|[7-9]\d)-", "19$1-"),
    (r"^(\d{2})-", "20$1-"),
]


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _rewritten(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def _clock_last(text: Column) -> Column:
    """The clock behind the date; an hour with am or pm is a clock too."""
    return _rewritten(text, [(_BARE_HOUR, "$1:00 $2"), (_EARLY_TIME, "$1 $3 $2")])


def plain_day(text: Column) -> Column:
    """The date part in numbers: ``y-m-d`` where the order is clear, ``a/b/y`` where it is not.

    Reads names of months and weekdays, ordinals, years of four or two digits, and dates without a day (the
    first). Four digits, or two above 31, in front are the year, then month, then day. Without a year, with
    other words, or with two kinds of marks between three numbers, no date is read.
    """
    low = F.lower(text)
    name = F.substring(F.regexp_extract(low, rf"(?<![a-z]){_MONTH}(?![a-z])", 1), 1, 3)
    number = F.floor((F.instr(F.lit(_MONTHS), name) + 2) / 3).cast("string")
    settled = _rewritten(_rewritten(low, _TOKENS), _SHAPES)
    return F.when(text.rlike(_PLAIN), text).otherwise(F.regexp_replace(settled, r"(?<=^\d{4}-)m(?=-)", number))


def parse_day(text: Column, day_first: bool = False) -> Column:
    """A ``plain_day`` as midnight, or NULL. Two-digit years 69-99 lie in the last century."""
    orders = ["$4-$3-$1", "$4-$1-$3"] if day_first else ["$4-$1-$3", "$4-$3-$1"]
    readings = [_rewritten(text, [*_CENTURIES, (_SLASHED, order), *_DAYS]).try_cast("date") for order in orders]
    return F.coalesce(*readings).cast("timestamp")


def split_clock(text: Column) -> tuple[Column, Column]:
    """The date part of a trimmed text as ``plain_day``, and the time of day in microseconds (NULL if impossible).

    A zone is taken off the time, so the sum of both parts is UTC.
    """
    text = _clock_last(text)

    def clock(group: int) -> Column:
        return F.regexp_extract(text, _CLOCK, group)

    hour, half = _int(clock(2)), F.lower(clock(6))
    hour = (
        F.when(half == "", F.when(hour <= 23, hour))
        .when(~hour.between(1, 12), F.lit(None))
        .when(half == "pm", hour % 12 + 12)
        .otherwise(hour % 12)
    )
    minute, second = _int(clock(3)), F.coalesce(_int(clock(4)), F.lit(0))
    micros = F.coalesce(F.rpad(clock(5), 6, "0").try_cast("bigint"), F.lit(0))
    zone = F.regexp_replace(clock(7), "[:A-Z]", "")
    zone_minutes = F.when(
        zone != "",
        F.when(zone.startswith("-"), -1).otherwise(1)
        * (_int(F.substring(zone, 2, 2)) * 60 + _int(F.substring(zone, 4, 2))),
    ).otherwise(0)
    seconds = hour * 3600 + (minute - zone_minutes) * 60 + second
    timed = text.contains(":")
    day = strip(F.regexp_replace(text, _CLOCK, "$1"))
    within = (minute <= 59) & (second <= 59)
    shift = F.when(timed, F.when(within, seconds.cast("bigint") * 1000000 + micros)).otherwise(0)
    return plain_day(day), shift


def join_clock(day: Column, shift: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(day) + shift)


def parse_date(value: Column, day_first: bool = False) -> Column:
    """A text date, with or without a time of day and zone, as a UTC timestamp; junk is NULL."""
    day, shift = split_clock(strip(value))
    return join_clock(parse_day(day, day_first), shift)


def is_ambiguous(value: Column) -> Column:
    """Begins like ``a/b/year`` with both a and b at most 12."""
    text = strip(value)
    a = _int(F.regexp_extract(text, AMBIGUOUS_DATE_PATTERN, 1))
    b = _int(F.regexp_extract(text, AMBIGUOUS_DATE_PATTERN, 2))
    return F.coalesce((a <= 12) & (b <= 12), F.lit(False))


def choose_order(dmy: Column, mdy: Column, campaign: Column, first: Column, last: Column) -> Column:
    """``dmy`` or ``mdy``: nearest to the campaign start, else the only plausible one, else dmy."""

    def seconds_away(t: Column) -> Column:
        return F.abs(F.unix_micros(t) - F.unix_micros(campaign))

    def plausible(t: Column) -> Column:
        return t.between(first, last)

    near = F.when(seconds_away(dmy) <= seconds_away(mdy), "dmy").otherwise("mdy")
    likely = F.when(plausible(mdy) & ~plausible(dmy), "mdy").otherwise("dmy")
    return F.when(campaign.isNotNull(), near).otherwise(likely)
