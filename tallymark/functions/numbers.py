"""Numbers and rates out of free text, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import MAX_PERCENT
from .strings import strip

# Digits of any number; what overflows a double counts as no number.
_WHOLE_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_WHOLE_INTEGER = r"^[+-]?\d+$"
_FIRST_NUMBER = r"(\d+(?:\.\d+)?)"
_UNROUNDED = 1e11


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def finite(c: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.abs(c) < float("inf"), c)


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def number_from_text(text: Column) -> Column:
    """The whole text as a number, or NULL.

    The pattern refuses Java suffixes such as ``1d``, and keeps junk away from
    the cast, where every failure would cost an exception.
    """
    t = strip(text)
    return finite(F.when(t.rlike(_WHOLE_NUMBER), t.try_cast("double")))


def _first_digits(text: Column) -> Column:
    return F.regexp_extract(F.translate(text, "%,", ""), _FIRST_NUMBER, 1)


def first_number(text: Column) -> Column:
    """The first run of digits in the text, thousands separators dropped; the sign is lost."""
    return _once(_first_digits(text), lambda d: finite(F.when(d != "", d.try_cast("double"))))


def safe_int(text: Column) -> Column:
    """The first number, cut to an integer; 0 without one.

    A zero in front changes no number and makes one where there is none, so every cast succeeds and nothing is tested.
    """
    return or_zero(F.concat(F.lit("0"), _first_digits(text)).try_cast("double").try_cast("bigint"))


def safe_float(text: Column) -> Column:
    return F.coalesce(first_number(text), F.lit(0.0))


def stored_int(text: Column) -> Column:
    """A stored metric as an integer; unlike ``safe_int`` the sign stays."""
    t = strip(text)
    return F.coalesce(F.when(t.rlike(_WHOLE_INTEGER), t.try_cast("bigint")), digits_with_commas(t), F.lit(0))


def digits_with_commas(text: Column) -> Column:
    """``1,234.9`` as 1234, or NULL when the text is no number."""
    return number_from_text(F.translate(text, ",", "")).try_cast("bigint")


def fraction_to_percent(value: Column) -> Column:
    """0.0036 means 0.36 %; 0.99 means 99 %, 1 means 1 %.

    From ``_UNROUNDED`` on a double has no six decimals to round, and rounding it would be slow.
    """
    scaled = F.when((value > 0) & (value < 1), value * 100.0).otherwise(value)
    return F.when(F.abs(value) < _UNROUNDED, F.bround(scaled, 6)).otherwise(value)


def clean_rate(text: Column) -> Column:
    """A rate in percent: ``0.36%`` as it is, bare fractions times 100, junk and blanks 0."""
    t = strip(text)
    percent = t.endswith("%")
    value = number_from_text(F.when(percent, F.translate(t, "%,", "")).otherwise(F.translate(t, ",", "")))
    rate = _once(value, lambda v: F.coalesce(F.when(percent, v).otherwise(fraction_to_percent(v)), F.lit(0.0)))
    return F.when(text.isNull(), 0.0).otherwise(rate)  # most exports have no column of rates


def percent_of(part: Column, whole: Column, scale: int) -> Column:
    """``part / whole * 100`` rounded half-even; 0 when there is no whole."""
    return F.when(whole > 0, F.bround(part / whole * 100.0, scale)).otherwise(F.lit(0.0))


def compute_ctr(clicks: Column, impressions: Column, scale: int = 4) -> Column:
    return percent_of(clicks, impressions, scale)


def engagement(likes: Column, comments: Column, shares: Column, clicks: Column, impressions: Column) -> Column:
    return percent_of(likes + comments + shares + clicks, impressions, 6)


def cap_percent(rate: Column) -> Column:
    """At most 100; NaN counts as 0 (Spark would order it above 100)."""
    return F.least(F.coalesce(finite(rate), F.lit(0.0)), F.lit(MAX_PERCENT))


def recomputed_rates() -> dict[str, Column]:
    """Both rates from the metric columns, for rows whose metrics were merged."""
    c = {m: or_zero(F.col(m)) for m in ("impressions", "clicks", "likes", "comments", "shares")}
    return {
        "ctr": percent_of(c["clicks"], c["impressions"], 6),
        "engagement_rate": cap_percent(
            engagement(c["likes"], c["comments"], c["shares"], c["clicks"], c["impressions"])
        ),
    }
