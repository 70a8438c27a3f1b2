"""Scalars on literals: one table per function."""

import warnings
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymark.config import Settings
from tallymark.functions import dates, numbers, text
from tallymark.functions.digest import with_digest_numbers
from tallymark.operators import cells
from tallymark.operators.columns import cell_of


def evaluate(spark, values, build, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.r for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def check(spark, cases, build, dtype="string"):
    assert evaluate(spark, list(cases), build, dtype) == list(cases.values())


def test_safe_int(spark):
    check(spark, {
        None: 0, "": 0, " ": 0, "12": 12, " 1,234 ": 1234, "-5": 5, "1.9": 1, "1.2K": 1, ".5": 5, "36%": 36,
        "about 7 of 9": 7, "nan": 0, "inf": 0, "abc": 0, "1,2,3": 123, "12.": 12, "1e3": 1, "9" * 30: 0,
    }, numbers.safe_int)


def test_safe_float(spark):
    check(spark, {
        None: 0.0, "": 0.0, "0.25": 0.25, "1,234.5%": 1234.5, "-2.5": 2.5, "nan": 0.0, "inf": 0.0, "x3.75y": 3.75,
    }, numbers.safe_float)


def test_stored_int_keeps_the_sign(spark):
    check(spark, {
        None: 0, "": 0, "-5": -5, "1,234": 1234, "12.7": 12, "-12.7": -12, "1e3": 1000, "1d": 0, "nan": 0, "x": 0,
        " 7 ": 7,
    }, numbers.stored_int)


def test_clean_rate(spark):
    check(spark, {
        None: 0.0, "": 0.0, "0.36%": 0.36, "0.0036": 0.36, "0.36": 36.0, "1": 1.0, "0.99": 99.0, "1,234.5%": 1234.5,
        "-0.5%": -0.5, "-0.5": -0.5, "nan": 0.0, "inf": 0.0, "1d": 0.0, "abc": 0.0, "0": 0.0, " 2.5 % ": 2.5,
        "1e-2": 1.0, "12.3456789": 12.345679,
    }, numbers.clean_rate)


def test_rounding_is_half_even(spark):
    row = spark.range(1).select(
        numbers.compute_ctr(F.lit(1), F.lit(128)).alias("tie"),
        numbers.compute_ctr(F.lit(3), F.lit(128)).alias("other_tie"),
        numbers.compute_ctr(F.lit(3), F.lit(0)).alias("none"),
    ).first()
    assert (row.tie, row.other_tie, row.none) == (0.7812, 2.3438, 0.0)


def test_cap_percent(spark):
    check(spark, {None: 0.0, 55.5: 55.5, 100.0: 100.0, 250.0: 100.0, float("inf"): 0.0}, numbers.cap_percent, "double")
    assert evaluate(spark, [float("nan")], numbers.cap_percent, "double") == [0.0]


D = datetime


def test_dates_month_first(spark):
    check(spark, {
        None: None, "": None, "soon": None, "08/06/2025": D(2025, 8, 6), "8/6/25": D(2025, 8, 6),
        "13/06/2025": D(2025, 6, 13), "06-13-2025": D(2025, 6, 13), "13-6-25": D(2025, 6, 13),
        "1/2/75": D(1975, 1, 2), "1/2/69": D(1969, 1, 2), "1/2/68": D(2068, 1, 2), "13/13/2025": None,
        "30/02/2024": None, "29/02/2024": D(2024, 2, 29), "29/02/2023": None, "2025-8-6": D(2025, 8, 6),
        "2025/08/06": D(2025, 8, 6), "August 6, 2025": D(2025, 8, 6), "aug 6, 2025": D(2025, 8, 6),
        "6 August 2025": D(2025, 8, 6), "06 AUG 2025": D(2025, 8, 6), "6-Aug-2025": D(2025, 8, 6),
        "May 1 2025": D(2025, 5, 1), "Augustus 6, 2025": None, "20250806": D(2025, 8, 6), "45000": None,
        "08/06-2025": None, "8/6/2025 x": None,
    }, dates.parse_date)


def test_dates_day_first(spark):
    check(spark, {
        "08/06/2025": D(2025, 6, 8), "06/13/2025": D(2025, 6, 13), "13-06-25": D(2025, 6, 13),
        "2025-08-06": D(2025, 8, 6),
    }, lambda c: dates.parse_date(c, day_first=True))


SPELLED = [
    f"{before}{shape}{after}"
    for shape in (
        "5th January 2024", "2024 Jan 5", "2024 5 Jan", "2024-Jan-05", "January 5th, 2024", "Jan-5-2024",
        "5th of January, 2024", "5jan2024", "05Jan24", "Jan 30 45", "5/Jan/2024", "5. January 2024", "5 jan. 2024", "Sept. 5, 2024",
        "1/2/2024", "13/2/2024", "1 2 2024", "13 2 2024", "5-1 2024", "1/2 2024", "1,2,2024", "12 11 10", "2nd/3/2024",
        "Friday, 5 January 2024", "31st Feb 2024", "Jan 0 2024", "32 Jan 2024", "5 Januar 2024", "(1/2/2024)", "1_2_2024",
        "Jan 5 12024", "2 AUGUST 2024", "the 5th of May 2024",
    )
    for before, after in (
        ("", ""), ("10:00 ", ""), ("", " 10:30 pm"), ("10am ", ""), ("", " at 10:00"), ("10:00:15.5 ", ""), ("", ", 10:00"),
        ("10:00 UTC ", ""), ("", " 10:00 +0200"),
    )
] + ["Jan 2024", "2024 Jan", "January, 2024", "2024-Jan"]  # with a clock that parser takes today's day


@pytest.mark.parametrize("day_first", [False, True])
def test_general_dates_as_a_general_parser_reads_them(spark, day_first):
    def general(text):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            moment = pd.to_datetime(text, dayfirst=day_first, errors="coerce")
        if moment is pd.NaT:
            return None
        return (moment.tz_convert("UTC").tz_localize(None) if moment.tzinfo else moment).to_pydatetime()

    found = dict(zip(SPELLED, evaluate(spark, SPELLED, lambda c: dates.parse_date(c, day_first)), strict=True))
    assert {t: (v, general(t)) for t, v in found.items() if v != general(t)} == {}


def test_general_dates_that_are_decided_here(spark):
    cases = {
        "2024 01 05": D(2024, 1, 5), "2024.01.05": D(2024, 1, 5), "99/1/2": D(1999, 1, 2), "75 Jan 5": D(1975, 1, 5),
        "24 Jan 5th": D(2024, 1, 5), "2024": D(2024, 1, 1), "01/2024": D(2024, 1, 1), "13/2024": None, "Jan 5": None, "10:00": None,
        "Monday": None, "today": None, "5 Jan 2024 10:00 EST": None, "1/2/5": None, "1/2-2024": None, "m": None, "mmmmmmmm": None,
        "Jan Feb 2024": None, "10:00 5 Jan 2024 BC": None, "10:00 11:00 5 Jan 2024": None, "5 Jan 2024 13 pm": None, "x" * 100_000: None, "1 " * 50_000: None,
    }
    check(spark, cases, dates.parse_date)
    check(spark, cases, lambda c: dates.parse_date(c, True))


def test_dates_with_time(spark):
    check(spark, {
        "2025-08-06 14:30:05": D(2025, 8, 6, 14, 30, 5), "2025-08-06T14:30:05.25Z": D(2025, 8, 6, 14, 30, 5, 250000),
        "2025-08-06T14:30:00+02:00": D(2025, 8, 6, 12, 30), "2025-08-06T00:30:00+0200": D(2025, 8, 5, 22, 30),
        "8/6/2025 2:30 PM": D(2025, 8, 6, 14, 30), "8/6/2025 12:05 am": D(2025, 8, 6, 0, 5),
        "Aug 6, 2025 02:30": D(2025, 8, 6, 2, 30), "2025-08-06 25:00": None, "2025-08-06 13:30 pm": None,
        "2025-08-06 10:61": None,
    }, dates.parse_date)


def test_missing_date_and_offset(spark):
    df = spark.createDataFrame([("8/6/2025",), (None,)], "v string")
    for changes, expected in (
        ({}, [D(2025, 8, 6), None]),
        ({"missing_date": "now"}, [D(2025, 8, 6), D(2025, 9, 1, 12)]),
        ({"tz_offset_hours": 1.5}, [D(2025, 8, 6, 1, 30), None]),
    ):
        use = Settings(as_of=D(2025, 9, 1, 12), **changes)
        parts = df.select(*cells.date_parts(cell_of(F.col("v"), df.schema["v"].dataType), "d"))
        assert [r.d for r in parts.select(cells.date_from_parts("d", use).alias("d")).collect()] == expected


def test_ambiguous(spark):
    check(spark, {
        "08/06/2025": True, " 1-2-24 10:00": True, "13/06/2025": False, "06/13/2025": False, "2025-08-06": False, "": False,
        None: False,
    }, dates.is_ambiguous)


@pytest.mark.parametrize(("dmy", "mdy", "campaign", "chosen"), [
    ("2025-06-08", "2025-08-06", "2025-08-01", "mdy"), ("2025-06-08", "2025-08-06", "2025-06-10", "dmy"),
    ("2025-06-08", "2025-08-06", "2025-07-08 12:00:00", "mdy"), ("2025-01-01", "2025-01-03", "2025-01-02", "dmy"),
    ("2025-06-08", "2025-08-06", None, "dmy"), ("2014-12-01", "2015-01-12", None, "mdy"),
    ("2027-05-01", "2026-05-27", None, "mdy"), ("2010-05-01", "2010-01-05", None, "dmy"),
])
def test_chosen_order(spark, dmy, mdy, campaign, chosen):
    def at(v):
        return F.lit(v).cast("timestamp")

    picked = dates.choose_order(at(dmy), at(mdy), at(campaign), at("2015-01-01"), at("2026-12-31"))
    assert spark.range(1).select(picked).first()[0] == chosen


def test_urn(spark):
    check(spark, {
        None: "", "": "", "https://x/urn:li:activity:123/": "urn:li:activity:123",
        "urn:li:ugcPost:9?x": "urn:li:ugcPost:9", "urn:li:share:9": "",
    }, text.urn_of)


def test_post_id_falls_back(spark):
    rows = [("u", "l", "c"), ("", "l", "c"), (None, "", "c" * 150), ("", None, None)]
    df = spark.createDataFrame(rows, "u string, l string, c string").withColumn("d", F.lit("2025-08-06").cast("timestamp"))
    import hashlib

    def short(base):
        return hashlib.md5(base.encode()).hexdigest()[:16]

    found = [r[0] for r in df.select(text.make_post_id(F.col("u"), F.col("l"), F.col("c"), F.col("d"))).collect()]
    assert found == [short("u"), short("l"), short("c" * 100 + "|2025-08-06"), short("|2025-08-06")]
    joined = df.limit(1).select(text.unique_id(F.lit("co"), F.lit(None).cast("string"), F.col("u"))).first()[0]
    assert joined == short("co|u")


@pytest.mark.parametrize(("raw", "title", "url", "kind"), [
    ("Organic", "hello", "", "text"), ("Organic", "hello", "https://x", "article"), ("Article", "a photo", "", "image"),
    ("Text", "see https://x", "", "text"), (None, "my Video", "", "video"), ("PDF", "hello", "", "document"),
    ("", "x", "https://x/pulse/1", "article"), ("", "x", "a.PNG", "image"), ("Link", "x", "", "article"),
    ("Status", "x", "", "text"), ("boosted", "slides.pptx", "", "document"), (" VIDEO ", "photo", "", "video"),
])
def test_post_type(spark, raw, title, url, kind):
    df = spark.createDataFrame([(raw, title, url)], "raw string, title string, url string")
    found = text.with_post_type(df, F.col("raw"), F.col("title"), F.col("url"))
    assert found.columns == ["raw", "title", "url", "post_type"] and found.first().post_type == kind


def test_hashtags(spark):
    check(spark, {
        None: [], "": [], "#a #b #a": ["#a", "#b"], "x&#39;s #ok": ["#ok"], "##double": ["#double"], "#Äpfel_2 #été": ["#Äpfel_2", "#été"],
        "# no": [], "a#b": ["#b"], "&##x": ["#x"],
    }, text.hashtags)
    many = " ".join(f"#t{i}" for i in range(70))
    assert evaluate(spark, [many], text.hashtags) == [[f"#t{i}" for i in range(50)]]


def test_mentions(spark):
    check(spark, {
        "@ann @bob.b @ann": ["@ann", "@bob.b"], "mail me@site.org": ["@site.org"], "@ x": [], "@a-b,": ["@a-b"],
    }, text.mentions)


def test_digest(spark):
    bodies = {
        "<b>1,234</b> followers and 5,678 impressions": (1234, 5678),
        "Total followers: 1,234<br>Update impressions: 9": (1234, 9),
        "FOLLOWERS: 12": (12, 0),
        "1.2.3 followers, total followers: 7": (0, 0),
        "2.5 followers": (2, 0),
        "nothing": (0, 0),
        None: (0, 0),
    }
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    rows = with_digest_numbers(df).orderBy("i").collect()
    assert [(r.followers_count, r.impressions) for r in rows] == list(bodies.values())
    assert all(r.reach == r.impressions and r.clicks == 0 and r.engagement_rate == 0.0 for r in rows)


def test_settings_refuse_unknown_words():
    with pytest.raises(ValueError):
        Settings(policy="min")
