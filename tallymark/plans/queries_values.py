"""Queries over single values: numbers, rates, dates, ids, types, tags, names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..functions import dates, numbers, text
from ..functions.digest import with_digest_numbers
from ..operators import columns, demographics, headers, merge, reports
from ..schema import CELL
from ..sources import files, mail
from . import sqltext as q
from .registry import query, table


def by_turn(key: Column, *values: Column) -> Column:
    """The values in turn, by the remainder of the key."""
    result = values[-1]
    for i, value in enumerate(values[:-1]):
        result = F.when(key % len(values) == i, value).otherwise(result)
    return result


def turn_sql(key: str, *values: str) -> str:
    cases = " ".join(f"WHEN {key} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {cases} ELSE {values[-1]} END"


# --- numbers and rates ----------------------------------------------------------------
def _number_texts(line: DataFrame) -> DataFrame:
    price, key = F.col("l_extendedprice"), F.col("l_orderkey") + F.col("l_linenumber")
    return line.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        by_turn(
            key,
            F.format_number(price.cast("bigint"), 0),
            F.concat(F.format_number(price.cast("bigint"), 0), F.lit(".75 %")),
            F.concat(F.lit("-"), F.col("l_partkey").cast("string")),
            F.concat(F.lit("about "), F.col("l_partkey").cast("string"), F.lit(".5K views")),
            F.lit("n/a"),
            F.lit(None).cast("string"),
            F.concat(F.lit("."), F.col("l_partkey").cast("string")),
        ).alias("raw"),
    )


_GROUPED = "format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT))"
_NUMBER_TEXTS = f"""SELECT l_orderkey, l_linenumber, l_partkey, {turn_sql(
    '(l_orderkey + l_linenumber)',
    _GROUPED, _GROUPED + " || '.75 %'", "'-' || l_partkey", "'about ' || l_partkey || '.5K views'", "'n/a'",
    'NULL', "'.' || l_partkey")} AS raw FROM lineitem"""


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, raw, {q.safe_int('raw')} AS as_int,
      coalesce({q.first_number('raw')}, 0.0) AS as_float,
      coalesce(try_cast(CASE WHEN regexp_matches(raw, '^[+-]?\\d+$') THEN raw END AS BIGINT),
        try_cast(trunc({q.whole_number("replace(raw, ',', '')")}) AS BIGINT), 0) AS stored
    FROM ({_NUMBER_TEXTS})"""
)
def safe_numbers(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("raw")
    return _number_texts(table(spark, folder, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "raw",
        numbers.safe_int(raw).alias("as_int"),
        numbers.safe_float(raw).alias("as_float"),
        numbers.stored_int(raw).alias("stored"),
    )


_RATE_TEXTS = f"""SELECT l_orderkey, l_linenumber, l_partkey, {turn_sql(
    '(l_orderkey + l_linenumber)',
    "CAST(l_discount AS VARCHAR) || '%'", "CAST(l_tax AS VARCHAR)", "' ' || CAST(l_quantity AS VARCHAR) || ' '",
    "'1,' || (100 + l_partkey % 900) || '.25 %'", "'junk'", "''", "'-' || CAST(l_discount AS VARCHAR)",
    "'.5'", "'1e-2'", "'nan'", "'1d'", "'1e9' || (l_partkey % 10)", "repeat('9', 320)", "'1e400 %'")} AS raw FROM lineitem"""


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {q.clean_rate('raw')} AS rate,
      least(greatest({q.clean_rate('raw')}, -1e9), 100.0) AS capped FROM ({_RATE_TEXTS})"""
)
def clean_rates(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_orderkey") + F.col("l_linenumber")
    raw = by_turn(
        key,
        F.concat(F.col("l_discount").cast("string"), F.lit("%")),
        F.col("l_tax").cast("string"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")),
        F.concat(F.lit("1,"), (F.lit(100) + F.col("l_partkey") % 900).cast("string"), F.lit(".25 %")),
        F.lit("junk"), F.lit(""),
        F.concat(F.lit("-"), F.col("l_discount").cast("string")),
        F.lit(".5"), F.lit("1e-2"), F.lit("nan"), F.lit("1d"),
        F.concat(F.lit("1e9"), (F.col("l_partkey") % 10).cast("string")), F.lit("9" * 320), F.lit("1e400 %"),
    )
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", raw.alias("raw"))
    rated = line.select("l_orderkey", "l_linenumber", "l_partkey", numbers.clean_rate(F.col("raw")).alias("rate"))
    return rated.withColumn("capped", numbers.cap_percent(F.col("rate")))


# --- dates ------------------------------------------------------------------------------
_DATE_TEXTS = f"""SELECT o_orderkey, {turn_sql(
    'o_orderkey',
    "strftime(o_orderdate, '%m/%d/%Y')", "strftime(o_orderdate, '%d/%m/%Y')", "strftime(o_orderdate, '%m-%d-%y')",
    "strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%Y/%m/%d')",
    "strftime(o_orderdate, '%B %d, %Y')", "strftime(o_orderdate, '%b %d, %Y')",
    "upper(strftime(o_orderdate, '%d %B %Y'))", "strftime(o_orderdate, '%d %b %Y')", "'31/02/2024'", "'soon'",
    "''", "NULL", "strftime(o_orderdate, '%Y%m%d')", "'  ' || strftime(o_orderdate, '%-d/%-m/%Y') || ' '",
    "'5/6/75'", "'29-02-2023'", "strftime(o_orderdate, '%m.%d.%Y')", "strftime(o_orderdate, '%d.%m.%Y')",
    "replace(strftime(o_orderdate, '%b %-d, %Y'), 'Sep ', 'Sept ')", "strftime(o_orderdate, '%-d %b %y')",
    "strftime(o_orderdate, '%A, %B %-d, %Y')", "strftime(o_orderdate, '%a, %d %b %Y')")} AS raw FROM orders"""


def _date_texts(orders: DataFrame) -> DataFrame:
    d = F.col("o_orderdate")

    def shown(pattern: str) -> Column:
        return F.date_format(d, pattern)

    return orders.select(
        "o_orderkey",
        by_turn(
            F.col("o_orderkey"),
            shown("MM/dd/yyyy"), shown("dd/MM/yyyy"), shown("MM-dd-yy"), shown("yyyy-MM-dd"), shown("yyyy/MM/dd"),
            shown("MMMM dd, yyyy"), shown("MMM dd, yyyy"), F.upper(shown("dd MMMM yyyy")), shown("dd MMM yyyy"),
            F.lit("31/02/2024"), F.lit("soon"), F.lit(""), F.lit(None).cast("string"), shown("yyyyMMdd"),
            F.concat(F.lit("  "), shown("d/M/yyyy"), F.lit(" ")), F.lit("5/6/75"), F.lit("29-02-2023"),
            shown("MM.dd.yyyy"), shown("dd.MM.yyyy"), F.replace(shown("MMM d, yyyy"), F.lit("Sep "), F.lit("Sept ")),
            shown("d MMM yy"), shown("EEEE, MMMM d, yyyy"), shown("EEE, dd MMM yyyy"),
        ).alias("raw"),
    )


@query(
    f"""SELECT o_orderkey, raw, strftime({q.day_from_text('t')}, '%Y-%m-%d') AS month_first,
      strftime({q.day_from_text('t', True)}, '%Y-%m-%d') AS day_first
    FROM (SELECT *, trim(raw) AS t FROM ({_DATE_TEXTS}))"""
)
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    texts = _date_texts(table(spark, folder, "orders")).withColumn("t", F.trim("raw"))
    day, shift = dates.split_clock(F.col("t"))
    parts = texts.withColumns({"day": day, "shift": shift})
    return parts.select(
        "o_orderkey",
        "raw",
        F.date_format(dates.join_clock(dates.parse_day(F.col("day")), F.col("shift")), "yyyy-MM-dd").alias("month_first"),
        F.date_format(dates.join_clock(dates.parse_day(F.col("day"), True), F.col("shift")), "yyyy-MM-dd").alias("day_first"),
    )


_TIME_TEXTS = turn_sql(
    "event_id",
    "strftime(ts, '%Y-%m-%d %H:%M:%S')", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')", "strftime(ts, '%m/%d/%Y %H:%M')",
    "strftime(ts, '%b %d, %Y %I:%M %p')", "strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')", "strftime(ts, '%Y-%m-%d 25:%M')",
    "strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')", "strftime(ts, '%-m/%-d/%Y %H:%M UTC')",
)


@query(
    f"""SELECT event_id, {_TIME_TEXTS} AS raw,
      strftime({turn_sql('event_id', "date_trunc('second', ts)", "ts", "date_trunc('minute', ts)",
                         "date_trunc('minute', ts)", "date_trunc('second', ts) - INTERVAL 2 HOUR", "NULL",
                         "date_trunc('second', ts)", "date_trunc('minute', ts)")},
        '%Y-%m-%d %H:%M:%S.%f') AS moment
    FROM events"""
)
def parse_date_times(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")

    def shown(pattern: str) -> Column:
        return F.date_format(ts, pattern)

    raw = by_turn(
        F.col("event_id"),
        shown("yyyy-MM-dd HH:mm:ss"), shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), shown("MM/dd/yyyy HH:mm"),
        shown("MMM dd, yyyy hh:mm a"), shown("yyyy-MM-dd'T'HH:mm:ss+02:00"), shown("yyyy-MM-dd 25:mm"),
        shown("EEE, dd MMM yyyy HH:mm:ss 'GMT'"), shown("M/d/yyyy HH:mm 'UTC'"),
    )
    texts = table(spark, folder, "events").select("event_id", raw.alias("raw"))
    day, shift = dates.split_clock(F.col("raw"))
    parts = texts.withColumns({"day": day, "shift": shift})
    moment = dates.join_clock(dates.parse_day(F.col("day")), F.col("shift"))
    return parts.select("event_id", "raw", F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"))


# Spellings beyond the listed formats: strftime and date_format patterns, and how the text is read. "swapped" is the
# day and month exchanged where the preferred order asks for it and the date exists.
_SPELLINGS = [
    ("%-d{th} %B %Y", "d'{th}' MMMM yyyy", "day"), ("%b %Y", "MMM yyyy", "month"), ("%B, %Y", "MMMM, yyyy", "month"),
    ("10:00 %-m/%-d/%Y", "'10:00' M/d/yyyy", "month first"), ("10:00 %-d/%-m/%Y", "'10:00' d/M/yyyy", "day first"),
    ("%Y %b %-d", "yyyy MMM d", "day"), ("%Y-%b-%d", "yyyy-MMM-dd", "day"), ("%Y %-d %B", "yyyy d MMMM", "day"),
    ("%A %-d{th} of %B, %Y", "EEEE d'{th} of' MMMM, yyyy", "day"), ("%-d%b%Y", "dMMMyyyy", "day"),
    ("%Y.%m.%d", "yyyy.MM.dd", "day"), ("%m/%Y", "MM/yyyy", "month"), ("%Y-%m", "yyyy-MM", "month"),
    ("%-m %-d %Y", "M d yyyy", "month first"), ("%a %b %-d 10:00 UTC %Y", "EEE MMM d '10:00 UTC' yyyy", "day"),
    ("10am %b %-d %Y", "'10am' MMM d yyyy", "day"), ("%-d %b %Y at 10:00", "d MMM yyyy 'at 10:00'", "day"),
    ("%b %-d", "MMM d", "nothing"), ("%Y %b %-d 10:00 EST", "yyyy MMM d '10:00 EST'", "nothing"),
    ("%-m/%-d-%Y", "M/d-yyyy", "nothing"), ("week of %B %Y", "'week of' MMMM yyyy", "nothing"), ("%Y", "yyyy", "year"),
]


def _ordinal_ending(day: str) -> str:
    return f"CASE WHEN {day} IN (1, 21, 31) THEN 'st' WHEN {day} IN (2, 22) THEN 'nd' WHEN {day} IN (3, 23) THEN 'rd' ELSE 'th' END"


def _spelled_sql(day_first: bool) -> str:
    swapped = "CASE WHEN day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END"
    read = {
        "day": "d", "month": "date_trunc('month', d)::DATE", "year": "date_trunc('year', d)::DATE", "nothing": "NULL",
        "month first": swapped if day_first else "d", "day first": "d" if day_first else swapped,
    }
    days = turn_sql("o_orderkey", *[read[r] for *_, r in _SPELLINGS])
    hours = turn_sql("o_orderkey", *["10" if "10" in shown else "0" for shown, *_ in _SPELLINGS])
    return f"strftime({days}::TIMESTAMP + to_hours({hours}), '%Y-%m-%d %H:%M')"


@query(
    f"""SELECT o_orderkey, replace({turn_sql('o_orderkey', *[f"strftime(d, '{shown}')" for shown, *_ in _SPELLINGS])},
        '{{th}}', {_ordinal_ending('day(d)')}) AS raw,
      {_spelled_sql(False)} AS month_first, {_spelled_sql(True)} AS day_first
    FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)"""
)
def general_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates in spellings that no format lists, in both orders."""
    d = F.col("o_orderdate")
    shown = by_turn(F.col("o_orderkey"), *[F.date_format(d, pattern) for _, pattern, _ in _SPELLINGS])
    raw = F.replace(shown, F.lit("{th}"), F.expr(_ordinal_ending("day(o_orderdate)")))
    texts = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    day, shift = dates.split_clock(F.col("raw"))
    parts = texts.withColumns({"day": day, "shift": shift})
    return parts.select("o_orderkey", "raw", *[
        F.date_format(dates.join_clock(dates.parse_day(F.col("day"), first), F.col("shift")), "yyyy-MM-dd HH:mm").alias(name)
        for name, first in (("month_first", False), ("day_first", True))
    ])


_AMBIGUOUS_AS_OF = Settings(as_of=datetime(2000, 6, 1))


@query(
    """WITH t AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%d-%m-%y')
          ELSE strftime(o_orderdate, '%d/%m/%Y') END AS raw_created,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 3 DAY
          WHEN o_orderkey % 3 = 1 AND day(o_orderdate) <= 12
            THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS TIMESTAMP) END AS campaign_start
      FROM orders),
    r AS (
      SELECT *, try_strptime(regexp_replace(replace(raw_created, '-', '/'), '/(\\d\\d)$',
            CASE WHEN right(raw_created, 2) >= '69' THEN '/19\\1' ELSE '/20\\1' END), '%d/%m/%Y') AS dmy,
        try_strptime(regexp_replace(replace(raw_created, '-', '/'), '/(\\d\\d)$',
            CASE WHEN right(raw_created, 2) >= '69' THEN '/19\\1' ELSE '/20\\1' END), '%m/%d/%Y') AS mdy
      FROM t WHERE CAST(substr(raw_created, 1, 2) AS INT) <= 12 AND CAST(substr(raw_created, 4, 2) AS INT) <= 12)
    SELECT 'https://page.example.com/' || o_orderkey AS post_url, raw_created,
      strftime(dmy, '%Y-%m-%d') AS dmy, strftime(mdy, '%Y-%m-%d') AS mdy,
      strftime(campaign_start, '%Y-%m-%d') AS campaign_start,
      CASE WHEN campaign_start IS NOT NULL THEN
          CASE WHEN abs(epoch(dmy) - epoch(campaign_start)) <= abs(epoch(mdy) - epoch(campaign_start))
            THEN 'dmy' ELSE 'mdy' END
        WHEN mdy BETWEEN TIMESTAMP '2015-01-01' AND TIMESTAMP '2001-12-31'
          AND NOT dmy BETWEEN TIMESTAMP '2015-01-01' AND TIMESTAMP '2001-12-31' THEN 'mdy' ELSE 'dmy' END AS chosen
    FROM r WHERE dmy IS NOT NULL AND mdy IS NOT NULL"""
)
def ambiguous_dates(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    found = reports.ambiguous_dates(
        orders,
        F.when(key % 4 == 0, F.date_format(d, "dd-MM-yy")).otherwise(F.date_format(d, "dd/MM/yyyy")),
        F.when(key % 3 == 0, F.date_add(d, 3).cast("timestamp")).when(
            (key % 3 == 1) & (F.dayofmonth(d) <= 12), F.make_date(F.year(d), F.dayofmonth(d), F.month(d)).cast("timestamp")
        ),
        _AMBIGUOUS_AS_OF,
        F.concat(F.lit("https://page.example.com/"), key.cast("string")),
    )
    days = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("dmy", "mdy", "campaign_start")]
    return found.select("post_url", "raw_created", *days, "chosen")


# --- ids, types, tags ----------------------------------------------------------------------
_URL = turn_sql(
    "o_orderkey",
    "'https://page.example.com/feed/update/urn:li:activity:' || o_orderkey || '/'",
    "'https://page.example.com/feed/urn:li:ugcPost:' || o_orderkey", "'https://page.example.com/p/' || o_orderkey",
    "''", "NULL",
)


@query(
    f"""WITH t AS (SELECT o_orderkey, o_orderdate, {_URL} AS url,
        'Order ' || o_orderpriority || ' of ' || o_custkey AS content FROM orders),
      u AS (SELECT *, coalesce(regexp_extract(url, '(urn:li:(?:activity|ugcPost):[0-9]+)', 1), '') AS urn FROM t)
    SELECT o_orderkey, urn,
      substr(md5(coalesce(nullif(urn, ''), nullif(url, ''),
        substr(content, 1, 100) || '|' || strftime(o_orderdate, '%Y-%m-%d'))), 1, 16) AS post_id,
      substr(md5(concat_ws('|', 'company', url, substr(content, 1, 100), strftime(o_orderdate, '%Y-%m-%d'))), 1, 16)
        AS older_id
    FROM u"""
)
def post_ids(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    url = by_turn(
        F.col("o_orderkey"),
        F.concat(F.lit("https://page.example.com/feed/update/urn:li:activity:"), key, F.lit("/")),
        F.concat(F.lit("https://page.example.com/feed/urn:li:ugcPost:"), key),
        F.concat(F.lit("https://page.example.com/p/"), key),
        F.lit(""), F.lit(None).cast("string"),
    )
    content = F.concat(F.lit("Order "), "o_orderpriority", F.lit(" of "), F.col("o_custkey").cast("string"))
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", url.alias("url"), content.alias("content"))
    rows = rows.withColumn("urn", text.urn_of(F.col("url")))
    day = text.day_text(F.col("o_orderdate"))
    return rows.select(
        "o_orderkey",
        "urn",
        text.make_post_id(F.col("urn"), F.col("url"), F.col("content"), F.col("o_orderdate")).alias("post_id"),
        text.unique_id(F.lit("company"), F.col("url"), F.substring("content", 1, 100), day).alias("older_id"),
    )


_TYPE_WORDS = ["Organic", "Video", "Photo", "PDF", "Article", " Text ", "promoted", "", "Status update", "Link"]
_TYPE_WORD = turn_sql("p_partkey", *[f"'{w}'" for w in _TYPE_WORDS])
_TYPE_URL = turn_sql(
    "(p_partkey + p_size)",
    "'https://page.example.com/pulse/' || p_partkey", "'https://page.example.com/' || p_partkey || '.png'",
    "'https://page.example.com/' || p_partkey", "''", "NULL", "'deck.PPTX'",
)


def _typed_parts(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    address = F.concat(F.lit("https://page.example.com/"), key.cast("string"))
    return part.select(
        "p_partkey",
        "p_name",
        by_turn(key, *[F.lit(w) for w in _TYPE_WORDS]).alias("raw_type"),
        by_turn(
            key + F.col("p_size"),
            F.concat(F.lit("https://page.example.com/pulse/"), key.cast("string")),
            F.concat(address, F.lit(".png")),
            address, F.lit(""), F.lit(None).cast("string"), F.lit("deck.PPTX"),
        ).alias("url"),
    )


@query(
    f"""WITH t AS (SELECT p_partkey, {q.undistributed(_TYPE_WORD)} AS kind,
        lower(concat_ws(' ', p_name, coalesce({_TYPE_URL}, ''), p_name)) AS txt FROM part)
    SELECT p_partkey, {q.post_type('kind', 'txt')} AS post_type FROM t"""
)
def post_types(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    parts = _typed_parts(table(spark, folder, "part"))
    return text.with_post_type(parts, F.col("raw_type"), name, F.col("url"), name).select("p_partkey", "post_type")


@query(
    f"""WITH t AS (SELECT p_partkey, {_TYPE_WORD} AS old_type, lower({_TYPE_WORD}) AS kind,
        lower(concat_ws(' ', p_name, coalesce({_TYPE_URL}, ''), p_name)) AS txt FROM part),
      u AS (SELECT *, CASE WHEN kind IN ('organic', 'sponsored', 'paid', 'boosted', 'promoted') THEN '' ELSE trim(kind) END
        AS word FROM t)
    SELECT p_partkey, old_type,
      CASE WHEN kind IN ('organic', 'sponsored', 'paid', 'boosted', '') THEN {q.post_type('word', 'txt')}
        ELSE old_type END AS post_type FROM u"""
)
def reclassified_types(spark: SparkSession, folder: str) -> DataFrame:
    posts = _typed_parts(table(spark, folder, "part")).select(
        "p_partkey", F.col("raw_type").alias("old_type"), F.col("raw_type").alias("post_type"),
        F.col("p_name").alias("post_content"), F.col("url").alias("post_url"), F.col("p_name").alias("post_title"),
    )
    return merge.reclassify(posts, Settings()).select("p_partkey", "old_type", "post_type")


@query(f"SELECT doc_id, {q.tags('text', '#')} AS hashtags FROM documents")
def hashtags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(text.hashtags(F.col("text")), " ").alias("hashtags")
    )


@query(f"SELECT doc_id, {q.tags('text', '@')} AS mentions FROM documents")
def mentions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(text.mentions(F.col("text")), " ").alias("mentions")
    )


# --- digests -------------------------------------------------------------------------------
_BODY = turn_sql(
    "c_custkey",
    "'<p>Your page has <b>' || format('{:,}', c_custkey * 7) || '</b>&nbsp;<i> </i>followers and 5,678 impressions</p>'",
    "'<div>Total followers: ' || (c_custkey + 5) || '</div> Update impressions: ' || c_custkey",
    "'Followers: 12' || chr(10) || chr(160) || format('{:,}', c_custkey) || ' IMPRESSIONS'",
    "'1.2.3 followers; total followers: 99'", "'<br>nothing to report'", "NULL",
)


def _digest_body(key: Column) -> Column:
    number = key.cast("string")
    return by_turn(
        key,
        F.concat(
            F.lit("<p>Your page has <b>"), F.format_number(key * 7, 0),
            F.lit("</b>&nbsp;<i> </i>followers and 5,678 impressions</p>"),
        ),
        F.concat(
            F.lit("<div>Total followers: "), (key + 5).cast("string"), F.lit("</div> Update impressions: "), number
        ),
        F.concat(F.lit("Followers: 12\n "), F.format_number(key, 0), F.lit(" IMPRESSIONS")),
        F.lit("1.2.3 followers; total followers: 99"),
        F.lit("<br>nothing to report"),
        F.lit(None).cast("string"),
    )


def _labelled(patterns: list[str]) -> str:
    first = ", ".join(f"nullif(regexp_extract(t, '{p}', 1), '')" for p in patterns)
    return f"coalesce(try_cast(trunc({q.whole_number(f'''replace(coalesce({first}), ',', '')''')}) AS BIGINT), 0)"


DIGEST_SQL = f"""SELECT c_custkey, c_nationkey,
      {_labelled(['(?i)([\\d,.]+)\\s+followers', '(?i)total followers[:\\s]+([\\d,.]+)', '(?i)followers[:\\s]+([\\d,.]+)'])}
        AS followers_count,
      {_labelled(['(?i)([\\d,.]+)\\s+impressions', '(?i)update impressions[:\\s]+([\\d,.]+)'])} AS impressions
    FROM (SELECT c_custkey, c_nationkey, trim(regexp_replace(regexp_replace(coalesce({_BODY}, ''), '<[^>]+>', ' ', 'g'),
      '[\\s\\pZ]+', ' ', 'g')) AS t FROM customer)"""


@query(f"SELECT c_custkey, followers_count, impressions, impressions AS reach, CAST(0 AS BIGINT) AS clicks FROM ({DIGEST_SQL})")
def digest_numbers(spark: SparkSession, folder: str) -> DataFrame:
    messages = table(spark, folder, "customer").select("c_custkey", _digest_body(F.col("c_custkey")).alias("body"))
    return with_digest_numbers(messages).select("c_custkey", "followers_count", "impressions", "reach", "clicks")


# --- file and mail names ----------------------------------------------------------------------
_FILE_NAME = """CASE doc_id % 6 WHEN 0 THEN upper(source) || '_Company_Overview.CSV'
    WHEN 1 THEN source || '-follower-content.xlsx' WHEN 2 THEN source || '_demographics.zip.part'
    WHEN 3 THEN '~audience ' || lang || '.xls' WHEN 4 THEN 'report-' || source || '.pdf'
    ELSE source || ' Followers.zip' END"""


@query(
    f"""WITH t AS (SELECT doc_id, {_FILE_NAME} AS name FROM documents), l AS (SELECT *, lower(name) AS n FROM t)
    SELECT doc_id, name,
      CASE WHEN {q.has_any('n', ['post', 'content', 'update', 'overview'])} THEN 'posts'
        WHEN {q.has_any('n', ['demographic', 'audience', 'follower'])} THEN 'demographics' ELSE 'posts' END AS route,
      CASE WHEN {q.has_any('n', ['company', 'overview', 'content', 'post'])} THEN 'posts'
        WHEN {q.has_any('n', ['demographic', 'audience', 'follower'])} THEN 'demographics' ELSE 'posts' END AS older_route,
      regexp_matches(n, '\\.(csv|xls|xlsx|zip)$') AS taken,
      regexp_matches(name, '\\.(csv|xls|xlsx)$') AND name NOT LIKE '~%' AS older_taken,
      regexp_matches(n, '\\.(csv|xls|xlsx|zip)$') AND regexp_matches(n,
        'linkedin|page|analytics|export|content|updates|posts|followers|demographics') AS download
    FROM l"""
)
def route_files(spark: SparkSession, folder: str) -> DataFrame:
    source, lang = F.col("source"), F.col("lang")
    name = by_turn(
        F.col("doc_id"),
        F.concat(F.upper(source), F.lit("_Company_Overview.CSV")),
        F.concat(source, F.lit("-follower-content.xlsx")),
        F.concat(source, F.lit("_demographics.zip.part")),
        F.concat(F.lit("~audience "), lang, F.lit(".xls")),
        F.concat(F.lit("report-"), source, F.lit(".pdf")),
        F.concat(source, F.lit(" Followers.zip")),
    )
    n = F.col("name")
    return table(spark, folder, "documents").select("doc_id", name.alias("name")).select(
        "doc_id", "name",
        files.file_route(n).alias("route"), files.file_route(n, manual=True).alias("older_route"),
        files.is_export_name(n).alias("taken"), files.is_export_name(n, manual=True).alias("older_taken"),
        files.is_download(n).alias("download"),
    )


@query(
    """WITH t AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'Your Page update: ' || text
          WHEN 1 THEN 'Weekly Update' WHEN 2 THEN 'Content export' ELSE text END AS subject,
        CASE role WHEN 'user' THEN 'Page <notify@LinkedIn.example>' ELSE role || '@mail.example' END AS sender
      FROM conversations)
    SELECT conv_id, turn,
      contains(lower(sender), 'linkedin') AND regexp_matches(lower(subject),
        'export|analytics|page analytics|content|posts|demographics|follower|audience') AS export_mail,
      contains(lower(sender), 'linkedin') AND regexp_matches(lower(subject),
        'page update|page analytics|weekly update|your page') AS digest_mail
    FROM t"""
)
def mail_filters(spark: SparkSession, folder: str) -> DataFrame:
    body = F.col("text")
    subject = by_turn(
        F.col("turn"),
        F.concat(F.lit("Your Page update: "), body), F.lit("Weekly Update"), F.lit("Content export"),
        body,
    )
    sender = F.when(F.col("role") == "user", "Page <notify@LinkedIn.example>").otherwise(
        F.concat("role", F.lit("@mail.example"))
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", subject.alias("s"), sender.alias("f")).select(
        "conv_id", "turn",
        mail.is_export_mail(F.col("s"), F.col("f")).alias("export_mail"),
        mail.is_digest_mail(F.col("s"), F.col("f")).alias("digest_mail"),
    )


# --- headers and columns ------------------------------------------------------------------------
def text_chunks(documents: DataFrame) -> DataFrame:
    """Every document as one sheet: its lines are rows, the parts between blanks are cells."""
    def cell(word: Column) -> Column:
        return F.struct(
            F.nullif(word, F.lit("")).alias("s"), F.lit(None).cast("double").alias("num"),
            F.lit(None).cast("timestamp").alias("ts"),
        ).cast(CELL)

    def cells(lines: Column) -> Column:
        return F.transform(lines, lambda line: F.transform(F.split(line, " "), cell))

    lines = F.split("text", "\n")
    return documents.select(
        "doc_id", cells(lines).alias("rows"), cells(F.slice(lines, 1, 10)).alias("head"),
        F.size(lines).cast("bigint").alias("sheet_rows"),
    )


_HINTS = "post|title|link|impressions|views|click|ctr|likes|comments|repost|share|engagement|content type|created|date|published"
_LINES = f"""SELECT doc_id, i AS row_idx, list_filter(list_transform(string_split(lines[i + 1], ' '),
        lambda c: lower({q.strip('c')})), lambda c: c <> '') AS tokens,
        len(string_split(lines[i + 1], ' ')) AS cells, len(lines) AS total
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), unnest(range(len(lines))) AS r(i)
      WHERE i < 10"""
_INDICATORS = [
    "date", "impressions", "clicks", "shares", "likes", "comments", "engagement", "reach", "post", "content",
    "message", "update", "location", "function", "seniority", "industry", "company", "followers", "sponsored", "organic",
]
_HITS = " + ".join(f"len(list_filter(tokens, lambda c: contains(c, '{w}')))" for w in _INDICATORS)


@query(
    f"""WITH l AS ({_LINES}), s AS (SELECT doc_id, row_idx,
        len(tokens) + len(list_filter(tokens, lambda c: regexp_matches(c, '{_HINTS}'))) AS score, {_HITS} AS hits,
        len(tokens) AS filled, cells, total FROM l)
    SELECT doc_id, CAST(arg_min(row_idx, (-score, row_idx)) AS INT) AS by_score,
      CAST(coalesce(min(row_idx) FILTER (WHERE hits >= 2), 0) AS INT) AS by_indicators,
      CAST(CASE WHEN max(filled) FILTER (WHERE row_idx = 0) >= 2 THEN 0
        ELSE arg_min(row_idx, (-score, row_idx)) END AS INT) AS auto,
      CAST(coalesce(min(row_idx) FILTER (WHERE row_idx < 6 AND row_idx + 1 < total AND (filled >= 2 OR filled > cells - filled)),
        min(row_idx) FILTER (WHERE hits >= 2), 0) AS INT) AS named,
      CAST(coalesce(min(row_idx) FILTER (WHERE row_idx < 3 AND row_idx + 1 < total AND filled >= 2), 0) AS INT) AS two_names
    FROM s GROUP BY doc_id"""
)
def header_rows(spark: SparkSession, folder: str) -> DataFrame:
    chunks = text_chunks(table(spark, folder, "documents")).select("doc_id", "sheet_rows", headers.row_tokens(F.col("head")).alias("tokens"))
    told = chunks.select("doc_id", "sheet_rows", headers.row_facts(F.col("tokens")).alias("facts"))  # by all five rules
    facts, rows = F.col("facts"), F.col("sheet_rows")
    return told.select(
        "doc_id",
        headers.by_score(facts, told=True).alias("by_score"),
        headers.by_indicators(facts, told=True).alias("by_indicators"),
        headers.header_position(facts, rows, "auto", told=True).alias("auto"),
        headers.header_position(facts, rows, "named", told=True).alias("named"),
        headers.header_position(facts, rows, "two_names", told=True).alias("two_names"),
    )


_CANDIDATES = ["an", "the main", "on", "st"]
_TOKENS = f"""SELECT doc_id, list_transform(string_split(string_split(text, chr(10))[1], ' '),
    lambda c, i: CASE WHEN {q.strip('c')} = '' THEN 'Column_' || (i - 1) ELSE {q.strip('c')} END) AS names FROM documents"""


def _find_sql(names: str, word_match: bool) -> str:
    tries = []
    for c in _CANDIDATES:
        words = [c, *c.split()] if word_match else [c]
        tries.append(f"list_position({names}, '{c}')")
        tries.append(f"list_position(list_transform({names}, lambda n: {q.has_any('n', words)}), true)")
    return "coalesce(" + ", ".join(f"nullif({t}, 0)" for t in tries) + ") - 1"


@query(
    f"""WITH t AS (SELECT doc_id, names, list_transform(names, lambda n: lower(n)) AS keys FROM ({_TOKENS}))
    SELECT doc_id, array_to_string(names, '|') AS header, {_find_sql('keys', False)} AS found,
      {_find_sql('keys', True)} AS found_by_word,
      CAST(len(list_filter(names, lambda n, i: list_position(names, n) = i)) AS INT) AS distinct_names
    FROM t"""
)
def alias_positions(spark: SparkSession, folder: str) -> DataFrame:
    first = F.transform(F.get(F.col("head"), F.lit(0)), lambda c: c["s"])
    named = text_chunks(table(spark, folder, "documents")).select("doc_id", columns.clean_header(first).alias("names"))
    named = named.withColumn("keys", F.transform("names", lambda n: F.lower(n)))
    keys = F.col("keys")
    return named.select(
        "doc_id",
        F.array_join("names", "|").alias("header"),
        columns.position_of(keys, _CANDIDATES).alias("found"),
        columns.position_of(keys, _CANDIDATES, word_match=True).alias("found_by_word"),
        F.size(columns.keep_first(F.col("names"))).alias("distinct_names"),
    )


@query(
    f"""WITH l AS (SELECT doc_id, i AS row_idx, list_transform(string_split(lines[i + 1], ' '), lambda c: nullif(c, '')) AS cells
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), unnest(range(len(lines))) AS r(i)),
    f AS (SELECT *, list_filter(cells, lambda c: c IS NOT NULL AND {q.strip('c')} <> '') AS filled FROM l)
    SELECT doc_id, CAST(row_idx AS INT) AS row_idx,
      array_to_string(list_transform(list_resize(cells, 5), lambda c: coalesce(c, '~')), '|') AS padded,
      coalesce(len(list_filter(filled, lambda c: regexp_matches(regexp_replace(c, '[.,]', '', 'g'), '^\\d+$'))) > 0, false)
        OR (len(filled) > 0 AND coalesce(list_sum(list_transform(filled, lambda c: length(c))), 0) < 100 * len(filled))
        AS data_row
    FROM f WHERE len(filled) > 0"""
)
def repaired_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = text_chunks(table(spark, folder, "documents")).select("doc_id", F.posexplode("rows").alias("row_idx", "cells"))
    kept = rows.where(~columns.is_blank_row(F.col("cells")))
    padded = columns.pad_row(F.col("cells"), F.lit(5), columns.blank_cell())
    return kept.select(
        "doc_id",
        "row_idx",
        F.array_join(F.transform(padded, lambda c: F.coalesce(c["s"], F.lit("~"))), "|").alias("padded"),
        columns.is_data_row(F.col("cells")).alias("data_row"),
    )


_SHEETS = ["Location", "Job seniority", "Company industry", "Seniority Level", "Junior staff", "My Sheet", "", "Page role"]
_SHEET = "CASE WHEN p_partkey % 8 = 6 THEN '' ELSE (" + turn_sql("p_partkey", *[f"'{s}'" for s in _SHEETS]) + ") || ' ' || p_type END"


def _sheet_case(extra: bool) -> str:
    job = ["function", "job", "role", "occupation"] + (["industry"] if extra else [])
    level = ["seniority", "level", "experience"] + (["senior", "junior"] if extra else [])
    return f"""CASE WHEN {q.has_any('s', ['location', 'country', 'city', 'region', 'geography'])} THEN 'location'
      WHEN {q.has_any('s', job)} THEN 'job_function' WHEN {q.has_any('s', level)} THEN 'seniority'
      WHEN {q.has_any('s', ['company', 'organization', 'employer', 'size'])} THEN 'company_size'
      ELSE replace(s, ' ', '_') END"""


@query(
    f"""WITH t AS (SELECT p_partkey, coalesce(nullif(lower({_SHEET}), ''), 'general') AS s FROM part)
    SELECT p_partkey, {_sheet_case(False)} AS kind, {_sheet_case(True)} AS older_kind FROM t"""
)
def demographic_types(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    sheet = F.when(key % 8 == 6, "").otherwise(
        F.concat(by_turn(key, *[F.lit(s) for s in _SHEETS]), F.lit(" "), "p_type")
    )
    return table(spark, folder, "part").select("p_partkey", sheet.alias("s")).select(
        "p_partkey",
        demographics.demographic_type(F.col("s")).alias("kind"),
        demographics.demographic_type(F.col("s"), manual=True).alias("older_kind"),
    )
