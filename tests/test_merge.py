"""The keyed merges against brute force on random rows, and their laws."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymark import constants as K
from tallymark.config import Settings
from tallymark.operators import maintenance, merge, reports, rollups
from tallymark.sources.tables import table_schema

NOW = datetime(2025, 9, 1, 12)
FIRST = datetime(2025, 8, 1)


def incoming_frame(spark, rows):
    """``rows``: (id, six metrics, ctr, rate, title, arrival)."""
    columns = "post_id string, " + ", ".join(f"{m} bigint" for m in K.METRICS)
    df = spark.createDataFrame(rows, columns + ", ctr double, engagement_rate double, post_title string, at int")
    return df.select(
        "post_id", F.lit("company").alias("company_id"), F.col("post_title").alias("post_content"),
        F.lit(FIRST).cast("timestamp").alias("post_date"), *K.METRICS, "engagement_rate", "ctr",
        F.lit("text").alias("post_type"), F.lit("").alias("post_url"), "post_title",
        F.array(F.lit("#a")).alias("hashtags"), F.array().cast("array<string>").alias("mentions"),
        F.struct(F.col("at").alias("row")).alias("arrival"),
    )


def empty_table(spark):
    return spark.createDataFrame([], table_schema("post_analytics"))


def random_rows(seed, n=400, ids=60, hot=True):
    rng = random.Random(seed)
    rows = []
    for at in range(n):
        key = "hot" if hot and rng.random() < 0.4 else f"p{rng.randrange(ids)}"
        metrics = [rng.choice([0, 0, 1, rng.randrange(1000)]) for _ in range(5)]
        rows.append((key, *metrics, metrics[0], rng.randrange(100) / 4, rng.randrange(400) / 4, f"title {at}", at))
    return rows


def rates(impressions, clicks, likes, comments, shares):
    if impressions <= 0:
        return 0.0, 0.0
    return round(clicks / impressions * 100, 6), min(round((likes + comments + shares + clicks) / impressions * 100, 6), 100.0)


def brute_merge(stored, rows, policy):
    """``stored`` and the result: id to (metrics, ctr, rate, title, created, updated)."""
    folded = {}
    for key, *rest in sorted(rows, key=lambda r: r[-1]):
        metrics, (ctr, rate, title, _) = rest[:6], rest[6:]
        if policy == "max" and key in folded:
            metrics = [max(a, b) for a, b in zip(folded[key][0], metrics)]
            ctr, rate = rates(*metrics[:5])
        folded[key] = (metrics, ctr, rate, title)
    after = dict(stored)
    for key, (metrics, ctr, rate, title) in folded.items():
        if key not in stored:
            after[key] = (metrics, ctr, rate, title, NOW, None)
            continue
        if policy == "max":
            metrics = [max(a, b) for a, b in zip(stored[key][0], metrics)]
            ctr, rate = rates(*metrics[:5])
        after[key] = (metrics, ctr, rate, title, stored[key][4], NOW)
    return after


def as_dict(table):
    return {
        r.post_id: ([r[m] for m in K.METRICS], r.ctr, r.engagement_rate, r.post_title, r.created_at, r.updated_at)
        for r in table.collect()
    }


def close(a, b):
    assert a.keys() == b.keys()
    for key in a:
        (m1, c1, e1, *r1), (m2, c2, e2, *r2) = a[key], b[key]
        assert m1 == m2 and r1 == r2 and abs(c1 - c2) < 2e-6 and abs(e1 - e2) < 2e-6, (key, a[key], b[key])


@pytest.mark.parametrize("policy", ["max", "new"])
def test_merge_against_brute_force(spark, policy):
    before = Settings(as_of=FIRST, policy=policy)
    later = Settings(as_of=NOW, policy=policy)
    first, second = random_rows(1, ids=80), random_rows(2, ids=90)
    stored = merge.merge_posts(empty_table(spark), incoming_frame(spark, first), before)
    held = {k: (*v[:4], FIRST, None) for k, v in brute_merge({}, first, policy).items()}
    close(as_dict(stored), held)
    close(as_dict(merge.merge_posts(stored, incoming_frame(spark, second), later)), brute_merge(held, second, policy))


def test_max_laws(spark, settings):
    """Repeating changes nothing, the order of batches does not matter for metrics, nothing falls."""
    a, b = incoming_frame(spark, random_rows(3)), incoming_frame(spark, random_rows(4))
    nothing = empty_table(spark)

    def metrics(table):
        return {r.post_id: tuple(r[m] for m in K.METRICS) for r in table.collect()}

    only_a = merge.merge_posts(nothing, a, settings)
    ab = merge.merge_posts(only_a, b, settings)
    ba = merge.merge_posts(merge.merge_posts(nothing, b, settings), a, settings)
    assert metrics(ab) == metrics(ba) == metrics(merge.merge_posts(ab, b, settings)) == metrics(merge.merge_posts(ab, a, settings))
    after = metrics(ab)
    assert all(x <= y for k, v in metrics(only_a).items() for x, y in zip(v, after[k]))


def test_missing_metrics_count_as_zero(spark, settings):
    row = ("p", None, 2, None, 1, None, None, 0.0, 0.0, "t", 1)
    stored = merge.merge_posts(empty_table(spark), incoming_frame(spark, [("p", 4, 1, 1, 0, 0, 4, 25.0, 50.0, "s", 0)]), settings)
    after = merge.merge_posts(stored, incoming_frame(spark, [row]), settings).first()
    assert [after[m] for m in K.METRICS] == [4, 2, 1, 1, 0, 4] and after.ctr == 50.0 and after.engagement_rate == 100.0


def test_insert_only_and_last_per_key(spark):
    rows = random_rows(5)
    df = incoming_frame(spark, rows)
    stored = spark.createDataFrame([("hot",), ("p1",)], "post_id string")
    fresh = {r.post_id: r.post_title for r in merge.insert_only(stored, df, K.POST_KEY).collect()}
    expected = {}
    for row in rows:
        if row[0] not in ("hot", "p1"):
            expected.setdefault(row[0], row[-2])
    assert fresh == expected
    last = {r.post_id: r.post_title for r in merge.last_per_key(df, K.POST_KEY).collect()}
    assert last == {row[0]: row[-2] for row in rows}


def test_upsert_keeps_columns_not_supplied(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, extra string")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    after = {r.k: (r.v, r.extra) for r in merge.upsert(base, new, ["k"]).collect()}
    assert after == {"a": (1, "x"), "b": (9, "y"), "c": (3, None)}


def test_demographics_insert_only_compares_days(spark):
    schema = "company_id string, demographic_type string, demographic_value string, date_collected timestamp, count int"
    stored = spark.createDataFrame([("c", "location", "Lagos", datetime(2025, 9, 1, 8), 1)], schema)
    rows = [("c", "location", "Lagos", NOW, 2), ("c", "location", "Accra", NOW, 3), ("c", "location", "Accra", NOW, 4)]
    new = spark.createDataFrame(rows, schema).withColumn("arrival", F.struct("count"))
    found = merge.new_demographics(stored, new).collect()
    assert [(r.demographic_value, r["count"]) for r in found] == [("Accra", 3)]


def test_current_followers(spark):
    follower = spark.createDataFrame(
        [("a", FIRST, 5), ("a", NOW, 0), ("b", FIRST, 7), ("c", FIRST, 0)], "company_id string, date_collected timestamp, total_followers bigint"
    )
    company = spark.createDataFrame(
        [("a", NOW, 9), ("b", NOW, 8), ("d", NOW, 0)], "company_id string, date_collected timestamp, followers_count bigint"
    )
    found = {r.company_id: r.followers for r in rollups.current_followers(follower, company, 1000).collect()}
    assert found == {"a": 9, "b": 7, "c": 1000, "d": 1000}
    newest = {r.company_id: r.followers for r in rollups.current_followers(follower, company, 0, newest=True).collect()}
    assert newest == {"a": 9, "b": 8, "c": 0, "d": 0}


def test_retention_keeps_undated_rows(spark, settings):
    rows = [("a", datetime(2025, 6, 3, 12)), ("b", datetime(2025, 6, 3, 11, 59)), ("c", None), ("d", NOW)]
    df = spark.createDataFrame([(k, d, "x") for k, d in rows], "k string, date_collected timestamp, company_id string")
    assert {r.k for r in maintenance.retained(df, settings).collect()} == {"a", "c", "d"}
    assert {r.k for r in maintenance.retained(df, settings, company_id="other").collect()} == {"a", "b", "c", "d"}


def test_reports_on_empty_tables(spark, settings):
    tables = {n: spark.createDataFrame([], table_schema(n)) for n in ("post_analytics", "follower_analytics", "company_analytics", "file_ledger")}
    report = reports.summary_report(*tables.values(), settings).first()
    assert report.followers.current_count == 0 and report.content.total_posts == 0
    assert report.top_performing_post.content == "None" and report.last_file_processed is None
    assert reports.freshness(tables["post_analytics"], settings).first().age_days is None


def test_reclassify_only_one_company(spark, settings):
    rows = [("a", "Organic", "my video", "company"), ("b", "Organic", "x", "other"), ("c", "promoted", "my video", "company"), ("d", None, "x", "company")]
    df = spark.createDataFrame(rows, "post_id string, post_type string, post_content string, company_id string").withColumns(
        {"post_url": F.lit(None).cast("string"), "post_title": F.lit("")}
    )
    found = {r.post_id: r.post_type for r in merge.reclassify(df, settings, "company").collect()}
    assert found == {"a": "video", "b": "Organic", "c": "promoted", "d": "text"}
