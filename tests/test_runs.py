"""Whole runs into the tables: repeats, interruptions, both profiles, mails, maintenance, streams."""

import io
import os
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallymark import constants as K
from tallymark.config import Settings
from tallymark.schema import TABLES
from tallymark.operators import maintenance, reports
from tallymark.plans import ingest
from tallymark.plans.workbooks import workbook_bytes
from tallymark.sources.files import list_files, read_large_csv
from tallymark.sources.tables import PageTables
from tallymark.streaming.folder import stream_files, watch_folder

HEADER = "Post title,Post link,Content type,Created date,Impressions,Clicks\n"


def put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "tables")


def posts_of(tables):
    return {r.post_title: r for r in tables.read("post_analytics").collect()}


def test_run_and_rerun(spark, place, settings):
    folder, root = place
    tables = PageTables(spark, root, settings)
    put(folder, "1_posts.csv", HEADER + "a,https://x/1,,08/06/2025,100,5\na,https://x/1,,08/06/2025,90,9\nb,https://x/2,,,10,1\n")
    put(folder, "2_followers.xlsx", workbook_bytes([("Location", [["Location", "Followers"], ["Lagos", 4]])]))
    put(folder, "3_page.csv", HEADER + "c,https://x/3,,,1,1\n")
    assert ingest.ingest_folder(spark, folder, tables, settings, "b1") == ingest.Ingested(4, 1, 3)
    found = posts_of(tables)
    assert (found["a"].impressions, found["a"].clicks, found["a"].ctr) == (100, 9, 9.0)
    assert found["a"].date_collected == settings.as_of and found["a"].updated_at is None
    history = {r.post_id: r.impressions for r in tables.read("post_metrics_history").collect()}
    assert history[found["a"].post_id] == 90 and len(history) == 3, "the last incoming row, not the merged one"
    assert tables.read("analytics_history").count() == 2 and tables.read("company_analytics").first().total_posts == 1
    assert reports.duplicate_keys(tables.read("post_analytics"), K.POST_KEY).isEmpty()
    assert ingest.ingest_folder(spark, folder, tables, settings, "b2") == ingest.Ingested(0, 0, 0)

    put(folder, "4_posts.csv", HEADER + "a new,https://x/1,,08/06/2025,50,20\n")
    tomorrow = settings.at(settings.as_of + timedelta(days=1))
    assert ingest.ingest_folder(spark, folder, tables, tomorrow, "b3").posts == 1
    after = posts_of(tables)["a new"]
    assert (after.impressions, after.clicks, after.ctr) == (100, 20, 20.0)
    assert after.date_collected == settings.as_of and after.updated_at == tomorrow.as_of
    assert tables.read("post_metrics_history").count() == 4
    assert {r.status for r in tables.read("file_ledger").collect()} == {"ok"}


def test_interrupted_batch_is_finished_from_its_staged_rows(spark, place, settings, monkeypatch):
    folder, root = place
    tables = PageTables(spark, root, settings)
    put(folder, "1_posts.csv", HEADER + "a,https://x/1,,,100,5\n")

    def fail(self, key, bases=None):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(PageTables, "publish", fail)
    with pytest.raises(RuntimeError):
        ingest.ingest_folder(spark, folder, tables, settings, "b1")
    monkeypatch.undo()
    assert all(tables.read(name).isEmpty() for name in TABLES), "nothing shows before all does"
    put(folder, "2_posts.csv", HEADER + "landed since,https://x/2,,,1,1\n")
    again = PageTables(spark, root, Settings(as_of=settings.as_of, key_buckets=99))
    assert again.buckets == settings.key_buckets, "the layout of the folder stays"
    later = settings.at(settings.as_of + timedelta(hours=1))
    assert ingest.ingest_folder(spark, folder, again, later, "b1").posts == 1
    row = posts_of(again)["a"]
    assert row.updated_at is None and row.date_collected == settings.as_of
    assert again.read("analytics_history").count() == 1 and again.read("post_metrics_history").count() == 1


def test_large_csv(spark, place, settings):
    folder, root = place
    put(folder, "1_posts.csv", HEADER + "a,https://x/1,,,100,5\n")
    tables = PageTables(spark, root, settings)
    for _ in range(2):
        assert ingest.ingest_large_csv(read_large_csv(spark, folder), tables, settings, "b2") == 1
    assert set(posts_of(tables)) == {"a"}
    assert [(r.file_name, r.rows, r.status) for r in tables.read("file_ledger").collect()] == [("1_posts.csv", 1, "ok")]


def test_one_id_serves_several_operations(spark, place, settings):
    folder, root = place
    tables = PageTables(spark, root, Settings(as_of=settings.as_of, key_buckets=1))
    put(folder, "1_posts.csv", HEADER + "old,https://x/1,,,1,1\n")
    ingest.ingest_folder(spark, folder, tables, settings.at(datetime(2025, 1, 1)), "old")
    put(folder, "2_posts.csv", HEADER + "new,https://x/2,,,1,1\n")
    ingest.ingest_folder(spark, folder, tables, settings, "b1")
    ingest.clean_up(tables, settings, "b1")
    ingest.clean_up(tables, settings, "old")
    assert set(posts_of(tables)) == {"new"}
    messages = spark.createDataFrame([("m1", "9,000 followers")], "path string, body string")
    assert ingest.ingest_digests(messages, tables, settings, "b1") == 1
    assert tables.read("company_analytics").first().followers_count == 9000
    assert tables.read("analytics_history").count() == 3
    assert not os.path.exists(f"{root}/_staging/ingest/b1"), "staged rows go with their batch"


def test_a_used_id_with_other_files_is_an_error(spark, place, settings):
    folder, root = place
    tables = PageTables(spark, root, settings)
    put(folder, "1_posts.csv", HEADER + "a,https://x/1,,,1,1\n")
    assert ingest.ingest_folder(spark, folder, tables, settings, "b1").posts == 1
    assert ingest.ingest_folder(spark, folder, tables, settings, "b1") == ingest.Ingested(0, 0, 0)
    put(folder, "2_posts.csv", HEADER + "b,https://x/2,,,1,1\n")
    with pytest.raises(ValueError, match="another input"):
        ingest.ingest_folder(spark, folder, tables, settings, "b1")
    assert ingest.ingest_folder(spark, folder, tables, settings, "b2").posts == 1


def test_bad_files_cost_only_themselves(spark, place, settings, tmp_path):
    folder, root = place
    tables = PageTables(spark, root, settings)
    book = workbook_bytes([("Posts", [["Post title", "Clicks"], *[[f"t{i}", i] for i in range(200)]])])
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("posts.csv", HEADER + "z,https://x/z,,,1,1\n" * 50)
    for name, content in (("a_posts.xlsx", book), ("b_posts.zip", packed.getvalue())):
        for at in range(30, len(content) - 40, max(1, len(content) // 12)):
            damaged = bytearray(content)
            damaged[at:at + 24] = b"\xff\x00\x13" * 8
            put(folder, name.replace("_", f"_{at}_"), bytes(damaged))
    put(folder, "c_posts.csv", b"\x00\x01\x02\x03,\x05\n1,2\n")
    put(folder, "posts[1].csv", HEADER + "good,https://x/1,,,100,5\n")
    ingest.ingest_folder(spark, folder, tables, settings, "b1", report=str(tmp_path / "reports"))
    assert posts_of(tables)["good"].impressions == 100
    states = {r.file_name: r.status for r in tables.read("file_ledger").collect()}
    assert states["c_posts.csv"] == "unreadable" and states["posts[1].csv"] == "ok" and "unreadable" in states.values()
    assert len(states) == len(os.listdir(folder)) and set(states.values()) <= {"ok", "unreadable", "empty"}
    assert all("\ufffd" not in title and title.isprintable() for title in posts_of(tables))
    assert os.path.isdir(tmp_path / "reports" / "validation_b1")


def test_older_profile(spark, place):
    folder, root = place
    older = Settings(as_of=datetime(2025, 9, 1, 12), profile="manual", key_buckets=4)
    tables = PageTables(spark, root, older)
    put(folder, "company.csv", "Update,Date,Impressions,Clicks,Engagement rate,Kind\nhello,08/06/2025,100,5,150,Organic\nhello,08/06/2025,7,1,1,x\n,,3,1,1,x\n")
    put(folder, "audience.xlsx", workbook_bytes([("Industry", [["Name", "Count"], ["Tech", 4], ["Law", 0]])]))
    put(folder, "~tmp.csv", "Update\nno\n")
    put(folder, "empty_posts.csv", "\n")
    assert ingest.ingest_folder(spark, folder, tables, older, "b1") == ingest.Ingested(1, 1, 2)
    row = tables.read("post_analytics").first()
    assert (row.post_content, row.impressions, row.engagement_rate, row.post_type) == ("hello", 100, 100.0, "Organic")
    company = tables.read("company_analytics").first()
    assert (company.followers_count, company.engagement_rate) == (1000, 100.0)
    assert tables.read("follower_analytics").first().demographic_type == "job_function"
    put(folder, "post2.csv", "Update,Date,Impressions\nhello,08/06/2025,999\nother,08/06/2025,1\n")
    assert ingest.ingest_folder(spark, folder, tables, older, "b2").posts == 1
    assert {r.post_content: r.impressions for r in tables.read("post_analytics").collect()} == {"hello": 100, "other": 1}


def test_digests(spark, place, settings):
    tables = PageTables(spark, place[1], settings)
    rows = [("m1", "1,000 followers"), ("m2", "2,000 followers and 7 impressions"), ("m3", None)]
    messages = spark.createDataFrame(rows[:2], "path string, body string")
    assert ingest.ingest_digests(messages, tables, settings, "d1") == 2
    assert ingest.ingest_digests(messages, tables, settings, "d1") == 2
    company = tables.read("company_analytics").collect()
    assert [(r.followers_count, r.impressions) for r in company] == [(2000, 7)]
    assert tables.read("analytics_history").count() == 2
    put(place[0], "demographics.csv", "Location,Members\nLagos,3\n")
    ingest.ingest_folder(spark, place[0], tables, settings, "b1")
    assert tables.read("follower_analytics").first().total_followers == 2000


def test_clean_up_touches_only_what_is_old(spark, place, settings):
    folder, root = place
    tables = PageTables(spark, root, settings)
    old = settings.at(datetime(2025, 1, 1))
    put(folder, "1_posts.csv", HEADER + "".join(f"old {i},https://x/{i},,,1,1\n" for i in range(6)))
    put(folder, "1_followers.csv", "Location,Members\nLagos,3\n")
    ingest.ingest_folder(spark, folder, tables, old, "b1")
    put(folder, "2_posts.csv", HEADER + "new,https://x/new,Organic,,1,1\nseen again,https://x/0,,,2,1\n")
    put(folder, "2_followers.csv", "Location,Members\nAccra,3\n")
    ingest.ingest_folder(spark, folder, tables, settings, "b2")
    ingest.clean_up(tables, settings, "c1")
    assert set(posts_of(tables)) == {"new"}, "the day of the first insert counts"
    assert [r.demographic_value for r in tables.read("follower_analytics").collect()] == ["Accra"]
    tables.compact("k1")
    base = next(d for d in os.listdir(f"{root}/follower_analytics") if d.startswith("base-") and not d.endswith(".crc"))
    days = [d for d in os.listdir(f"{root}/follower_analytics/{base}") if d.startswith("collected_day")]
    assert days == ["collected_day=2025-09-01"]
    ingest.clean_up(tables, settings, "c2")
    assert set(posts_of(tables)) == {"new"}


def test_reclassify_stored(spark, place, settings):
    tables = PageTables(spark, place[1], settings)
    put(place[0], "1_posts.csv", HEADER + "my video,https://x/1,,,1,1\n")
    ingest.ingest_folder(spark, place[0], tables, settings, "b1")
    tables.begin("x", lambda: "x")
    tables.change("post_analytics", "x", lambda: tables.read("post_analytics").select("post_id", F.lit("Sponsored").alias("post_type")), "set")
    tables.finish("x")
    assert posts_of(tables)["my video"].post_type == "Sponsored"
    ingest.reclassify_posts(tables, settings, "r1")
    assert posts_of(tables)["my video"].post_type == "video"


def test_missing_tables_are_named(spark, place, settings):
    tables = PageTables(spark, place[1], settings)
    assert tables.missing() == []
    os.rename(f"{place[1]}/file_ledger", f"{place[1]}/_elsewhere")
    assert tables.missing() == ["file_ledger"]


def test_date_report(spark, place, settings):
    rows = spark.createDataFrame([("u1", "03/04/2024", None), ("u2", "13/04/2024", None)], "url string, raw string, start timestamp")
    found = reports.ambiguous_dates(rows, F.col("raw"), F.col("start"), settings, F.col("url"))
    path = maintenance.write_date_report(found, place[1], "b1")
    written = spark.read.option("header", True).csv(path).collect()
    assert [(r.post_url, r.raw_created, r.chosen) for r in written] == [("u1", "03/04/2024", "dmy")]


def test_expired_files_are_only_listed(spark, place, settings):
    put(place[0], "a.csv", "x")
    put(place[0], "b.csv", "x")
    past = datetime(2025, 1, 1).timestamp()
    os.utime(os.path.join(place[0], "a.csv"), (past, past))
    found = maintenance.expired_files(list_files(spark, place[0]), settings).collect()
    assert [r.file_name for r in found] == ["a.csv"] and len(os.listdir(place[0])) == 2


def test_streams_into_the_same_tables_do_not_meet(spark, place, settings, tmp_path):
    tables = PageTables(spark, place[1], settings)
    for n in (1, 2):
        folder = tmp_path / f"in{n}"
        folder.mkdir()
        put(str(folder), f"my_posts_{n}.csv", HEADER + f"p{n},https://x/{n},,,100,5\n")
        put(str(folder), "my_posts_old.csv", HEADER + f"old {n},https://x/old{n},,,100,5\n")
        past = datetime(2025, 1, 1).timestamp()
        os.utime(folder / "my_posts_old.csv", (past, past))
        watch_folder(
            spark, str(folder), tables, settings, str(tmp_path / f"offsets{n}"), clock=lambda: settings.as_of
        ).awaitTermination()
    assert set(posts_of(tables)) == {"p1", "p2", "old 1", "old 2"}


def test_the_files_of_a_batch_are_listed_by_a_few_tasks(spark, place, settings, tmp_path):
    folder, root = place
    for n in range(60):
        put(folder, f"my_posts_{n}.csv", HEADER + f"p{n},https://x/{n},,,{n},1\n")
    listing, tables = "spark.sql.sources.parallelPartitionDiscovery.parallelism", PageTables(spark, root, settings)
    spark.conf.unset(listing)
    watch_folder(spark, folder, tables, settings, str(tmp_path / "checkpoint"), clock=lambda: settings.as_of).awaitTermination()
    assert int(spark.conf.get(listing)) == 4 * spark.sparkContext.defaultParallelism < 60
    assert {r.impressions for r in posts_of(tables).values()} == set(range(60))
    spark.conf.set(listing, "2")
    stream_files(spark, folder)
    assert spark.conf.get(listing) == "2", "one that is set lower stays"
    spark.conf.unset(listing)


def test_stream(spark, place, settings, tmp_path):
    folder, root = place
    tables = PageTables(spark, root, settings)

    def run():
        watch_folder(
            spark, folder, tables, settings, str(tmp_path / "checkpoint"), max_files=1, clock=lambda: settings.as_of
        ).awaitTermination()

    put(folder, "my_posts_1.csv", HEADER + "a,https://x/1,,,100,5\n")
    put(folder, "my_posts_2.csv", HEADER + "a,https://x/1,,,50,9\n")
    put(folder, "my_posts_3.csv.part", HEADER + "half,https://x/9,,,50,9\n")
    put(folder, "holiday.csv", HEADER + "unrelated,https://x/8,,,50,9\n")
    run()
    assert (posts_of(tables)["a"].impressions, posts_of(tables)["a"].clicks, len(posts_of(tables))) == (100, 9, 1)
    run()
    assert tables.read("analytics_history").count() == 2
    put(folder, "my_followers_4.csv", "Location,Members\nLagos,3\n")
    run()
    assert tables.read("follower_analytics").count() == 1 and tables.read("file_ledger").count() == 3


def test_validation_report(spark, place, settings, tmp_path):
    from tallymark.operators.posts import posts_from_chunks
    from tallymark.sources.files import read_chunks

    put(place[0], "p.csv", HEADER + '"a #t, ""q""",https://x/1,,,100,5\n')
    found = posts_from_chunks(read_chunks(spark, place[0]), settings)
    path = maintenance.write_validation_report(found, str(tmp_path / "reports"), "b1")
    row = spark.read.option("header", True).option("escape", "\\").csv(path).first()
    assert row.hashtags == '["#t"]' and row.post_title == 'a #t, "q"' and row.source_file == "p.csv"
