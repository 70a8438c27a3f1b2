"""A batch of a stream: its tables side by side, large files on all cores, files in the order of their names."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tallymark.operators import posts
from tallymark.plans import ingest, queries_files
from tallymark.session import side_by_side
from tallymark.sources.files import list_files
from tallymark.sources.tables import PageTables

HEADER = "Post title,Post link,Content type,Created date,Impressions,Clicks\n"


def put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(content)


def binary(spark, folder):
    return spark.read.format("binaryFile").load(str(folder))


def test_tables_of_a_batch_are_written_side_by_side(spark, tmp_path, settings, monkeypatch):
    put(tmp_path / "in", "1_posts.csv", HEADER + "a,https://x/1,,08/06/2025,100,5\n")
    tables, write, met = PageTables(spark, str(tmp_path / "t"), settings), PageTables._write, threading.Barrier(2)

    def waiting(self, path, *args, **observed):
        if "/post_analytics/" in path or "/post_metrics_history/" in path:
            met.wait(60)  # broken if one is written after the other
        return write(self, path, *args, **observed)

    monkeypatch.setattr(PageTables, "_write", waiting)
    assert ingest.ingest_files(binary(spark, tmp_path / "in"), tables, settings, "b1") == ingest.Ingested(1, 0, 1)
    assert tables.read("post_analytics").count() == tables.read("post_metrics_history").count() == 1


def test_an_error_of_one_task_waits_for_the_others(spark):
    done = []

    def fail():
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        side_by_side(fail, lambda: done.append(spark.range(3).count()))
    assert done == [3] and side_by_side(lambda: 1, lambda: 2) == [1, 2]


def test_a_large_file_is_parsed_on_several_cores(spark, tmp_path, settings, monkeypatch):
    put(tmp_path / "in", "1_posts.csv", HEADER + "".join(f"p{n},https://x/{n},,08/06/2025,{n},1\n" for n in range(9000)))
    tables, parts = PageTables(spark, str(tmp_path / "t"), settings), []

    def spied(chunks, settings):
        parts.append(chunks._jdf.queryExecution().toRdd().getNumPartitions())
        return posts.posts_from_chunks(chunks, settings)

    monkeypatch.setattr(ingest, "posts_from_chunks", spied)
    assert ingest.ingest_files(binary(spark, tmp_path / "in"), tables, settings, "b1").posts == 9000
    assert parts == [5], "chunks of 2000 rows, one file"
    found = tables.read("post_analytics").agg(F.count("*"), F.sum("impressions"), F.countDistinct("post_id")).first()
    assert tuple(found) == (9000, 8999 * 4500, 9000)


def test_a_batch_without_followers_runs_no_job_for_them(spark, tmp_path, settings):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    for n in (1, 2):
        put(tmp_path / f"in{n}", f"{n}_posts.csv", HEADER + f"a,https://x/{n},,08/06/2025,100,5\n")
        spark.sparkContext.setJobGroup(f"posts{n}", "a batch of posts")
        try:
            assert ingest.ingest_files(binary(spark, tmp_path / f"in{n}"), tables, settings, f"b{n}") == ingest.Ingested(1, 0, 1)
        finally:
            spark.sparkContext.setJobGroup("others", "others")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("posts2")) <= 19
    put(tmp_path / "in3", "3_followers.csv", "Location,Members\nLagos,3\n")
    assert ingest.ingest_files(binary(spark, tmp_path / "in3"), tables, settings, "b3") == ingest.Ingested(0, 1, 1)
    assert tables.read("post_analytics").count() == 2 and tables.read("follower_analytics").count() == 1


def test_texts_nobody_asks_for_are_not_read(spark, tmp_path, settings):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    for n in (1, 2):
        put(tmp_path / f"in{n}", f"{n}_posts.csv", HEADER + f"a #t{n},https://x/1,,08/0{n}/2025,{n},1\n")
        ingest.ingest_files(binary(spark, tmp_path / f"in{n}"), tables, settings, f"b{n}")
    narrow = tables.read("post_analytics").select("post_id", "post_date", "impressions", "ctr")
    assert "post_content" not in narrow._jdf.queryExecution().executedPlan().toString()
    row = tables.read("post_analytics").first()
    assert (row.post_title, row.hashtags, row.post_url, row.impressions) == ("a #t2", ["#t2"], "https://x/1", 2)


def test_rows_without_a_key_are_refused_though_folded(spark, tmp_path, settings):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    tables.begin("b/1", lambda: "b")
    rows = spark.createDataFrame([("x", 1), (None, 2)], "post_id string, impressions long")
    assert tables.change("post_analytics", "b/1", lambda: rows, folded=True)["rows"] == 1
    tables.finish("b/1")
    assert [r.post_id for r in tables.read("post_analytics").collect()] == ["x"]
    assert [r.reason for r in tables.read("rejected_rows").collect()] == ["part of the key is missing"]


def test_stream_takes_exports_in_the_order_of_their_names(spark, tmp_path, monkeypatch):
    """Tasks write files side by side, so the file of a later day may be older; its post is the last one all the same."""
    folder, head = str(tmp_path / "exports"), "Post title,Post link,Created date,Impressions,Clicks,Likes,Comments,Reposts\n"
    for n in range(6):
        put(folder, f"part-0000{n}-x-c000.csv", head + f"p,https://x/urn:li:activity:1,01/0{n + 1}/2024,{9 - n},1,1,1,1\n")
        os.utime(f"{folder}/part-0000{n}-x-c000.csv", (1_700_000_000 - 60 * n,) * 2)
    monkeypatch.setattr(queries_files, "_written_exports", lambda *a: folder)
    row = queries_files.stream_ingest(spark, "unused").first()
    assert (row.post_date, row.impressions) == ("2024-01-06", 9)
    times = [r.mtime for r in list_files(spark, folder).orderBy("file_name").collect()]
    assert times == sorted(set(times))
