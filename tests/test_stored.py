"""Stored tables: change sets, versions, compaction, order of exports, upkeep without reading."""

import itertools
import os
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallymark import constants as K
from tallymark.config import Settings
from tallymark.operators import merge
from tallymark.plans import ingest, queries_files, queries_runs
from tallymark.sources.tables import OtherWriter, PageTables
from test_merge import incoming_frame

HEADER = "Post title,Post link,Content type,Created date,Impressions,Clicks\n"


def put(folder, name, content, at=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(content)
    if at is not None:
        os.utime(path, (at.timestamp(), at.timestamp()))


def rows_of(df, *drop):
    return sorted(map(repr, (r.asDict() for r in df.drop(*drop).collect())))


def store(spark, tables, key, settings, rows):
    """Post rows as one batch: (id, impressions, title)."""
    full = [(i, n, n % 3, n % 2, 0, 0, n, 0.5, 1.5, title, at) for at, (i, n, title) in enumerate(rows)]
    posts = incoming_frame(spark, full).withColumn("source_file", F.lit("f"))
    tables.begin(key, lambda: key)
    ingest.store_posts(tables, key, key, posts, settings)
    return posts


def publish(spark, tables, key, settings, rows):
    posts = store(spark, tables, key, settings, rows)
    tables.finish(key)
    return posts


def files_below(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


@pytest.mark.parametrize("policy", ["max", "new"])
def test_folding_is_merging(spark, tmp_path, policy):
    """Reading folds the changes as one merge per batch would, before and after compaction."""
    plain = None
    tables = PageTables(spark, str(tmp_path / "t"), Settings(key_buckets=3))
    batches = [
        [("a", 5, "a1"), ("b", 7, "b1"), ("a", 3, "a2")], [("a", 4, "a3"), ("c", 1, "c1")], [("b", 9, "b2"), ("d", 0, "d")], [("a", 9, "a4")],
    ]
    for i, rows in enumerate(batches):
        settings = Settings(as_of=datetime(2025, 9, 1 + i), policy=policy)
        posts = publish(spark, tables, f"b/{i}", settings, rows)
        base = spark.createDataFrame([], tables.read("post_analytics").schema) if plain is None else plain
        plain = merge.merge_posts(base, posts.drop("source_file"), settings)
        expected = rows_of(plain)
        assert rows_of(tables.read("post_analytics")) == expected
        if i == 1:
            assert "post_analytics" in tables.compact(f"k{i}")
            assert rows_of(tables.read("post_analytics")) == expected
    history = rows_of(tables.read("post_metrics_history"))
    tables.compact("last")
    assert rows_of(tables.read("post_analytics")) == expected and rows_of(tables.read("post_metrics_history")) == history
    assert all(not entry["changes"] for entry in tables._state().values()) and tables.compact("none") == []


def test_a_batch_leaves_the_base_untouched(spark, tmp_path, settings):
    root = str(tmp_path / "t")
    tables = PageTables(spark, root, settings)
    publish(spark, tables, "b/1", settings, [(f"p{i}", i, "t") for i in range(3000)])
    tables.compact("k1")
    before = files_below(root)
    publish(spark, tables, "b/2", settings, [(f"p{i}", i + 1, "u") for i in range(1000)])
    after = files_below(root)
    assert before.items() <= after.items()
    new = [p for p in after if p not in before and "post_analytics" in p]
    assert new and all("change-b-2" in p for p in new)
    assert tables.read("post_analytics").where("post_title = 'u'").count() == 1000 and tables.read("post_analytics").count() == 3000


def test_reading_changes_does_not_shuffle_the_base(spark, tmp_path, settings):
    """Neither when the keys of the changes are broadcast, nor when they are too many for that."""
    tables = PageTables(spark, str(tmp_path / "it's"), settings)
    publish(spark, tables, "b/1", settings, [(f"p{i}", i, "t") for i in range(300)])
    tables.compact("k1")
    publish(spark, tables, "b/2", settings, [(f"p{i}", i + 1, "u") for i in range(290, 310)])
    expected = rows_of(tables.read("post_analytics"))
    assert len(expected) == 310
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tables.read("post_analytics")
        assert rows_of(found) == expected
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("Bucketed: true") == 2, plan
        sides = re.findall(r"SortMergeJoin .*Left(?:Anti|Semi).*\n((?:.*\n)*?).*Scan parquet", plan)
        assert len(sides) == 2 and not any("Exchange" in side for side in sides), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A session that does not know the base yet finds its buckets too.
    spark.sql(f"DROP TABLE {tables._catalog_name(tables._state()['post_analytics']['base'])}")
    assert rows_of(PageTables(spark, str(tmp_path / "it's"), settings).read("post_analytics")) == expected


def test_a_reader_keeps_its_version(spark, tmp_path, settings):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    publish(spark, tables, "b/1", settings, [("a", 1, "t")])
    opened = tables.read("post_analytics")
    store(spark, tables, "b/2", settings, [("b", 1, "t")])
    assert tables.read("post_analytics").count() == 1, "nothing shows before the pointer moves"
    tables.finish("b/2")
    tables.compact("k")
    assert [r.post_id for r in opened.collect()] == ["a"] and tables.read("post_analytics").count() == 2
    tables.forget(versions=1)
    assert tables.read("post_analytics").count() == 2
    assert not any("change-b" in n for n in os.listdir(tmp_path / "t" / "post_analytics"))


def test_the_second_of_two_writers_gets_an_error(spark, tmp_path, settings):
    one, two = (PageTables(spark, str(tmp_path / "t"), settings) for _ in range(2))
    store(spark, one, "b/1", settings, [("a", 1, "t")])
    store(spark, two, "b/2", settings, [("b", 1, "t")])
    one.finish("b/1")
    with pytest.raises(OtherWriter):
        two.finish("b/2")
    assert [r.post_id for r in two.read("post_analytics").collect()] == ["a"]
    publish(spark, two, "b/2", settings, [("b", 1, "t")])
    assert sorted(r.post_id for r in two.read("post_analytics").collect()) == ["a", "b"]
    one.finish("b/1")  # published already: nothing happens
    assert one.read("analytics_history").count() == 2


def test_changes_of_two_policies_do_not_mix(spark, tmp_path, settings):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    publish(spark, tables, "b/1", settings, [("a", 5, "t")])
    newest = Settings(as_of=settings.as_of, policy="new")
    with pytest.raises(ValueError, match="compact"):
        publish(spark, tables, "b/2", newest, [("a", 3, "u")])
    tables.compact("k")
    publish(spark, tables, "b/3", newest, [("a", 3, "u")])
    assert tables.read("post_analytics").first().impressions == 3


def test_keys_are_checked_when_a_batch_publishes(spark, tmp_path, settings):
    """A planted double and a missing key are found; the others are published."""
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], "post_id string, impressions long")
    for _ in range(2):  # the second time from what is written
        if tables.begin("b/1", lambda: "x") is None:
            assert tables.change("post_analytics", "b/1", lambda: rows)["rows"] == 2
    tables.finish("b/1")
    assert sorted(r.post_id for r in tables.read("post_analytics").collect()) == ["a", "c"]
    rejected = [(r.path, r.reason, '"impressions":%d' % n in r.record) for r, n in zip(tables.read("rejected_rows").orderBy("record").collect(), (4, 2, 3))]
    assert sorted(rejected) == [
        ("post_analytics", "part of the key is missing", True), ("post_analytics", "the key occurs twice", True), ("post_analytics", "the key occurs twice", True),
    ]


def test_dropped_rows_may_come_back(spark, tmp_path):
    tables = PageTables(spark, str(tmp_path / "t"), Settings())
    old, now = Settings(as_of=datetime(2025, 1, 1)), Settings(as_of=datetime(2025, 9, 1))
    publish(spark, tables, "b/1", old, [("a", 9, "old"), ("b", 9, "old")])
    publish(spark, tables, "b/2", now, [("c", 1, "new")])
    ingest.clean_up(tables, now, "c1")
    assert [r.post_id for r in tables.read("post_analytics").collect()] == ["c"]
    publish(spark, tables, "b/3", now, [("a", 2, "again")])
    row = tables.read("post_analytics").where("post_id = 'a'").first()
    assert (row.impressions, row.date_collected, row.updated_at) == (2, now.as_of, None)
    tables.compact("k")
    assert sorted(r.post_id for r in tables.read("post_analytics").collect()) == ["a", "c"]


def test_a_clean_up_without_old_rows_reads_nothing(spark, tmp_path, settings, monkeypatch):
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    publish(spark, tables, "b/1", settings, [("a", 1, "t")])
    tables.compact("k")
    publish(spark, tables, "b/2", settings, [("b", 1, "t")])
    monkeypatch.setattr(PageTables, "read", lambda *a: pytest.fail("a table was read"))
    version = tables.version()
    ingest.clean_up(tables, settings, "c1")
    assert tables.version() == version
    monkeypatch.undo()
    ingest.clean_up(tables, settings.at(settings.as_of + timedelta(days=200)), "c2")
    assert tables.read("post_analytics").isEmpty()


def test_exports_count_by_their_time(spark, tmp_path):
    """All orders of three exports give the same posts."""
    settings = Settings(as_of=datetime(2025, 9, 1), by_export_time=True, key_buckets=2)
    exports = [[("a", 50, "old"), ("b", 1, "only")], [("a", 90, "newer")], [("a", 70, "newest"), ("c", 2, "last")]]
    stamps = dict.fromkeys(("date_collected", "created_at", "updated_at"), settings.now)
    seen = set()
    for n, order in enumerate(itertools.permutations(range(3))):
        tables = PageTables(spark, str(tmp_path / f"t{n}"), settings)
        for i in order:
            at = F.lit(datetime(2025, 1 + i, 1).isoformat()).cast("timestamp")
            full = [(k, v, v % 3, v % 2, 0, 0, v, 0.5, 1.5, title, 0) for k, v, title in exports[i]]
            posts = incoming_frame(spark, full).withColumn("arrival", F.struct(at.alias("exported_at"), "arrival.*"))
            tables.begin(f"b/{i}", lambda: "x")
            tables.change(
                "post_analytics", f"b/{i}",
                lambda posts=posts: merge.fold_posts(posts).withColumns(stamps | {"exported_at": F.col("arrival.exported_at")}), policy="max",
            )
            tables.finish(f"b/{i}")
            if n % 3 == 1 and i == order[1]:
                tables.compact("k")
        seen.add(tuple(rows_of(tables.read("post_analytics"), "updated_at")))
    assert len(seen) == 1 and any("'newest'" in r and "'impressions': 90" in r for r in seen.pop())


def test_the_time_of_a_file_is_its_export_time(spark, tmp_path):
    settings = Settings(as_of=datetime(2025, 9, 1), by_export_time=True, key_buckets=2)
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    for month, title in ((3, "newest"), (1, "old")):
        folder = str(tmp_path / str(month))
        put(folder, "posts.csv", HEADER + f"{title},https://x/1,,08/06/2025,{90 - month},5\n", datetime(2025, month, 1))
        ingest.ingest_folder(spark, folder, tables, settings, f"b{month}")
    row = tables.read("post_analytics").first()
    assert (row.post_title, row.impressions) == ("newest", 89)


def test_jobs_of_a_batch(spark, tmp_path, settings):
    put(tmp_path / "in", "1_posts.csv", HEADER + "a,https://x/1,,08/06/2025,100,5\n")
    put(tmp_path / "in", "2_followers.csv", "Location,Members\nLagos,3\n")
    tables = PageTables(spark, str(tmp_path / "t"), settings)
    files = spark.read.format("binaryFile").load(str(tmp_path / "in"))
    spark.sparkContext.setJobGroup("counted", "jobs of one batch")
    try:
        assert ingest.ingest_files(files, tables, settings, "b1") == ingest.Ingested(1, 1, 2)
    finally:
        spark.sparkContext.setJobGroup("others", "others")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) <= 24


def test_the_posts_of_a_batch_are_made_once(spark, tmp_path, settings, monkeypatch):
    """What a batch reads several times is written first."""
    rows = [(n, datetime(2024, 1, 1 + n % 28, n % 24), n % 7, "view", 1.0, "{}") for n in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    thirds = queries_files._thirds(spark, str(tmp_path))
    assert all("Aggregate" not in part._jdf.queryExecution().optimizedPlan().toString() for part in thirds)
    assert sum(part.count() for part in thirds) == len({(r[1], r[2]) for r in rows})
    given = []
    monkeypatch.setattr(queries_runs.ingest, "store_posts", lambda tables, key, batch_id, posts, settings: given.append(posts))
    tables = PageTables(spark, str(tmp_path / "tables"), settings)
    queries_runs._posts_batch(tables, "b/1", queries_files.hourly_posts(spark.read.parquet(f"{tmp_path}/events.parquet"), settings), settings)
    assert "Aggregate" not in given[0]._jdf.queryExecution().optimizedPlan().toString()
