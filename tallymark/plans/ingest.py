"""End-to-end runs: exports, demographics and digests into the target tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..config import Settings
from ..functions.digest import with_digest_numbers
from ..operators import maintenance, merge, rollups
from ..operators.demographics import demographics_from_chunks
from ..operators.posts import posts_from_chunks, posts_from_table
from ..session import side_by_side
from ..sources.csv_files import posts_from_csv_folder, read_csv_folder
from ..sources.files import dealt_out, decode_chunks, file_name, is_export_name, list_files, with_route
from ..sources.tables import PageTables, table_schema


@dataclass(frozen=True)
class Ingested:
    posts: int
    demographics: int
    files: int


def _mark(rows: DataFrame, *columns: str) -> str:
    """A digest of some columns that does not depend on the order of the rows."""
    found = rows.select(*columns).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("x"), F.sum(F.hash(*columns)).alias("s")).first()
    return f"{found['n']}:{found['x']}:{found['s']}"


def _with_all_columns(df: DataFrame, table: str) -> DataFrame:
    """The columns of the target table, absent ones as NULL, plus ``arrival``."""
    schema = table_schema(table)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent).select(*schema.names, "arrival", "source_file")


def _dated(posts: DataFrame, chunks: DataFrame, settings: Settings) -> DataFrame:
    """With the time of the file before all else in the order of rows, if exports are to count by it."""
    if not settings.by_export_time:
        return posts
    times = chunks.groupBy(F.col("file_name").alias("source_file")).agg(F.max("mtime").alias("exported_at"))
    return posts.join(times, "source_file", "left").withColumn("arrival", F.struct("exported_at", "arrival.*")).drop("exported_at")


def store_posts(tables: PageTables, key: str, batch_id: str, posts: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """Changes to the posts, a snapshot of the day, a roll-up. ``posts`` must be staged and not empty. Returns what was taken."""
    stamps = dict.fromkeys(("date_collected", "created_at", "updated_at"), settings.now)
    if settings.by_export_time:
        stamps["exported_at"] = F.col("arrival.exported_at")
    if settings.manual:
        fresh, counts = tables.stage(
            key,
            "new_posts",
            lambda: merge.insert_only(
                tables.near("post_analytics", posts), _with_all_columns(posts, "post_analytics"), K.POST_KEY
            ),
        )
        side_by_side(
            lambda: tables.change("post_analytics", key, lambda: fresh, policy=settings.policy),
            lambda: _store_summaries(tables, key, batch_id, fresh, settings),
        )
        return fresh, counts["rows"]
    side_by_side(
        lambda: tables.change(
            "post_analytics", key,
            lambda: merge.fold_posts(posts.drop("date_missing", "source_file"), settings.policy).withColumns(stamps),
            policy=settings.policy, folded=True,
        ),
        lambda: tables.change("post_metrics_history", key, lambda: merge.history_rows(posts, settings), folded=True),
        lambda: _store_summaries(tables, key, batch_id, posts, settings),
    )
    return posts, None


def _followers(tables: PageTables, settings: Settings) -> DataFrame:
    """One row: the follower count of the company."""
    mine = F.col("company_id") == settings.company_id
    return rollups.current_followers(
        tables.read("follower_analytics").where(mine), tables.read("company_analytics").where(mine),
        settings.unknown_followers,
    )


def _store_summaries(tables: PageTables, key: str, batch_id: str, posts: DataFrame, settings: Settings) -> None:
    """One summary per file goes to the history; the last file's becomes the company row."""
    per_file = rollups.company_rollup(posts, ["company_id", "source_file"], settings.rate_scale)
    staged, _ = tables.stage(
        key, "summaries", lambda: rollups.summary_rows(per_file, settings, _followers(tables, settings))
    )

    def company() -> None:
        rows = merge.last_per_key(staged, K.COMPANY_KEY, "source_file").drop("source_file")
        tables.change("company_analytics", key, lambda: rows, folded=True)

    def history() -> None:
        tables.change("analytics_history", key, lambda: staged.withColumn("batch_id", F.lit(batch_id)))

    side_by_side(company, *([] if settings.manual else [history]))


def store_demographics(tables: PageTables, key: str, records: DataFrame, settings: Settings) -> tuple[DataFrame, int | None]:
    """Changes to the follower rows. ``records`` must be staged and not empty. Returns what was taken."""
    if settings.manual:
        fresh, counts = tables.stage(
            key, "new_demographics",
            lambda: merge.new_demographics(tables.near("follower_analytics", records), records),
        )
        tables.change("follower_analytics", key, lambda: fresh)
        return fresh, counts["rows"]
    tables.change("follower_analytics", key, lambda: merge.last_per_key(records, K.FOLLOWER_KEY))
    return records, None


def ingest_files(
    files: DataFrame, tables: PageTables, settings: Settings, batch_id: str, operation: str = "ingest",
    report: str | None = None,
) -> Ingested:
    """``binaryFile`` rows into the tables. Repeating a batch repeats nothing.

    A batch id that comes back with other files is an error. ``report`` names a folder
    for the validation report of the posts taken. What a batch writes rests on the chunks of
    its files and on the tables as published, so posts, demographics and ledger are written side by side.
    """
    named = files.where(is_export_name(file_name(), settings.manual))
    key = f"{operation}/{batch_id}"
    done = tables.begin(key, lambda: _mark(named.select("path", "modificationTime").coalesce(1), "path", "modificationTime"))
    if done is not None:
        return Ingested(done["posts"], done["demographics"], done["files"])
    # Decoding is the costly step and three consumers follow, so its result is written once.
    chunks, seen = tables.stage(
        key, "routed_chunks", lambda: with_route(decode_chunks(named, settings.manual), settings.manual),
        files=F.count_if((F.col("first_row") == 0) & (F.col("sheet_idx") == 0)),
        posts=F.count_if(F.col("route") == "posts"), demographics=F.count_if(F.col("route") == "demographics"),
    )

    def routed(route: str) -> DataFrame:
        return chunks.where(F.col("route") == route)

    def known(rows: DataFrame, route: str) -> DataFrame:
        # Where a batch has no such file, Spark is told so: it plans no rows, without a job and without code to compile.
        return rows if seen[route] else rows.where(F.lit(False))

    def posts() -> tuple[DataFrame, int]:
        def records() -> DataFrame:
            dealt = dealt_out(routed("posts"), seen["posts"], seen["files"])
            return known(_dated(posts_from_chunks(dealt, settings).drop("path"), chunks, settings), "posts")

        staged, counts = tables.stage(key, "posts", records)
        if not counts["rows"]:
            return staged, 0
        taken, new = store_posts(tables, key, batch_id, staged, settings)
        return taken, counts["rows"] if new is None else new

    def demographics() -> tuple[DataFrame, int]:
        def records() -> DataFrame:
            return known(demographics_from_chunks(routed("demographics"), settings, _followers(tables, settings)), "demographics")

        staged, counts = tables.stage(key, "demographics", records)
        if not counts["rows"]:
            return staged, 0
        taken, new = store_demographics(tables, key, staged, settings)
        return taken, counts["rows"] if new is None else new

    def ledger() -> int:
        return tables.change("file_ledger", key, lambda: maintenance.ledger_rows(chunks, settings, batch_id))["rows"]

    def older_ledger(taken: list[DataFrame]) -> int:
        # The older scan files away only what gave records, so the rest is tried again.
        names = [t.select(F.col("source_file").alias("file_name")) for t in taken]
        fruitful = names[0].unionAll(names[1]).distinct()
        rows = maintenance.ledger_rows(chunks, settings, batch_id).join(fruitful, "file_name", "left_semi")
        return tables.change("file_ledger", key, lambda: rows)["rows"]

    if settings.manual:
        (taken_posts, n_posts), (taken_records, n_records) = side_by_side(posts, demographics)
        n_files = older_ledger([taken_posts, taken_records])
    else:
        (taken_posts, n_posts), (n_files, (_, n_records)) = side_by_side(posts, lambda: (ledger(), demographics()))
    if report is not None:
        maintenance.write_validation_report(taken_posts, report, batch_id)
    result = Ingested(n_posts, n_records, n_files)
    tables.finish(key, posts=result.posts, demographics=result.demographics, files=result.files)
    return result


def ingest_folder(
    spark: SparkSession, folder: str, tables: PageTables, settings: Settings, batch_id: str, report: str | None = None
) -> Ingested:
    """The files of a folder that the ledger does not hold yet, of any size and name.

    A batch keeps the list of its files when it begins, so one that was cut off is finished with the same
    files, whatever has landed since.
    """
    key = f"ingest/{batch_id}"

    def fresh() -> DataFrame:
        listed = list_files(spark, folder).where(is_export_name(F.col("file_name"), settings.manual))
        # The comparison with the ledger moves names only; the contents meet just the names that are new.
        return maintenance.unprocessed(listed, tables.read("file_ledger")).select("path")

    if tables.done(key):
        paths = fresh()
        if paths.isEmpty():
            return Ingested(0, 0, 0)
    else:
        paths, counts = tables.stage(key, "files", fresh)
        if not counts["rows"]:
            tables.forget_batch(key)
            return Ingested(0, 0, 0)
    files = spark.read.format("binaryFile").load(folder).join(paths, "path", "left_semi")
    return ingest_files(files, tables, settings, batch_id, report=report)


def ingest_large_csv(rows: DataFrame, tables: PageTables, settings: Settings, batch_id: str) -> int:
    """Posts out of ``read_large_csv`` (files of one layout, any size) into the tables, and their files into the ledger."""
    key = f"large_csv/{batch_id}"

    def mark() -> str:
        listed = rows.sparkSession.read.format("binaryFile").load(list(rows.inputFiles()))
        return _mark(listed, "path", "modificationTime", "length")

    done = tables.begin(key, mark)
    if done is not None:
        return done["posts"]
    posts, counts = tables.stage(key, "posts", lambda: posts_from_table(rows, settings))
    n = counts["rows"]
    if n:
        _, new = store_posts(tables, key, batch_id, posts, settings)
        n = n if new is None else new
    tables.change("file_ledger", key, lambda: maintenance.table_ledger_rows(rows, settings, batch_id))
    tables.finish(key, posts=n)
    return n


def ingest_csv_folder(spark: SparkSession, folder: str, tables: PageTables, settings: Settings, batch_id: str) -> int:
    """Posts out of all CSV files of a folder through Spark's reader; what cannot be placed goes to ``rejected_rows``."""
    key = f"csv/{batch_id}"
    done = tables.begin(key, lambda: _mark(list_files(spark, folder), "path", "mtime", "length"))
    if done is not None:
        return done["posts"]
    found = read_csv_folder(spark, folder, settings)
    n = 0
    if found.tables:
        posts, counts = tables.stage(key, "posts", lambda: posts_from_csv_folder(found, settings))
        n = counts["rows"]
        if n:
            _, new = store_posts(tables, key, batch_id, posts, settings)
            n = n if new is None else new
        places = [t.select("source_file") for t in found.tables]
        tables.change("file_ledger", key, lambda: maintenance.table_ledger_rows(reduce(DataFrame.unionAll, places), settings, batch_id))
    tables.change("rejected_rows", key, lambda: found.rejects.withColumn("batch_id", F.lit(batch_id)))
    tables.finish(key, posts=n)
    return n


def digest_summaries(messages: DataFrame, settings: Settings) -> DataFrame:
    """One company summary per digest mail, whatever its body holds."""
    return with_digest_numbers(messages).withColumns({
        "company_id": F.lit(settings.company_id),
        "company_name": F.lit(settings.company_name),
        "date_collected": settings.now,
    })


def ingest_digests(messages: DataFrame, tables: PageTables, settings: Settings, batch_id: str) -> int:
    """Digest mails into the company row (the last message wins) and the history (one row each)."""
    key = f"digests/{batch_id}"
    done = tables.begin(key, lambda: _mark(messages, "path", "body"))
    if done is not None:
        return done["messages"]
    staged, counts = tables.stage(
        key, "summaries",
        lambda: digest_summaries(messages, settings).withColumn("arrival", F.struct("path")),
    )
    tables.change("company_analytics", key, lambda: merge.last_per_key(staged, K.COMPANY_KEY))
    tables.change("analytics_history", key, lambda: staged.withColumn("batch_id", F.lit(batch_id)))
    tables.finish(key, messages=counts["rows"])
    return counts["rows"]


def clean_up(tables: PageTables, settings: Settings, batch_id: str, days: int = K.RETENTION_DAYS) -> None:
    """Drop posts and follower rows collected before the retention time.

    A table whose oldest row is known to be younger is not read; of others the keys to drop are written, nothing else.
    """
    key = f"clean_up/{batch_id}"
    if tables.begin(key, lambda: f"{settings.as_of.isoformat()} {days}") is not None:
        return
    for name, keys in (("post_analytics", K.POST_KEY), ("follower_analytics", K.FOLLOWER_KEY)):
        oldest = tables.oldest(name)
        if tables.is_empty(name) or (oldest is not None and oldest >= settings.as_of - timedelta(days=days)):
            continue
        tables.change(name, key, lambda: tables.read(name).where(maintenance.expired(settings, days)).select(*keys), "drop")
    tables.finish(key)


def reclassify_posts(tables: PageTables, settings: Settings, batch_id: str) -> None:
    """Give posts stored under a distribution word a real type."""
    key = f"reclassify/{batch_id}"
    if tables.begin(key, lambda: settings.company_id) is not None:
        return

    def typed() -> DataFrame:
        stored = tables.read("post_analytics").where(merge.needs_type(settings.company_id))
        typed = merge.reclassify(stored, settings, settings.company_id).select(*K.POST_KEY, "post_type", "updated_at")
        return typed.withColumn("exported_at", settings.now) if settings.by_export_time else typed

    tables.change("post_analytics", key, typed, "set")
    tables.finish(key)
