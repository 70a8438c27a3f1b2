"""Retention and the ledger of processed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings


def cutoff(settings: Settings, days: int = K.RETENTION_DAYS) -> Column:
    return settings.now - F.make_dt_interval(F.lit(days))


def expired(settings: Settings, days: int = K.RETENTION_DAYS, company_id: str | None = None) -> Column:
    """Collected before the cutoff; never NULL."""
    old = F.coalesce(F.col("date_collected") < cutoff(settings, days), F.lit(False))
    return old if company_id is None else old & (F.col("company_id") == company_id)


def retained(
    table: DataFrame, settings: Settings, days: int = K.RETENTION_DAYS, company_id: str | None = None
) -> DataFrame:
    """The rows that stay. Rows without a date are not old, so they stay."""
    return table.where(~expired(settings, days, company_id))


def expired_files(files: DataFrame, settings: Settings, days: int = K.RETENTION_DAYS) -> DataFrame:
    """Archived files past the retention time: a list to act on, nothing is deleted."""
    return files.where(F.col("mtime") < cutoff(settings, days))


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not hold yet; a file written again later counts as new."""
    return files.join(ledger.select("path", "mtime"), ["path", "mtime"], "left_anti")


def ledger_rows(chunks: DataFrame, settings: Settings, batch_id: str) -> DataFrame:
    """One row per decoded file: rows, state and error, for unreadable files too."""
    n_rows = F.col("n_rows") if "n_rows" in chunks.columns else F.size("rows")
    return chunks.groupBy("path", "mtime").agg(
        F.first("file_name").alias("file_name"),
        F.first("n_bytes").alias("n_bytes"),
        F.first("kind").alias("kind"),
        F.sum(n_rows).cast("bigint").alias("rows"),
        F.first("status").alias("status"),
        F.first("error").alias("error"),
    ).select(
        "path", "file_name", "mtime", "n_bytes", "kind", "rows", "status", "error",
        F.lit(batch_id).alias("batch_id"), settings.now.alias("processed_at"),
    )


def table_ledger_rows(rows: DataFrame, settings: Settings, batch_id: str) -> DataFrame:
    """One row per file of ``read_large_csv``. Spark's reader hands out neither time nor size of a row's file."""
    return rows.groupBy(F.col("source_file").alias("path")).agg(F.count("*").alias("rows")).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.lit(None).cast("timestamp").alias("mtime"),
        F.lit(None).cast("long").alias("n_bytes"), F.lit("csv").alias("kind"), "rows", F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(batch_id).alias("batch_id"), settings.now.alias("processed_at"),
    )


def last_processed(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == "ok").agg(F.max("mtime").alias("last_file_processed"))


def validation_rows(posts: DataFrame) -> DataFrame:
    """Posts as flat text columns for the audit CSV; lists become JSON."""
    lists = {c: F.to_json(F.col(c)) for c in ("hashtags", "mentions") if c in posts.columns}
    return posts.withColumns(lists).drop("arrival", "date_missing")


def write_validation_report(posts: DataFrame, folder: str, batch_id: str) -> str:
    """One CSV folder per batch and source file."""
    path = f"{folder.rstrip('/')}/validation_{batch_id}"
    validation_rows(posts).hint("rebalance", "source_file").write.mode("overwrite").partitionBy("source_file").option("header", True).csv(path)
    return path


def write_date_report(found: DataFrame, folder: str, batch_id: str) -> str:
    """The result of ``reports.ambiguous_dates`` as CSV, one folder per batch."""
    path = f"{folder.rstrip('/')}/date_discrepancies_{batch_id}"
    found.write.mode("overwrite").option("header", True).csv(path)
    return path
