"""A folder of mails as a stream: digests into the company tables, attached exports into all tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..plans.ingest import ingest_digests, ingest_files
from ..sources.mail import attached_files, decode_messages, digests
from ..sources.tables import PageTables
from .folder import start_batches, stream_files, utc_now


def watch_mails(
    spark: SparkSession, folder: str, tables: PageTables, settings: Settings, checkpoint: str,
    every: str | None = None, max_files: int = 1000, clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Ingest mails as they land, each once; every file of the folder is taken for a mail.

    A batch is two ingests under one number of the stream, the digests and the attached
    files. Its mails are read once; a batch cut off between the two comes back and only
    does what is left. ``every`` such as "5 minutes" keeps polling, and a stream that was
    stopped goes on where it was.
    """
    stream: list[str] = []

    def ingest(batch: DataFrame, number: int) -> None:
        if not stream:
            stream.append(spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"])
        batch_id, now = f"{stream[0]}-{number:08d}", settings.at(clock())
        messages, _ = tables.stage(f"mails/{batch_id}", "messages", lambda: decode_messages(batch))
        ingest_digests(digests(messages), tables, now, batch_id)
        ingest_files(attached_files(messages), tables, now, batch_id, operation="attached")
        tables.forget_batch(f"mails/{batch_id}")

    return start_batches(stream_files(spark, folder, max_files), ingest, checkpoint, every)
