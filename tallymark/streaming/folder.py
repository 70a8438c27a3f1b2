"""New files of a folder as a stream: each file once, each batch repeatable."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..plans.ingest import ingest_files
from ..schema import FILE
from ..sources.files import file_name, is_download
from ..sources.tables import PageTables


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def start_batches(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """``every`` such as "5 minutes" keeps polling; None takes what is there and ends."""
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _few_listing_tasks(spark: SparkSession) -> None:
    """Spark looks at each file of a batch in a task of its own, up to this number of tasks; a few a core do as well."""
    few = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING_TASKS)) > few:
        spark.conf.set(_LISTING_TASKS, str(few))


def stream_files(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """The files of a folder as a stream of ``binaryFile`` rows. Sets the number of listing tasks of the session."""
    _few_listing_tasks(spark)
    return (
        spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", "36500d")  # the default leaves out files a week older than the newest
        .load(folder)
    )


def watch_folder(
    spark: SparkSession, folder: str, tables: PageTables, settings: Settings, checkpoint: str,
    every: str | None = None, max_files: int = 1000, clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Ingest finished downloads as they land.

    The checkpoint hands out each file once. A batch cut off half-way comes back
    under the same number and is finished from its staged rows. Batches are known by
    the stream's own id, which its checkpoint keeps, so streams into the same tables
    do not meet.
    """
    files = stream_files(spark, folder, max_files).where(is_download(file_name()))
    stream: list[str] = []

    def ingest(batch: DataFrame, number: int) -> None:
        if not stream:
            stream.append(spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"])
        ingest_files(batch, tables, settings.at(clock()), f"{number:08d}", operation=f"stream-{stream[0]}")

    return start_batches(files, ingest, checkpoint, every)
