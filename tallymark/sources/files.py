"""Export files as DataFrames: decoded chunks for small files, Spark's reader for large CSV."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .. import constants as K
from ..functions.strings import ends_with_any, has_any
from ..schema import CHUNK
from .decode import Cell, chunk_records

CHUNK_ROWS = 2000
_FLUSH_CELLS = 100_000


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name, size and time of all files in a folder; the contents are not read."""
    return (
        spark.read.format("binaryFile").load(folder)
        .select("path", file_name().alias("file_name"), F.col("modificationTime").alias("mtime"), "length")
    )


def file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


# --- predicates on names ----------------------------------------------------------
def file_route(name: Column, manual: bool = False) -> Column:
    """``posts`` or ``demographics``. A name with words of both goes to posts, as does one with none."""
    low = F.lower(name)
    posts = K.MANUAL_POSTS_FILE_WORDS if manual else K.POSTS_FILE_WORDS
    return (
        F.when(has_any(low, posts), "posts")
        .when(has_any(low, K.DEMOGRAPHICS_FILE_WORDS), "demographics")
        .otherwise("posts")
    )


def is_export_name(name: Column, manual: bool = False) -> Column:
    """An extension the folder scan takes; the older scan skips archives and ``~`` files."""
    if manual:
        return ends_with_any(name, K.MANUAL_EXTENSIONS) & ~name.startswith("~")
    return ends_with_any(F.lower(name), K.EXPORT_EXTENSIONS)


def is_partial_download(name: Column) -> Column:
    return ends_with_any(F.lower(name), K.PARTIAL_DOWNLOAD_SUFFIXES)


def is_download(name: Column) -> Column:
    """A finished download that looks like an export."""
    low = F.lower(name)
    return ~is_partial_download(name) & ends_with_any(low, K.EXPORT_EXTENSIONS) & has_any(low, K.DOWNLOAD_WORDS)


def _offsets(lists: list[list]) -> pa.Array:
    return pa.array(list(accumulate(map(len, lists), initial=0)), pa.int32())


def _cell_lists(sheets: list[list[list[Cell]]], kind: pa.ListType) -> pa.ListArray:
    """Rows of cells column by column, which is several times faster than cell by cell."""
    rows = [row for sheet in sheets for row in sheet]
    cells = list(zip(*[cell for row in rows for cell in row])) or [(), (), ()]
    fields = list(kind.value_type.value_type)
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cells, fields)], fields=fields)
    inner = pa.ListArray.from_arrays(_offsets(rows), flat, type=kind.value_type)
    return pa.ListArray.from_arrays(_offsets(sheets), inner, type=kind)


def _chunk_batch(records: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    columns = []
    for field in schema:
        values = [record[field.name] for record in records]
        columns.append(_cell_lists(values, field.type) if field.name in ("head", "rows") else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


# --- small files --------------------------------------------------------------------
def decode_chunks(files: DataFrame, manual: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``binaryFile`` rows to chunks of cells.

    Each chunk carries the first rows of its sheet, so finding the header and the
    columns needs no shuffle, however many rows one file holds.
    """
    schema = to_arrow_schema(CHUNK)
    encodings = K.MANUAL_ENCODINGS if manual else K.ENCODINGS

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, cells = [], 0
        for batch in batches:
            for path, mtime, content in zip(*batch.columns):
                for record in chunk_records(path.as_py(), mtime.as_py(), content.as_py(), encodings, chunk_rows):
                    records.append(record)
                    cells += sum(len(row) for row in record["rows"])
                    if cells >= _FLUSH_CELLS:
                        yield _chunk_batch(records, schema)
                        records, cells = [], 0
        if records:
            yield _chunk_batch(records, schema)

    return files.select("path", "modificationTime", "content").mapInArrow(decode, CHUNK)


def with_route(chunks: DataFrame, manual: bool = False) -> DataFrame:
    """The route and the number of rows of each chunk as columns of their own. Written so, chunks of another route are passed
    over by their statistics, and who asks for the number of rows reads no cell."""
    return chunks.withColumns({"route": file_route(F.col("file_name"), manual), "n_rows": F.size("rows")})


def dealt_out(chunks: DataFrame, n_chunks: int, n_files: int) -> DataFrame:
    """A task reads the chunks of whole files, so few large files keep few cores busy; then their chunks are dealt to all cores."""
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    if n_files >= cores or n_chunks <= n_files:
        return chunks
    n = min(n_chunks, cores)
    return chunks.repartitionById(n, F.pmod(F.hash("path", "sheet_idx") + F.floor(F.col("first_row") / CHUNK_ROWS), F.lit(n)).cast("int"))


def read_chunks(spark: SparkSession, folder: str, manual: bool = False) -> DataFrame:
    """All export files of a folder as chunks, whatever their size; a task holds one file at a time."""
    files = spark.read.format("binaryFile").load(folder)
    return decode_chunks(files.where(is_export_name(file_name(), manual)), manual)


# --- large CSV -----------------------------------------------------------------------
def read_large_csv(
    spark: SparkSession, paths: str | list[str], multiline: bool | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """CSV files of one layout and encoding, header on row 0, through Spark's own reader.

    One file splits over many tasks, unless cells hold line breaks: then each file is one
    task. A pass over the lines in parallel finds out; ``multiline`` says it beforehand,
    and must for encodings that ASCII is not part of. A file whose header differs from the first one fails instead of being
    read into the wrong columns. ``arrival`` orders the rows of a file.
    """
    if multiline is None:
        multiline = bool(line_breaks_in_cells(spark, paths).agg(F.bool_or("line_breaks_in_cells")).first()[0])
    df = (
        spark.read.option("header", True).option("multiLine", multiline).option("enforceSchema", False)
        .option("escape", '"').option("inferSchema", False).option("encoding", encoding).csv(paths)
    )
    cells = [F.when(~F.trim(F.col(f"`{c}`")).isin(K.MISSING_WORDS), F.col(f"`{c}`")).alias(c) for c in df.columns]
    return df.select(
        *cells,
        F.col("_metadata.file_name").alias("source_file"),
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("arrival"),
    )


def line_breaks_in_cells(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file, whether a quoted cell spans lines and whether every byte is valid UTF-8.

    Reads the lines in parallel; tells which reader a large file needs.
    """
    lines = spark.read.text(paths)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.bool_or(quotes % 2 == 1).alias("line_breaks_in_cells"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
    )
