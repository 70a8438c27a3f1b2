"""CSV files of any layout and encoding through Spark's own reader, with the rows it cannot place kept aside.

A pass over the lines finds the encoding of each file, whether cells hold line breaks, and
files that are no text. A second pass takes the first rows of each file and finds its
header by the rules of ``operators.headers``. Files with the same encoding and header are
one plan, read with the header's names, so there are as many plans as layouts; a large file
splits over tasks. Nothing runs in Python. Every file is tried, whatever its extension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .. import constants as K
from ..config import Settings
from ..operators import headers
from ..operators.columns import cell_of
from ..operators.posts import posts_from_table
from ..session import written

LAYOUTS = 1000  # different layouts of one folder; beyond it the folder is not one of exports
_CONTROLS = r"[\x00-\x08\x0e-\x1b]"
# What cp1252 has in place of the control characters 0x80 to 0x9F, in their order; the five
# bytes it does not define stay as they are.
_CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_CP1252_BYTES = "".join(map(chr, range(0x80, 0xA0)))
_BROKEN = "_broken"


@dataclass(frozen=True)
class CsvFolder:
    """``tables``: rows under their header's names, one DataFrame per layout, with ``source_file`` and ``arrival``.
    ``rejects``: ``path, record, reason`` of rows and whole files that were not taken. ``files``: ``path, encoding,
    multiline, header_row, names``."""

    tables: list[DataFrame]
    rejects: DataFrame
    files: DataFrame


def probe(spark: SparkSession, folder: str) -> DataFrame:
    """``path, encoding, multiline, problem`` of every file, from its lines. What is told of a line is all that is sorted."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    lines = spark.read.text(folder, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place"),
        F.substring(value.cast("binary"), 1, 4).alias("lead"), F.is_valid_utf8(value).alias("utf8"),
        (quotes % 2 == 1).alias("odd"), value.rlike(_CONTROLS).alias("controls"),
    )
    found = lines.groupBy("path").agg(
        F.min_by("lead", "place").alias("lead"), F.bool_and("utf8").alias("utf8"), F.bool_or("odd").alias("odd"),
        F.bool_or("controls").alias("controls"),
    )
    lead = F.hex("lead")
    wide = lead.startswith("FFFE") | lead.startswith("FEFF")
    problem = (
        F.when(lead == "504B0304", "an archive or workbook").when(lead == "D0CF11E0", "a binary workbook")
        .when(~wide & F.col("controls"), "control characters: this is no text")
    )
    encoding = F.when(wide, "UTF-16").when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1")
    return found.select("path", encoding.alias("encoding"), (wide | F.col("odd")).alias("multiline"), problem.alias("problem"))


def _options(encoding: str, multiline: bool) -> dict[str, str]:
    return {
        "columnNameOfCorruptRecord": _BROKEN, "multiLine": str(multiline), "encoding": encoding, "escape": '"',
        "mode": "PERMISSIVE", "nullValue": "",
    }


def _text(cell: Column, encoding: str, manual: bool) -> Column:
    return F.translate(cell, _CP1252_BYTES, _CP1252) if encoding == "ISO-8859-1" and not manual else cell


def _read(spark: SparkSession, paths: list[str], names: list[str], encoding: str, multiline: bool, manual: bool) -> DataFrame:
    """Raw cells under ``names``, the raw text of rows that do not fit, and the place of each row."""
    schema = ", ".join(f"`{n}` string" for n in [*names, _BROKEN])
    rows = spark.read.schema(schema).options(**_options(encoding, multiline)).csv(paths)
    return rows.select(
        *[_text(F.col(f"`{n}`"), encoding, manual).alias(n) for n in [*names, _BROKEN]], F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _most_cells(record: Column) -> Column:
    """As many cells as a raw record has at most: commas outside quoted cells, or all where a quote stands within a cell."""
    bare = F.regexp_replace(record, r'"[^"]*"', "\x01")
    odd = bare.rlike('[^,\x01]\x01|\x01[^,\x01]|"')
    text = F.when(odd, record).otherwise(bare)
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit(""))) + 1


def _heads(spark: SparkSession, paths: list[str], encoding: str, multiline: bool, manual: bool) -> DataFrame:
    """``path`` and the first rows of each file; tasks keep only their own first rows before they shuffle.

    Records are read whole, whatever their cells, and only those kept are cut into cells.
    """
    first = Window.partitionBy("_path").orderBy("_block", "_row")
    rows = _read(spark, paths, ["cell"], encoding, multiline, True)
    top = rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= K.HEADER_SEARCH_ROWS)
    top = written(top.select("_path", "at", "cell", _BROKEN), "head-records")
    width = top.agg(F.max(_most_cells(F.col(_BROKEN)))).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = top.withColumn("record", F.from_csv(_BROKEN, schema, _options(encoding, multiline)))
    cells = F.when(F.col(_BROKEN).isNull(), F.array("cell")).otherwise(F.array(*[F.col("record")[f"c{i}"] for i in range(width)]))
    cells = F.transform(cells, lambda c: _text(c, encoding, manual))
    cut = F.slice(F.col("cells"), 1, F.greatest(F.lit(1), F.array_max(F.transform("cells", lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0)))))
    return parsed.withColumn("cells", cells).groupBy(F.col("_path").alias("path")).agg(F.array_sort(F.collect_list(F.struct("at", cut.alias("cells")))).alias("top"))


def _unique(names: list[str]) -> list[str]:
    """Names as columns: a name that was there before answers to none."""
    seen, out = {_BROKEN, "_path", "_block", "_row", "source_file", "arrival"}, []
    for i, name in enumerate(names):
        name = name.replace("`", "'")
        out.append(name if name.lower() not in seen else f"Column_{i}_again")
        seen.add(out[-1].lower())
    return out


def _cells_in(record: Column) -> Column:
    """The number of cells of a raw record, blank ones at its end aside."""
    bare = F.regexp_replace(F.regexp_replace(record, r'"[^"]*"', "x"), r"[,\s]+$", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_csv_folder(spark: SparkSession, folder: str, settings: Settings) -> CsvFolder:
    """All CSV files below a folder.

    A row with fewer cells than the header is filled up; one with more, or with a quote left open, is a
    reject, and so is a file that is no text. The lines up to the header are taken out by their contents, so
    a data row that repeats one of its own file goes with them. Blank rows are none.
    """
    probed = written(probe(spark, folder), "probed-files")
    groups = probed.where("problem IS NULL").groupBy("encoding", "multiline").agg(F.collect_list("path").alias("paths")).collect()  # what is read must be named: one path per file
    heads = None
    for g in groups:
        found = _heads(spark, g["paths"], g["encoding"], g["multiline"], settings.manual)
        found = found.select("path", F.lit(g["encoding"]).alias("encoding"), F.lit(g["multiline"]).alias("multiline"), "top")
        heads = found if heads is None else heads.unionByName(found)
    bad_files = probed.where("problem IS NOT NULL").select("path", F.lit(None).cast("string").alias("record"), F.col("problem").alias("reason"))
    if heads is None:
        return CsvFolder([], bad_files, probed.select("path", "encoding", "multiline").limit(0))
    head = F.transform("top", lambda r: F.transform(r["cells"], lambda c: cell_of(F.when(~F.trim(c).isin(K.MISSING_WORDS), c), T.StringType())))
    named = headers.with_header(
        heads.withColumns({"head": head, "sheet_rows": F.size("top").cast("long") + 1, "later": F.array().cast("array<string>")}), settings
    )
    files = written(named.select("path", "encoding", "multiline", "header_row", "names", "top"), "csv-heads")
    layouts = files.groupBy("encoding", "multiline", "names").agg(F.collect_list("path").alias("paths")).limit(LAYOUTS + 1).collect()
    if len(layouts) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} layouts in one folder")
    # Written by themselves, the lines to take out are as small to Spark as they are: paths and digests.
    above = F.filter("top", lambda r: r["at"] <= F.col("header_row") + 1)
    leads = written(
        files.withColumn("width", F.size("names")).select("encoding", "multiline", "names", "width", F.col("path").alias("_path"), F.explode(above).alias("r"))
        .withColumn("_hash", F.xxhash64(F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.get(F.col("r.cells"), i))))
        .select("encoding", "multiline", "names", "_path", "_hash").distinct(), "csv-leads",
    )
    tables, rejects = [], bad_files
    for layout in layouts:
        names = _unique(layout["names"])
        width = len(names)
        rows = _read(spark, layout["paths"], names, layout["encoding"], layout["multiline"], settings.manual)
        here = (F.col("encoding") == layout["encoding"]) & (F.col("multiline") == layout["multiline"]) & (F.col("names") == F.array(*[F.lit(n) for n in layout["names"]]))
        lead = leads.where(here).select("_path", "_hash")
        cells = F.array(*[F.col(f"`{n}`") for n in names])
        rows = rows.withColumn("_hash", F.xxhash64(cells)).join(lead, ["_path", "_hash"], "left_anti")
        reason = F.when(
            (F.length(_BROKEN) - F.length(F.replace(F.col(_BROKEN), F.lit('"'), F.lit("")))) % 2 == 1, "a quote is left open"
        ).when(_cells_in(F.col(_BROKEN)) > width, "more cells than the header")
        rows = rows.withColumn("_reason", reason)
        rejects = rejects.unionByName(rows.where("_reason IS NOT NULL").select(F.col("_path").alias("path"), F.col(_BROKEN).alias("record"), F.col("_reason").alias("reason")))
        missing = [F.when(~F.trim(F.col(f"`{n}`")).isin(K.MISSING_WORDS), F.col(f"`{n}`")).alias(n) for n in names]
        tables.append(rows.where("_reason IS NULL").where(F.exists(cells, lambda c: c.isNotNull())).select(
            *missing, "source_file",
            F.struct(F.col("source_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row")).alias("arrival"),
        ))
    return CsvFolder(tables, rejects, files.drop("top"))


def posts_from_csv_folder(found: CsvFolder, settings: Settings) -> DataFrame | None:
    """Post records of all layouts of a folder; None if it has no CSV."""
    posts = None
    for rows in found.tables:
        part = posts_from_table(rows, settings)
        posts = part if posts is None else posts.unionByName(part)
    return posts
