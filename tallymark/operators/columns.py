"""Find logical columns behind varying names.

Two forms of the same rules: over the column names of a DataFrame, on the
driver, and over an array of header names, as a column expression, for files
whose headers differ within one plan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.strings import has_any, strip
from ..schema import CELL


def _tidy(name: str) -> str:
    return name.strip().lower()


# --- over names on the driver ------------------------------------------------------
def find_column(names: list[str], candidates: list[str], word_match: bool = False) -> str | None:
    """The first candidate that equals a name or is part of one; returns the real name."""
    tidy = [_tidy(n) for n in names]
    for candidate in candidates:
        words = [candidate, *candidate.split()] if word_match else [candidate]
        hits = [i for i, n in enumerate(tidy) if n == candidate] or [
            i for i, n in enumerate(tidy) if any(w in n for w in words)
        ]
        if hits:
            return names[hits[0]]
    return None


def flat_cells(df: DataFrame, mapping: dict[str, list[str]], word_match: bool = False) -> dict[str, Column]:
    """Logical name to cell, for a DataFrame that already has named columns."""
    cells = {}
    for logical, candidates in mapping.items():
        name = find_column(df.columns, candidates, word_match)
        cells[logical] = blank_cell() if name is None else cell_of(F.col(f"`{name}`"), df.schema[name].dataType)
    return cells


def cell_of(value: Column, dtype: T.DataType) -> Column:
    """A typed column as a cell; text stays text, numbers and dates skip the text rules."""
    numeric = isinstance(dtype, T.NumericType)
    timed = isinstance(dtype, (T.TimestampType, T.DateType, T.TimestampNTZType))
    number = value.cast("double") if numeric else F.lit(None).cast("double")
    return F.struct(
        value.cast("string").alias("s"),
        F.when(F.abs(number) < float("inf"), number).alias("num"),
        (value.cast("timestamp") if timed else F.lit(None).cast("timestamp")).alias("ts"),
    )


def blank_cell() -> Column:
    return F.lit(None).cast(CELL)


# --- over header arrays ---------------------------------------------------------------
def position_where(names: Column, test) -> Column:
    """0-based position of the first name that passes, or NULL."""
    return F.nullif(F.array_position(F.transform(names, test), True), F.lit(0)).cast("int") - 1


def _containing(words: list[str]):
    return lambda name: has_any(name, words)


def position_of(names: Column, candidates: list[str], word_match: bool = False) -> Column:
    """``find_column`` over an array of tidy header names, as a 0-based position or NULL."""
    tries = []
    for candidate in candidates:
        words = [candidate, *candidate.split()] if word_match else [candidate]
        tries.append(F.nullif(F.array_position(names, candidate), F.lit(0)).cast("int") - 1)
        tries.append(position_where(names, _containing(words)))
    return F.coalesce(*tries)


def keyword_position(names: Column, words: list[str], taken: list[Column] = ()) -> Column:
    """The first name with one of the words, apart from positions already taken."""

    def test(name: Column, i: Column) -> Column:
        free = [~F.coalesce(i == t, F.lit(False)) for t in taken]
        return reduce(and_, free, has_any(name, words))

    return position_where(names, test)


# --- rows and headers -----------------------------------------------------------------
def clean_header(names: Column) -> Column:
    """Trimmed names; a blank one is called after its position."""
    return F.transform(
        names,
        lambda n, i: F.coalesce(F.nullif(strip(n), F.lit("")), F.concat(F.lit("Column_"), i.cast("string"))),
    )


def name_blanks_by_value(names: Column, first_values: Column) -> Column:
    """A blank header takes the first value of its column when that is shorter than 50 characters."""

    def named(n: Column, i: Column) -> Column:
        first = strip(F.get(first_values, i))
        return F.when(F.coalesce(strip(n), F.lit("")) != "", n).when(F.length(first) < 50, first)

    return clean_header(F.transform(names, named))


def keep_first(names: Column) -> Column:
    """Positions of the columns that stay when duplicate names keep their first column."""
    return F.filter(
        F.transform(names, lambda n, i: F.when(F.array_position(names, n) == i + 1, i.cast("int"))),
        lambda i: i.isNotNull(),
    )


def pad_row(cells: Column, width: Column, blank: Column) -> Column:
    """Short rows get blanks, long ones are cut."""
    return F.slice(F.concat(cells, F.array_repeat(blank, F.greatest(width - F.size(cells), F.lit(0)))), F.lit(1), width)


def is_blank_cell(cell: Column) -> Column:
    return cell["s"].isNull() | (strip(cell["s"]) == "")


def is_blank_row(cells: Column) -> Column:
    return F.forall(cells, is_blank_cell)


def is_number_cell(cell: Column) -> Column:
    """A typed number, or text of digits, points and commas only."""
    return F.coalesce(cell["num"].isNotNull() | cell["s"].rlike(r"^[.,]*\d[\d.,]*$"), F.lit(False))


def is_data_row(cells: Column) -> Column:
    """Rows with a number, or with short texts; long prose without numbers is a note."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("letters"), F.lit(False).alias("number"))

    def add(seen: Column, c: Column) -> Column:
        counted = F.struct(
            (seen["n"] + 1).alias("n"),
            (seen["letters"] + F.length(c["s"])).alias("letters"),
            (seen["number"] | is_number_cell(c)).alias("number"),
        )
        return F.when(is_blank_cell(c), seen).otherwise(counted)

    return F.aggregate(cells, start, add, lambda seen: seen["number"] | (seen["letters"] < 100 * seen["n"]))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are NULL in every row; one pass of partial aggregates."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


