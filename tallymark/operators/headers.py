"""Find the header row of a sheet among its first rows.

Works on the ``head`` array each chunk carries, so a sheet of any length costs
one evaluation per chunk and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings
from ..functions.strings import has_any, strip
from ..session import built_once
from .columns import clean_header, is_blank_cell, name_blanks_by_value


_SHORTEST_HINT = min(map(len, K.HEADER_HINTS))  # shorter cells hold none
_SHORTEST_INDICATOR = min(map(len, K.HEADER_INDICATORS))


def _tokens(row: Column) -> Column:
    return F.filter(F.transform(row, lambda c: F.lower(strip(c["s"]))), lambda t: t.isNotNull() & (t != ""))


def _score(tokens: Column) -> Column:
    hinted = lambda t: (F.length(t) >= _SHORTEST_HINT) & has_any(t, K.HEADER_HINTS)
    return F.aggregate(tokens, F.lit(0), lambda total, t: total + F.when(hinted(t), 2).otherwise(1))


def _hits(tokens: Column) -> Column:
    def hits(t: Column) -> Column:
        found = [F.when(t.contains(w), 1).otherwise(0) for w in K.HEADER_INDICATORS]
        return F.when(F.length(t) >= _SHORTEST_INDICATOR, sum(found[1:], found[0])).otherwise(0)

    return F.aggregate(tokens, F.lit(0), lambda total, t: total + hits(t))


def hint_score(row: Column) -> Column:
    """Filled cells plus filled cells that contain a header hint."""
    return _score(_tokens(row))


def indicator_count(row: Column) -> Column:
    """Pairs of an indicator and a cell that contains it."""
    return _hits(_tokens(row))


def filled_count(row: Column) -> Column:
    return F.size(_tokens(row))


def row_tokens(head: Column) -> Column:
    """Of each row the lower-case filled cells and the number of cells."""
    return F.transform(head, lambda row: F.struct(_tokens(row).alias("tokens"), F.size(row).alias("cells")))


def row_facts(tokens: Column) -> Column:
    """What the rules ask of each row, out of ``row_tokens``: told once where several rules follow."""
    return F.transform(tokens, lambda r: F.struct(
        F.size(r["tokens"]).alias("filled"), r["cells"].alias("cells"), _score(r["tokens"]).alias("score"), _hits(r["tokens"]).alias("hits"),
    ))


class _Row:
    """A row of the head: its cells, or what ``row_facts`` told of it."""

    def __init__(self, row: Column, told: bool):
        self.score = row["score"] if told else hint_score(row)
        self.hits = row["hits"] if told else indicator_count(row)
        self.filled = row["filled"] if told else filled_count(row)
        self.cells = row["cells"] if told else F.size(row)


def _first_row(head: Column, test) -> Column:
    return F.nullif(F.array_position(F.transform(head, test), True), F.lit(0)).cast("int") - 1


def by_score(head: Column, told: bool = False) -> Column:
    """The first row with the highest hint score; each row is scored once."""
    ranked = F.transform(head, lambda row, i: F.struct(_Row(row, told).score.alias("score"), (-i).alias("back")))
    return -F.array_max(ranked)["back"]


def by_indicators(head: Column, told: bool = False) -> Column:
    """The first row with two or more indicators, else row 0."""
    return F.coalesce(_first_row(head, lambda r: _Row(r, told).hits >= 2), F.lit(0))


def by_named_columns(head: Column, sheet_rows: Column, probes: int = 6, told: bool = False) -> Column:
    """The first of the probed rows with two names, or more names than blanks, and data below."""

    def named(row: Column, i: Column) -> Column:
        row = _Row(row, told)
        return ((row.filled >= 2) | (row.filled > row.cells - row.filled)) & (i + 1 < sheet_rows)

    return F.coalesce(_first_row(F.slice(head, 1, probes), named), by_indicators(head, told))


def by_two_names(head: Column, sheet_rows: Column, told: bool = False) -> Column:
    """The first of three rows with two names and data below, else row 0."""
    return F.coalesce(
        _first_row(F.slice(head, 1, 3), lambda r, i: (_Row(r, told).filled >= 2) & (i + 1 < sheet_rows)), F.lit(0)
    )


def header_position(head: Column, sheet_rows: Column, rule: str = "auto", told: bool = False) -> Column:
    """0-based row of the header. ``auto``: row 0 when it has two names, else the best score. ``told``: ``head`` holds ``row_facts``."""
    if rule == "first":
        return F.lit(0)
    if rule == "score":
        return by_score(head, told)
    if rule == "indicators":
        return by_indicators(head, told)
    if rule == "named":
        return by_named_columns(head, sheet_rows, told=told)
    if rule == "two_names":
        return by_two_names(head, sheet_rows, told)
    return F.when(_Row(F.get(head, F.lit(0)), told).filled >= 2, F.lit(0)).otherwise(by_score(head, told))


def _first_values(head: Column, header_row: Column, later: Column, width: Column) -> Column:
    """Per column the first value below the header."""
    below = F.filter(head, lambda r, i: i > header_row)

    def first(i: Column) -> Column:
        values = F.filter(F.transform(below, lambda r: F.get(r, i)["s"]), lambda s: s.isNotNull())
        return F.coalesce(F.get(values, F.lit(0)), F.get(later, i))

    return F.transform(F.sequence(F.lit(0), width - 1), first)


@built_once
def _header_row(rule: str) -> Column:
    return header_position(F.col("head"), F.col("sheet_rows"), rule)


def with_header(chunks: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``header_row``, ``names`` (clean) and ``keys`` (lower case, for matching)."""
    df = chunks.where(F.size("head") > 0).withColumn("header_row", _header_row(settings.header))
    raw = F.transform(F.get(F.col("head"), F.col("header_row")), lambda c: c["s"])
    names = clean_header(raw)
    if settings.drop_notes or settings.drop_empty_columns:
        df = df.withColumn(
            "first_values", _first_values(F.col("head"), F.col("header_row"), F.col("later"), F.size(raw))
        )
        if settings.drop_notes:
            names = name_blanks_by_value(raw, F.col("first_values"))
        if settings.drop_empty_columns:
            # An empty column keeps its place but no longer answers to a name.
            names = F.transform(
                names, lambda n, i: F.when(F.get(F.col("first_values"), i).isNotNull(), n).otherwise(F.lit(""))
            )
        df = df.withColumn("names", names).drop("first_values")
    else:
        df = df.withColumn("names", names)
    return df.withColumn("keys", F.transform("names", lambda n: F.lower(n)))


def sheet_rows(chunks: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per data row below the header: ``cells``, ``arrival`` and the kept columns."""
    # The kept columns stand in a select of their own: beside a generator they would be evaluated above it, per row.
    told = chunks.select("file_name", "sheet_idx", "first_row", "header_row", *keep, "rows")
    exploded = told.select(
        *[c for c in told.columns if c != "rows"], F.posexplode("rows").alias("at", "cells")
    ).withColumn("row_idx", F.col("first_row") + F.col("at"))
    return (
        exploded.where((F.col("row_idx") > F.col("header_row")) & ~F.forall("cells", is_blank_cell))
        .withColumn(
            "arrival",
            F.struct(
                F.col("file_name").alias("file"),
                F.col("sheet_idx").cast("bigint").alias("block"),
                F.col("row_idx").alias("row"),
            ),
        )
        .withColumnRenamed("file_name", "source_file")
        .drop("sheet_idx", "first_row", "header_row", "at", "row_idx")
    )
