"""Header rows, names and roles."""

import pytest
from pyspark.sql import functions as F

from tallymark.config import Settings
from tallymark.operators import columns, demographics, headers
from tallymark.plans import queries_values
from tallymark.schema import CELL

GRID = "array<array<struct<s:string,num:double,ts:timestamp>>>"


def head_frame(spark, *grids):
    rows = [(i, [[(c, None, None) for c in row] for row in grid]) for i, grid in enumerate(grids)]
    return spark.createDataFrame(rows, f"i int, head {GRID}").withColumn("n", F.size("head").cast("bigint"))


def positions(spark, rule, *grids):
    df = head_frame(spark, *grids).select("i", headers.header_position(F.col("head"), F.col("n"), rule).alias("h"))
    return [r.h for r in df.orderBy("i").collect()]


PLAIN = [["Post title", "Clicks"], ["a", "1"]]
TITLED = [["Made for you"], [], ["Post title", "Clicks", "Likes"], ["a", "1", "2"]]
DEEP = [["x"], ["y"], ["z"], ["Impressions", "Clicks", "Date"], ["1", "2", "3"]]


def test_rules(spark):
    assert positions(spark, "auto", PLAIN, TITLED, DEEP) == [0, 2, 3]
    assert positions(spark, "first", PLAIN, TITLED) == [0, 0]
    assert positions(spark, "score", PLAIN, TITLED, DEEP) == [0, 2, 3]
    assert positions(spark, "indicators", PLAIN, TITLED, DEEP) == [0, 2, 3]
    assert positions(spark, "named", PLAIN, TITLED, DEEP) == [0, 0, 0]
    assert positions(spark, "two_names", PLAIN, TITLED, DEEP) == [0, 2, 0]


def test_first_best_score_wins(spark):
    assert positions(spark, "score", [["a", "b"], ["c", "d"]], [["a"], ["b", "c"], ["d", "e"]]) == [0, 1]


def test_named_needs_data_below(spark):
    assert positions(spark, "named", [["a", "b"]]) == [0]
    assert positions(spark, "named", [[None, None, "x"], ["Date", "Clicks"], ["1", "2"]]) == [1]


@pytest.mark.parametrize(("names", "candidates", "plain", "by_word"), [
    ([" Clicks ", "Link clicks"], ["clicks", "link clicks"], " Clicks ", " Clicks "),
    (["Link clicks", "clicks"], ["clicks"], "clicks", "clicks"),
    (["My link clicks"], ["clicks"], "My link clicks", "My link clicks"),
    (["Total views", "Offsite"], ["offsite views"], None, "Total views"),
    (["a", "b"], ["title"], None, None),
    (["Post type", "Type"], ["content type", "type"], "Type", "Post type"),
])
def test_find_column_both_forms(spark, names, candidates, plain, by_word):
    assert columns.find_column(names, candidates) == plain
    assert columns.find_column(names, candidates, word_match=True) == by_word
    df = spark.createDataFrame([([n.strip().lower() for n in names],)], "k array<string>")
    for word_match, expected in ((False, plain), (True, by_word)):
        at = df.select(columns.position_of(F.col("k"), candidates, word_match)).first()[0]
        assert at == (None if expected is None else names.index(expected))


def test_clean_header(spark):
    df = spark.createDataFrame([([" A ", None, "", "B"], ["v", "w", "x" * 60, "y"])], "h array<string>, f array<string>")
    row = df.select(
        columns.clean_header(F.col("h")).alias("clean"),
        columns.name_blanks_by_value(F.col("h"), F.col("f")).alias("named"),
        columns.keep_first(F.array(F.lit("A"), F.lit("a"), F.lit("A"))).alias("kept"),
    ).first()
    assert row.clean == ["A", "Column_1", "Column_2", "B"]
    assert row.named == ["A", "w", "Column_2", "B"]
    assert row.kept == [0, 1]


def test_rows(spark):
    def cells(*values):
        return [(v, None, None) for v in values]

    rows = [cells("a"), cells("a", "b", "c"), cells(None, " "), cells("x" * 120), cells("x" * 120, "1,000.5"), cells("z" * 90)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, cells array<struct<s:string,num:double,ts:timestamp>>")
    out = df.orderBy("i").select(
        F.transform(columns.pad_row(F.col("cells"), F.lit(2), F.lit(None).cast(CELL)), lambda c: c["s"]).alias("p"),
        columns.is_blank_row(F.col("cells")).alias("blank"),
        columns.is_data_row(F.col("cells")).alias("data"),
    ).collect()
    assert out[0].p == ["a", None] and out[1].p == ["a", "b"]
    assert [r.blank for r in out] == [False, False, True, False, False, False]
    assert [r.data for r in out] == [True, True, False, False, True, True]


def test_kept_columns_are_told_once_per_chunk(spark):
    cells = [[(f"v{i}", None, None)] for i in range(40)]
    chunks = spark.createDataFrame(
        [("a.csv", 0, 0, 0, cells), ("a.csv", 0, 40, 0, cells), ("b.csv", 0, 0, 0, cells)],
        f"file_name string, sheet_idx int, first_row bigint, header_row int, rows {GRID}",
    )
    found = headers.sheet_rows(chunks, F.col("first_row").alias("start"), F.uuid().alias("told")).collect()
    assert len(found) == 39 + 40 + 39  # without the header rows
    assert len({r["told"] for r in found}) == 3
    assert {(r["source_file"], r["start"]) for r in found} == {("a.csv", 0), ("a.csv", 40), ("b.csv", 0)}


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert columns.drop_empty_columns(df).columns == ["a", "c"]


@pytest.mark.parametrize(("names", "roles", "older"), [
    (["Location", "Total followers", "% share"], (0, 1, 2), (0, 1, 2)),
    (["Members title", "Percent"], (0, 0, 1), (0, 1, 1)),
    (["x", "y"], (0, 1, None), (0, 1, None)),
    (["x"], (0, None, None), (0, None, None)),
    (["Audience share name", "Number"], (0, 0, 0), (0, 1, None)),
])
def test_demographic_roles_both_forms(spark, names, roles, older):
    df = spark.createDataFrame([([n.lower() for n in names],)], "k array<string>")
    for manual, expected in ((False, roles), (True, older)):
        found = demographics.role_positions(F.col("k"), manual)
        assert tuple(df.select(*[found[r].alias(r) for r in ("value", "count", "percentage")]).first()) == expected
        by_name = demographics.role_columns(names, manual)
        assert tuple(by_name.values()) == tuple(None if i is None else names[i] for i in expected)


def test_empty_columns_lose_their_name(spark):
    cell = lambda v: (v, None, None)
    head = [[cell("Clicks"), cell("Link clicks"), cell(None)], [cell(None), cell("5"), cell("Kind")]]
    chunk = spark.createDataFrame(
        [(head, [None, None, None], 2)], f"head {GRID}, later array<string>, sheet_rows bigint"
    )
    used = headers.with_header(chunk, Settings(drop_empty_columns=True)).first()
    assert used["keys"] == ["", "link clicks", "column_2"]
    named = headers.with_header(chunk, Settings(drop_notes=True)).first()
    assert named["names"] == ["Clicks", "Link clicks", "Kind"]


def test_rules_by_facts_told_once(spark, tmp_path):
    texts = ["", " ", "a", "\n\nPost Title Impressions\nx y z", "one\ntwo words\ndate post clicks", "ctr\nét é\nDATE", "a  b\n" * 12, "Post\n1 2\n3", None]
    documents = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    told = queries_values.header_rows(spark, str(tmp_path))
    assert told._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1, "cells are prepared once"
    head, rows = F.col("head"), F.col("sheet_rows")
    plain = queries_values.text_chunks(documents).select(
        "doc_id", headers.by_score(head), headers.by_indicators(head),
        *[headers.header_position(head, rows, rule) for rule in ("auto", "named", "two_names")],
    )
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, plain.collect()))
