"""The corpus queries beside their SQL, and the pipeline against a plain version."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_file
import compare
import corpus_pipeline
from llm_support import SCHEMA, groups
from tallymark.llm import language, queries
from test_text_operators import plain_lines, plain_print

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.SQL[name]) is None


def test_entry_has_them_all():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= entry_file.queries().keys()


def test_pipeline(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = language.predict(table, language.learn(table), keep=("doc_id", "text")).collect()
    rows = [(r["doc_id"], r["text"]) for r in told if r["lang_pred"] != "und" and r["score"] >= 0.3]
    assert len(rows) >= 0.99 * table.count()  # clean documents stay
    texts = {i: t for i, t, _, _ in plain_lines(rows, 10)}
    prints = [(i, plain_print(t)) for i, t in texts.items()]
    least = groups(texts, [(a, b) for a, x in prints for b, y in prints if a < b and (x ^ y).bit_count() <= 2])
    kept = {i: t for i, t in texts.items() if least[i] == i}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter()
    for r in found:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    fill = Counter()
    for r in found:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len(fill) <= np.ceil(sum(fill.values()) / 4096) * 1.05 + 1


def test_stages_keep_the_columns_and_stand_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, docs, FOLDER).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
