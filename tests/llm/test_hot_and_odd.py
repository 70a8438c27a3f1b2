"""Repeated ids and rows, many letters, long words, huge and tiny numbers: what earlier cases of the operators did not hold."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from llm_support import SCHEMA, groups, odd_documents
from tallymark.llm import embedding_dedup, lattice, line_dedup, neighbours, simhash, transducer
from test_vector_operators import cosines, proper, search

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("cells", [40_000_000, 200_000])
def test_token_counts_of_all_letters(monkeypatch, cells):
    """All letters of the vocabulary in one group, as one long text and as many; a small table is only slower."""
    monkeypatch.setattr(transducer, "CELLS", cells)
    library, compiled, rng = SentencePieceProcessor(model_file=PIECES), transducer.Transducer(PIECES), random.Random(3)
    letters = [c for c in compiled.letters]
    pieces = [p for p in compiled.score]
    texts = ["".join(letters), "".join(rng.choice(letters) for _ in range(3000)), "".join(rng.choice(pieces) for _ in range(2000))]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    assert list(compiled.counts(texts)) == [len(x) for x in library.encode(texts)]
    assert compiled.next.size <= cells


def test_a_span_without_any_cut_is_counted_beside_the_table(monkeypatch):
    monkeypatch.setattr(transducer, "STATES", 2)
    compiled = transducer.Transducer(PIECES)
    texts = ["internationalisation", "a", "", "the the"]
    assert list(compiled.counts(texts)) == [len(x) for x in SentencePieceProcessor(model_file=PIECES).encode(texts)]


def test_rows_of_one_id_are_one_document_of_a_line(spark):
    rows = [(7, "again and again\nown")] * 12 + [(i, "common\nother") for i in range(20, 30)] + [(None, "none")] * 10
    kept = {(r.doc_id, r.text, r.n_dropped) for r in line_dedup.drop_shared_lines(odd_documents(spark, rows), min_docs=10).collect()}
    assert kept == {(7, "again and again\nown", 0), (None, "", 1), *((i, "", 2) for i in range(20, 30))}


def test_a_row_with_another_text_stays(spark):
    x, y = "one two three four five six", "a quite different text of other words"
    rows = [(1, x), (5, x), (5, y), (5, y), (9, None), (9, ""), (None, x)]
    kept = Counter((r.doc_id, r.text) for r in simhash.keep_one(odd_documents(spark, rows)).collect())
    assert kept[1, x] == 1 and kept[5, y] == 1 and kept[5, x] == 0 and kept[None, x] == 1 and sum(v for (i, _), v in kept.items() if i == 9) == 1


def test_columns_stay_when_ids_repeat(spark):
    docs = odd_documents(spark, [(1, "a b c"), (1, "a b c"), (2, "d e f")])
    assert simhash.keep_one(docs).columns == docs.columns and docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_a_long_word_moves_the_weights():
    pieces = lattice.vocabulary(PIECES)
    lat = lattice.Lattice(pieces, pieces.by_rank())
    word = "qu" * 250
    assert lat.expected([word]).sum() > 100
    # Windows agree with the sums over the whole word but for their edges.
    lattice_long, whole = lat.expected([word]), None
    old, lattice.LONG = lattice.LONG, 10_000
    try:
        whole = lat.expected([word])
    finally:
        lattice.LONG = old
    assert np.abs(lattice_long - whole).sum() < 0.01 * whole.sum()


@pytest.mark.parametrize("share", [2, 5, 0.33])
def test_queries_on_several_rows(spark, share):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    again = share if share >= 1 else int(share * 400)
    rows += [(50, rows[50][1])] * (again - 1) + [(77, rows[77][1])] * 3 + [(100, rows[3][1])]
    found = search(spark, rows, share=1.0)
    assert [len(v) for v in found.values()] == [5] * 6
    points = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    for query, got in found.items():
        mine = [v for i, v in points if i == query]
        scores = sorted(((-max(float(v @ m / np.linalg.norm(v) / np.linalg.norm(m)) for m in mine), i) for i, v in points if i != query))[:5]
        assert [s for _, s in got] == pytest.approx([-s for s, _ in scores], abs=1e-12)
        assert [i for i, _ in got] == [i for _, i in scores]


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_huge_and_tiny_vectors(spark, size):
    schema = "vec_id long, embedding array<double>"
    rows = [(i, (np.array([1.0, i % 3, (i // 3) % 2 * 5]) * size * (1 + i % 4)).tolist()) for i in range(24)]
    vectors = spark.createDataFrame(rows, schema)
    ids, cos = cosines(proper([(i, (np.array(v) / size).tolist()) for i, v in rows], 3))
    np.fill_diagonal(cos, -1)
    least = groups(ids.tolist(), [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(cos >= 0.95))])
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(vectors).collect()}
    assert found == {int(i): (int((cos[k] >= 0.95).sum()), least[int(i)]) for k, i in enumerate(ids)}
    near = neighbours.search(vectors, F.col("vec_id") % 50 == 0, k=5, share=1.0).orderBy("rank").collect()
    assert [r.score for r in near] == pytest.approx(sorted(cos[0], reverse=True)[:5], abs=1e-12)


