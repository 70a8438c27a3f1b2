"""Corpus operators on vectors against brute force, odd inputs included."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import groups
from tallymark.llm import embedding_dedup, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id long, n long, v string, leaf int, first int"


def odd_vectors(seed=5, n=400, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = [(i, (centres[i % 12] + rng.normal(size=dims) * 0.25).astype(np.float32).tolist()) for i in range(n)]
    copies = [(n + i, rows[3][1]) for i in range(30)] + [(n + 50 + i, [2 * x for x in rows[3][1]]) for i in range(5)]
    return rows + copies + [
        (n + 100, None), (n + 101, [0.0] * dims), (n + 102, [1.0, None, *[1.0] * (dims - 2)]), (n + 103, [math.nan] * dims),
        (n + 104, [math.inf, *[1.0] * (dims - 1)]), (n + 105, [1.0, 2.0]), (n + 106, []), (None, [1.0] * dims), (n + 150, None),
    ]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "v", 3, 4) for i, v in rows], SCHEMA).repartition(3)


def proper(rows, dims=6):
    out = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            out[i] = np.array([*v, *[0.0] * (dims - len(v))], np.float64)
    return out


def cosines(held):
    ids = np.array(list(held))
    x = np.array(list(held.values()))
    n = np.sqrt((x * x).sum(1))
    return ids, np.array([(x * x[i]).sum(1) / (n * n[i]) for i in range(len(ids))])


@pytest.mark.parametrize("leaf", [60, 4096])
def test_embedding_near_duplicates(spark, monkeypatch, leaf):
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    monkeypatch.setattr(embedding_dedup, "STEPS", (2, 4))
    rows = odd_vectors()
    ids, cos = cosines(proper(rows))
    np.fill_diagonal(cos, -1)
    near = cos >= 0.95
    least = groups(ids.tolist(), [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(near))])
    expected = {i: (0, i, True) for i, _ in rows}
    expected |= {int(i): (int(near[k].sum()), least[int(i)], least[int(i)] == i) for k, i in enumerate(ids)}
    found = embedding_dedup.near_duplicates(table(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == expected


def test_a_crowded_tile_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF", 16)
    rng = np.random.default_rng(1)
    rows = [(i, (np.array([1, 0, 0, 0]) + rng.normal(size=4) * 1e-3).tolist()) for i in range(120)]
    found = embedding_dedup.near_duplicates(table(spark, rows)).collect()
    assert {(r["n_links"], r["component_id"], r["kept"]) for r in found} == {(119, 0, True), (119, 0, False)}


def test_embedding_duplicates_of_nothing(spark):
    assert embedding_dedup.near_duplicates(table(spark, [])).count() == 0
    only = embedding_dedup.near_duplicates(table(spark, [(4, None), (5, [0.0])])).collect()
    assert {tuple(r) for r in only} == {(4, 0, 4, True), (5, 0, 5, True)}


def exact(held, asks, k=5):
    ids, cos = cosines(held)
    out = {}
    for i, own in enumerate(ids.tolist()):
        if own % asks == 0:
            order = [j for j in np.lexsort((ids, -cos[i])) if ids[j] != own][:k]
            out[own] = [(int(ids[j]), float(cos[i, j])) for j in order]
    return out


def search(spark, rows, **more):
    found = {}
    for r in neighbours.search(table(spark, rows), F.col("vec_id") % 50 == 0, k=5, **more).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_all_cells_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    rows = odd_vectors()
    expected, found = exact(proper(rows), 50), search(spark, rows, share=1.0)
    assert found.keys() == expected.keys()
    for query, best in expected.items():
        assert [i for i, _ in found[query]] == [i for i, _ in best]
        assert [s for _, s in found[query]] == pytest.approx([s for _, s in best], abs=1e-12)


def test_recall_of_a_share(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST", 10)
    rows = odd_vectors(n=3000, dims=16)
    expected, found = exact(proper(rows, 16), 50), search(spark, rows, share=0.3)
    met = [len({i for i, _ in found[q]} & {i for i, _ in best}) for q, best in expected.items()]
    assert sum(met) >= 0.9 * sum(len(best) for best in expected.values())


def test_walk_goes_by_distance():
    rng = np.random.default_rng(2)
    first, second, counts = rng.random(7), rng.random(5), rng.integers(0, 3, (7, 5))
    pairs = sorted((first[i] + second[j], i, j) for i in range(7) for j in range(5) if counts[i, j])
    assert neighbours.walk(first, second, counts, 10**9) == [(i, j) for _, i, j in pairs]
    some = neighbours.walk(first, second, counts, 6)
    assert some == [(i, j) for _, i, j in pairs][: len(some)] and sum(counts[i, j] for i, j in some) >= 6


def test_few_vectors(spark):
    assert search(spark, []) == {}
    assert search(spark, [(50, [1.0, 0.0])]) == {}
    assert search(spark, [(50, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0])]) == {50: [(2, 1.0), (1, pytest.approx(0.5 ** 0.5))]}
