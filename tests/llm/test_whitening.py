"""Whitening against a plain version on whole tables and on odd rows."""

import math

import numpy as np
import pytest

from tallymark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x long, n long, digest string, y int, weight int, component int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0, 1, 2, "d", 3, 4, 5) for i, v in rows], schema).repartition(3)


def odd(seed=3, n=200, dims=6):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dims) * [1, 2, 3, 4, 5, 6]).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(150)] + [rows[9]] * 4
    return rows + [
        (900, None), (901, [1.0, None, *[1.0] * (dims - 2)]), (902, [math.nan] * dims), (903, [math.inf, *[0.0] * (dims - 1)]),
        (904, [0.0] * dims), (905, [-0.0] * dims), (906, [1.5]), (907, []), (None, [2.0] * dims),
    ]


def plain(rows, dims, by_count=False):
    held = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            held.append((i, (*(math.floor(256 * c) for c in np.array(v, np.float32).astype(float).tolist()), *[0] * (dims - len(v)))))
    fit = [x for _, x in held] if by_count else sorted({x for _, x in held})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    apart = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    order = np.argsort(-values)[:4]
    out = []
    for i, x in held:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k, j in enumerate(order, 1):
            y = float((np.array(x) - np.array(sums) / n) @ vectors[:, j] / math.sqrt(values[j]))
            out.append((i if i is not None else -1, k, n, deviation, abs(y), values[j] / values.sum()))
    return sorted(out)


@pytest.mark.parametrize("by_count", [False, True])
def test_against_a_plain_version(spark, by_count):
    rows = odd()
    found = whitening.whiten(table(spark, rows), by_count=by_count).collect()
    got = sorted(
        (r["vec_id"] if r["vec_id"] is not None else -1, r["component"], r["n"], int(r["deviation"]), abs(r["whitened"]), r["explained"])
        for r in found
    )
    expected = plain(rows, 6, by_count)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert [g[4:] for g in got] == [pytest.approx(e[4:], rel=1e-9, abs=1e-9) for e in expected]
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


def test_signs_are_the_same_for_all_rows(spark):
    found = whitening.whiten(table(spark, odd())).collect()
    sums = {}
    for r in found:
        sums.setdefault(r["component"], []).append(r["whitened"])
    assert all(min(v) < 0 < max(v) for v in sums.values())


def test_few_dimensions_and_no_variance(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    found = whitening.whiten(table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert {(r["vec_id"], r["component"], r["n"], int(r["deviation"]), round(abs(r["whitened"]), 9), r["explained"]) for r in found} == {
        (1, 1, 2, 256**2, 1.0, 1.0), (2, 1, 2, 256**2, 1.0, 1.0),
    }


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2.0**40 * (i % 7)), float(i), float(-(2.0**45) * (i % 3))]) for i in range(40)]
    found = whitening.whiten(table(spark, rows, SCHEMA.replace("float", "double"))).collect()
    fit = sorted({tuple(math.floor(256 * c) for c in v) for _, v in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    for r in found:
        x = [math.floor(256 * c) for c in rows[r["vec_id"]][1]]
        assert int(r["deviation"]) == sum((n * c - s) ** 2 for c, s in zip(x, sums))


def test_numbers_beyond_all_bounds_do_not_crash(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 3.0])]
    found = whitening.whiten(table(spark, rows, SCHEMA.replace("float", "double"))).collect()
    assert {r["vec_id"] for r in found} == {1, 2, 3} and any(r["deviation"] is None for r in found)
