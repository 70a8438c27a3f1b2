"""Whitening of embeddings on whole-number vectors, each distinct vector once.

Rows become vectors of whole numbers, and equal ones are grouped first; a group weighs as
many rows as it has, or one. Number and sums of the fit are exact. The covariance is the
weighted product of the centred vectors, added up over tasks; its eigenvectors are the
components. Every distinct vector is projected once, and the rows are joined back by the
digest of their vector, so a vector that a third of all rows share is worked out once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

WHOLE = "decimal(38,0)"
RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)
_SAFE = 1 << 62
_LARGEST = 10**38


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part: ``x`` is ``floor(scale * c)`` of each entry, from double."""
    given = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), given.alias("v"))
        .where(F.col("v").isNotNull()).where(fine)
        .select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("long")).alias("x"))
    )


def _filled(x: Column, dims: int) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))


def _digest(x: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(x.cast("array<string>"), ","), 256))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def exact_sums(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The weight of all vectors and the weighted sum of each dimension, as whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sums = 0, [0] * dims
        for batch in batches:
            x, w = _matrix(batch.column(0), dims), batch.column(1).to_numpy()
            weight += sum(w.tolist())
            if _largest(x) * int(w.max(initial=0)) * len(x) >= _SAFE:
                x, w = x.astype(object), w.astype(object)
            sums = [a + int(b) for a, b in zip(sums, (x * w[:, None]).sum(0))]
        cells = [Decimal(v) for v in (*sums, weight)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 1), pa.int32()), pa.array(cells, pa.decimal128(38, 0))], ["dim", "total"]
        )

    found = distinct.select("x", "weight").mapInArrow(run, f"dim int, total {WHOLE}").groupBy("dim").agg(F.sum("total").alias("total"))
    totals = {r["dim"]: int(r["total"]) for r in found.collect()}  # one row per dimension
    return totals.get(dims, 0), [totals.get(d, 0) for d in range(dims)]


def covariance(rows: DataFrame, column: str, centre: np.ndarray, weight: int) -> np.ndarray:
    """The weighted covariance around ``centre``; the driver gets its cells, dimensions squared."""
    dims = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            apart = _matrix(batch.column(0), dims).astype(np.float64) - centre
            total += (apart * batch.column(1).to_numpy()[:, None]).T @ apart
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array(total.reshape(-1))], ["cell", "total"]
        )

    found = rows.select(column, "weight").mapInArrow(run, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    cells = np.zeros(dims * dims)
    cells[found["cell"].to_numpy()] = found["total"].to_numpy()
    return cells.reshape(dims, dims) / weight


def components_of(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors as columns; those of no variance are left out.

    The entry of largest size is positive, so a run gives the same signs as the next.
    """
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values.max(initial=0.0), 0.0) * len(matrix) * 1e-14]
    values, vectors = values[order], vectors[:, order]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])


def _projected(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> Callable:
    dims = len(sums)
    centre = np.array([float(Fraction(s, n)) for s in sums])
    along = vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            y = (x.astype(np.float64) - centre) @ along
            if dims * (n * _largest(x) + max(map(abs, sums))) ** 2 < _SAFE:
                apart = (n * x - np.array(sums, np.int64)).astype(np.int64)
                far = (apart * apart).sum(1).tolist()
            else:
                far = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2), batch.column(1),
                    pa.array([Decimal(f) if f < _LARGEST else None for f in far], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32), pa.array(y.reshape(-1))),
                ],
                ["digest", "weight", "deviation", "y"],
            )

    return run


def whiten(vectors: DataFrame, most: int = 4, scale: int = 256, by_count: bool = False) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    The fit holds every distinct vector once, or with ``by_count`` as often as it occurs; ``n`` is its
    weight. ``deviation`` is the exact sum over dimensions of ``(n * x - sum)^2``, null from 38 digits on.
    ``identity_error`` is the largest entry of the covariance of all whitened vectors less the identity.

    Rows whose vector is null or holds null or non-finite entries drop out. Null ids come back, rows that
    repeat come back each, a shorter vector counts as filled up with zeros, an entry beyond the whole
    numbers of 64 bits as the largest of them. Components without variance are left out, so vectors that are
    all equal give no rows, as do no vectors. Equal eigenvalues leave the direction of their components
    open; it is the same for all rows. Other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, scale)
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], RESULT)
    rows = rows.select("vec_id", _filled(F.col("x"), dims).alias("x"))
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    distinct = written(rows.groupBy("x").agg(weight.alias("weight")), "distinct-vectors")
    n, sums = exact_sums(distinct, dims)
    matrix = covariance(distinct, "x", np.array([float(Fraction(s, n)) for s in sums]), n)
    values, along = components_of(matrix, most)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    whitened = written(
        distinct.select("x", "weight", _digest(F.col("x")).alias("digest"))
        .mapInArrow(_projected(n, sums, values, along), f"digest binary, weight long, deviation {WHOLE}, y array<double>"),
        "whitened",
    )
    means = whitened.select("weight", F.posexplode("y").alias("k", "c")).groupBy("k").agg(
        (F.sum(F.col("c") * F.col("weight")) / n).alias("mean")
    )
    centre = np.zeros(len(values))
    for r in means.collect():  # one row per component
        centre[r["k"]] = r["mean"]
    error = float(np.abs(covariance(whitened, "y", centre, n) - np.eye(len(values))).max())
    explained = F.array(*[F.lit(float(v / np.trace(matrix))) for v in values])
    back = rows.select("vec_id", _digest(F.col("x")).alias("digest")).join(whitened.drop("weight"), "digest")
    return back.select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
