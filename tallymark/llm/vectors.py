"""Vectors as the embedding operators see them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def level(points: np.ndarray) -> np.ndarray:
    """Each row over a power of two that brings its largest entry near one: cosines stay as they are to the last bit,
    and no product of huge or tiny entries leaves the doubles."""
    return np.ldexp(points, -np.frexp(np.abs(points).max(1, keepdims=True))[1])


def usable(vectors: DataFrame, *also: str) -> DataFrame:
    """``(vec_id, v)`` and other wanted columns of the rows that take part, with ``v`` in double precision.

    Out are null and zero vectors and those that hold null or non-finite components.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    some = F.exists("v", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), *also).where(F.col("v").isNotNull()).where(fine & some)


def width(vectors: DataFrame) -> int:
    """The largest number of components, 0 without vectors."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def padded(v: Column, dims: int) -> Column:
    """The vector with zeros behind up to ``dims``, which changes no product."""
    return F.concat(v, F.array_repeat(F.lit(0.0), F.lit(dims) - F.size(v)))
