"""Nearest neighbours by an inverted multi-index (Babenko and Lempitsky 2012).

Unit vectors are cut into two halves, each quantised by its own codebook, so a vector
lies in one of ``K * K`` cells. A query walks the pairs of centroids by the sum of their
distances with a heap, until the cells it has passed hold enough vectors; those are
ranked by their true cosine. The codebooks are fitted to a bounded sample; every vector is
indexed.

Rows meet by first centroid: a group holds a block of vectors and a block of queries,
both of bounded size, and each query brings the second centroids it has picked. A
crowded cell becomes more blocks. A group hands on the best few of each query.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .vectors import level, padded, usable, width

SAMPLE = 20_000  # vectors that the codebooks are fitted to
ROUNDS = 10
BLOCK = 4096  # vectors or queries of one group
LEAST = 2000  # candidates of a query at least


def codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centroids by Lloyd's rounds from distinct points; fewer if there are fewer points."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0) if len(points) <= k else points
    held = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest(points, held)
        sums = np.zeros_like(held)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(held))
        held[n > 0] = sums[n > 0] / n[n > 0, None]
    return held


def distances(points: np.ndarray, held: np.ndarray) -> np.ndarray:
    return (held * held).sum(1)[None, :] - 2 * points @ held.T + (points * points).sum(1)[:, None]


def nearest(points: np.ndarray, held: np.ndarray) -> np.ndarray:
    return distances(points, held).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Pairs of centroids by growing sum of the two distances, until their cells hold ``enough`` vectors.

    Every pair is offered once, by the neighbour before it, so the heap holds at most one pair per first centroid.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a], second[b]
    queue, passed, held = [(da[0] + db[0], 0, 0)], [], 0
    while queue and held < enough:
        _, i, j = heapq.heappop(queue)
        n = counts[a[i], b[j]]
        if n:
            passed.append((int(a[i]), int(b[j])))
            held += int(n)
        if j + 1 < len(db):
            heapq.heappush(queue, (da[i] + db[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(da):
            heapq.heappush(queue, (da[i + 1] + db[0], i + 1, 0))
    return passed


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(points: np.ndarray) -> np.ndarray:
    scaled = points / np.abs(points).max(1, keepdims=True)  # no square overflows
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def search(vectors: DataFrame, asks: Column, k: int = 5, share: float = 0.6, cells_side: int | None = None) -> DataFrame:
    """The ``k`` nearest found for each row where ``asks`` holds, among all rows with other ids.

    Returns ``query_id, rank, vec_id, score``; ``score`` is the cosine of the vectors as
    given, in double precision, and ties go to the smaller id. ``share`` of all vectors
    (and 2000 at least) are looked at per query. Null and zero vectors, those with null
    or non-finite components and rows without an id take no part; a shorter vector counts
    as filled up with zeros. A repeated id is one query with the rows of other ids as
    candidates, each by its best score with any of the id's vectors; candidates that repeat
    an id are rows of their own. Other columns are not read; no vectors give no rows.
    """
    spark = vectors.sparkSession
    points = usable(vectors.select("vec_id", "embedding", F.coalesce(asks, F.lit(False)).alias("asks")), "asks").where("vec_id is not null")
    dims = width(points)
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims += dims % 2
    points = points.select(F.monotonically_increasing_id().alias("row"), "vec_id", "asks", padded(F.col("v"), dims).alias("v"))
    total = points.count()
    side = cells_side or min(1024, max(4, 1 << math.ceil(math.log2(math.sqrt(total) / 8 + 1))))
    drawn = F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / total))
    sample = points.where(drawn).select("v").toArrow()["v"] if total > SAMPLE else points.select("v").toArrow()["v"]
    fitted = _unit(_matrix(sample, dims))
    half = dims // 2
    books = codebook(fitted[:, :half], side, 1), codebook(fitted[:, half:], side, 2)
    shared = spark.sparkContext.broadcast(books)  # of a size set by ``side``

    def place(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(3), dims))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(nearest(unit[:, :half], shared.value[0]).astype(np.int32)),
                    pa.array(nearest(unit[:, half:], shared.value[1]).astype(np.int32)),
                ],
                ["row", "vec_id", "asks", "v", "first", "second"],
            )

    index = written(
        points.mapInArrow(place, "row long, vec_id long, asks boolean, v array<double>, first int, second int"), "multi-index"
    )
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    cells = index.groupBy("first", "second").agg(F.count("*").alias("n")).toArrow()  # at most one row per cell
    counts[cells["first"].to_numpy(), cells["second"].to_numpy()] = cells["n"].to_numpy()
    held = spark.sparkContext.broadcast(counts)
    enough = max(LEAST, math.ceil(share * total)) + 1  # the query's own row is among them
    blocks = np.maximum(1, -(-counts.sum(1) // BLOCK)).tolist()
    blocks_of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("first") + 1)

    def pick(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), dims))
            near = distances(unit[:, :half], shared.value[0]), distances(unit[:, half:], shared.value[1])
            ids, rows, firsts, seconds = batch.column(0).to_pylist(), [], [], []
            for i in range(len(ids)):
                by_first: dict[int, list[int]] = {}
                for a, b in walk(near[0][i], near[1][i], held.value, enough):
                    by_first.setdefault(a, []).append(b)
                rows += [i] * len(by_first)
                firsts += by_first.keys()
                seconds += by_first.values()
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows) for c in batch.columns), pa.array(firsts, pa.int32()), pa.array(seconds, pa.list_(pa.int32()))],
                ["query_id", "q", "ask", "first", "seconds"],
            )

    # Rows that repeat an id and its vector ask once.
    queries = written(index.where("asks").groupBy("vec_id", "v").agg(F.min("row").alias("ask")), "asking").select("vec_id", "v", "ask")
    parts = max(1, -(-queries.count() // BLOCK))
    picks = queries.mapInArrow(pick, "query_id long, q array<double>, ask long, first int, seconds array<int>")
    left = picks.withColumn("part", F.pmod(F.xxhash64("ask"), F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), blocks_of - 1))
    )
    right = index.drop("asks").withColumn("block", F.pmod(F.xxhash64("row"), blocks_of).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    seconds = len(books[1])

    def rank(asking: pa.Table, there: pa.Table) -> pa.Table:
        out_q, out_r, out_v, out_s = [], [], [], []
        if len(asking) and len(there):
            q, x = level(_matrix(asking["q"], dims)), level(_matrix(there["v"], dims))
            qn, xn = _norms(q), _norms(x)
            ids, cell, numbers = there["vec_id"].to_numpy(), there["second"].to_numpy(), there["row"].to_numpy()
            for i, (query, allowed) in enumerate(zip(asking["query_id"].to_pylist(), asking["seconds"].to_pylist())):
                open_ = np.zeros(seconds, bool)
                open_[allowed] = True
                here = np.flatnonzero(open_[cell] & (ids != query))
                if not len(here):
                    continue
                rough = (x[here] @ q[i]) / xn[here] / qn[i]
                if len(here) > k:
                    here = here[rough >= np.partition(rough, len(here) - k)[len(here) - k] - 1e-9]
                # Row by row, so that equal vectors have equal scores.
                score = (x[here] * q[i]).sum(1) / (xn[here] * qn[i])
                best = np.lexsort((ids[here], -score))[:k]
                out_q += [query] * len(best)
                out_r += numbers[here[best]].tolist()
                out_v += ids[here[best]].tolist()
                out_s += score[best].tolist()
        return pa.table({
            "query_id": pa.array(out_q, pa.int64()), "row": pa.array(out_r, pa.int64()), "vec_id": pa.array(out_v, pa.int64()),
            "score": pa.array(out_s, pa.float64()),
        })

    keys = ("first", "block", "part")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, "query_id long, row long, vec_id long, score double")
    found = found.groupBy("query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _norms(points: np.ndarray) -> np.ndarray:
    return np.sqrt((points * points).sum(1))
