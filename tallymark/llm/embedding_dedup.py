"""Near-duplicate vectors by a PCA-ordered, tiled comparison.

Unit vectors are turned so that the directions of most variance come first. Tiles are
the leaves of a tree that halves the leading directions; two tiles are compared only if
their boxes come close enough. Within a pair of tiles the products of the leading
components are accumulated first, and what the rest can add is bounded by the product of
the suffix norms (Cauchy-Schwarz): a pair of vectors is dropped as soon as its cosine
cannot reach the threshold. What survives is decided on the vectors as given.

Equal vectors are one class before all this. A tile is cut into blocks of bounded size,
so no group grows with a crowded place. A pair of blocks hands on, per class, how many
vectors it is linked with, and a star for each piece of the blocks that links connect;
never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .components import components
from .vectors import level, padded, usable, width

SAMPLE = 50_000  # vectors that the tree is fitted to
LEAF = 4096  # vectors in a tile, about, and in a block at most by expectation
LEAVES = 10_000  # most tiles; beyond it they grow
LEADING = 8  # directions that the tree and the boxes use
STEPS = (16, 32)  # components accumulated before the bound is tried
SLACK = 1e-9


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(points: np.ndarray) -> np.ndarray:
    scaled = points / np.abs(points).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def principal_directions(classes: DataFrame, dims: int) -> np.ndarray:
    """Columns are directions of falling variance; the driver gets ``dims`` squared sums."""

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            unit = _unit(_matrix(batch.column(0), dims))
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array(total.reshape(-1))], ["cell", "n"]
        )

    sums = classes.select("v").mapInArrow(run, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    moments = np.zeros(dims * dims)
    moments[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    values, directions = np.linalg.eigh(moments.reshape(dims, dims))
    return directions[:, np.argsort(-values)]


class Tree:
    """Halves the sample along the widest leading direction until a leaf stands for ``size`` rows or fewer."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.axis, self.at, self.low, self.leaves = [], [], [], 0
        self._split(sample, depth)

    def _split(self, rows: np.ndarray, depth: int) -> int:
        """The number of the node; a leaf has axis -1 and its leaf number as ``low``."""
        node = len(self.axis)
        spread = rows.max(0) - rows.min(0) if len(rows) else np.zeros(1)
        axis = int(spread.argmax())
        if depth == 0 or len(rows) < 2 or spread[axis] == 0:
            self.axis.append(-1), self.at.append(0.0), self.low.append(self.leaves)
            self.leaves += 1
            return node
        at = float(np.median(rows[:, axis]))
        under = rows[:, axis] < at
        if not under.any():  # the median is the smallest value
            at = float(rows[rows[:, axis] > at, axis].min())
            under = rows[:, axis] < at
        self.axis.append(axis), self.at.append(at), self.low.append(0)
        self._split(rows[under], depth - 1)  # the low side follows its node
        self.low[node] = self._split(rows[~under], depth - 1)
        return node

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        axis, at, low = np.array(self.axis), np.array(self.at), np.array(self.low)
        node, out = np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int32)
        live = np.arange(len(rows))
        while len(live):
            here = node[live]
            done = axis[here] < 0
            out[live[done]] = low[here[done]]
            live, here = live[~done], here[~done]
            node[live] = np.where(rows[live, axis[here]] < at[here], here + 1, low[here])
        return out


def linked(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float) -> np.ndarray:
    """(len(a), len(b)) whether the cosine of the vectors as given reaches the threshold."""
    dims = a.shape[1]
    a, b = level(a), level(b)
    ua, ub = _unit(a) @ turn, _unit(b) @ turn
    steps = [s for s in STEPS if s < dims]
    rest = [(np.sqrt((ua[:, s:] ** 2).sum(1)), np.sqrt((ub[:, s:] ** 2).sum(1))) for s in steps]
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    out = np.zeros((len(a), len(b)), bool)
    for at in range(0, len(a), 512):
        rows = slice(at, at + 512)
        cut = steps[0] if steps else dims
        sums = ua[rows, :cut] @ ub[:, :cut].T
        open_ = sums + rest[0][0][rows, None] * rest[0][1][None, :] >= threshold - SLACK if steps else sums >= threshold - SLACK
        i, j = np.nonzero(open_)
        if len(i) > 0.1 * open_.size:  # nearly all stay: finish them as one product
            i, j = np.nonzero(ua[rows] @ ub.T >= threshold - SLACK)
            steps_left = []
        else:
            steps_left = list(zip([*steps, dims], [*steps[1:], dims])) if steps else []
        for low in range(0, len(i), 200_000):
            x, y = i[low:low + 200_000] + at, j[low:low + 200_000]
            so_far = sums[x - at, y]
            for k, (start, stop) in enumerate(steps_left[:-1], 1):
                so_far = so_far + (ua[x, start:stop] * ub[y, start:stop]).sum(1)
                bound = rest[k][0][x] * rest[k][1][y] if k < len(rest) else 0.0
                stay = so_far + bound >= threshold - SLACK
                x, y, so_far = x[stay], y[stay], so_far[stay]
            exact = (a[x] * b[y]).sum(1) / (na[x] * nb[y])
            out[x[exact >= threshold], y[exact >= threshold]] = True
    return out


def pieces(joined: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the rows and columns that links connect; -1 where there is no link."""
    rows, columns = np.full(joined.shape[0], -1), np.full(joined.shape[1], -1)
    linked_rows = np.flatnonzero(joined.any(1))
    label = 0
    for start in linked_rows.tolist():
        if rows[start] >= 0:
            continue
        front = np.array([start])
        rows[start] = label
        while len(front):
            reached = np.flatnonzero(joined[front].any(0) & (columns < 0))
            columns[reached] = label
            front = reached if same else np.flatnonzero(joined[:, reached].any(1)) if len(reached) else reached
            front = front[rows[front] < 0]
            rows[front] = label
        label += 1
    return rows, columns


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two vectors are linked if their cosine is ``threshold`` or more, in double
    precision. Null and zero vectors, those with null or non-finite components and rows
    without an id link with nothing and are their own component. A shorter vector counts
    as filled up with zeros. Rows that repeat an id are vectors of their own. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    good = usable(vectors).where("vec_id is not null")
    dims = width(good)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if not dims:
        return every.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    good = good.select("vec_id", padded(F.col("v"), dims).alias("v")).select(
        "vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")
    )
    classes = written(
        good.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.any_value("v").alias("v")), "vectors"
    )
    turn = principal_directions(classes, dims)
    total = classes.count()
    leading = min(LEADING, dims)
    leaf_size = max(LEAF, -(-total // LEAVES))
    depth = max(0, int(np.ceil(np.log2(total / leaf_size))))
    drawn = F.pmod(F.xxhash64("id", F.lit("tiles")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / total))
    sample = (classes.where(drawn) if total > SAMPLE else classes).select("v").toArrow()["v"]
    tree = Tree(_unit(_matrix(sample, dims)) @ turn[:, :leading], depth)

    def place(batches):
        for batch in batches:
            at = _unit(_matrix(batch.column(2), dims)) @ turn[:, :leading]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tree.leaf(at)), pa.array(list(at), pa.list_(pa.float64()))],
                ["id", "n", "v", "leaf", "at"],
            )

    placed = written(
        classes.select("id", "n", "v").mapInArrow(place, "id long, n long, v array<double>, leaf int, at array<double>"), "tiles"
    )
    boxes = written(
        placed.groupBy("leaf").agg(
            F.ceil(F.count("*") / leaf_size).cast("int").alias("blocks"),
            *[f(F.col("at")[d]).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in range(leading)],
        ),
        "tile-boxes",
    )
    plan = _plan(boxes, leading, threshold)
    placed = placed.join(boxes.select("leaf", "blocks"), "leaf")
    sent = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(plan, ["leaf", "block"]).select(
        "task", "side", "id", "n", "v"
    )

    def compare(rows_of_task: pa.Table) -> pa.Table:
        side = rows_of_task["side"].to_numpy()
        left, right = rows_of_task.filter(pa.array(side == 0)), rows_of_task.filter(pa.array(side == 1))
        same = not len(right)
        right = left if same else right
        ids, links, roots = [], [], []
        if len(left):
            joined = linked(_matrix(left["v"], dims), _matrix(right["v"], dims), turn, threshold)
            if same:
                np.fill_diagonal(joined, False)
            rows, columns = pieces(joined, same)
            sides = [(left, rows, joined, right)] if same else [(left, rows, joined, right), (right, columns, joined.T, left)]
            least: dict[int, int] = {}
            for table, label, _, _ in sides:
                own = table["id"].to_numpy()
                for i in np.flatnonzero(label >= 0).tolist():
                    least[int(label[i])] = min(int(own[i]), least.get(int(label[i]), int(own[i])))
            for table, label, matrix, other in sides:
                own, has, weight = table["id"].to_numpy(), np.flatnonzero(label >= 0), other["n"].to_numpy()
                ids += own[has].tolist()
                links += (matrix[has] @ weight).tolist()
                roots += [least[int(x)] for x in label[has]]
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(roots, pa.int64())})

    found = written(sent.groupBy("task").applyInArrow(compare, "id long, links long, root long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joint = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = written(
        classes.select("k1", "k2", "id", "n").join(links, "id", "left").join(joint, "id", "left").select(
            "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
        ),
        "vector-classes",
    )
    told = good.select("vec_id", "k1", "k2").join(named, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    silent = _others(vectors, good)
    return told.unionByName(silent).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _others(vectors: DataFrame, good: DataFrame) -> DataFrame:
    """Rows that take no part, as their own component."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    takes_part = F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    own = F.col("vec_id").cast("long")
    return vectors.where(~takes_part).select(
        own.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), own.alias("component_id")
    )


def _plan(boxes: DataFrame, leading: int, threshold: float) -> DataFrame:
    """``(leaf, block, task, side)``: which blocks of which tiles a task compares.

    Tiles, each with itself too, are paired if their boxes are near enough for a cosine at the threshold.
    Every task of this job holds all boxes, at most two per ``LEAVES``, and works out the partners of its own.
    """
    table = boxes.orderBy("leaf").toArrow()  # one row per tile
    leaves, blocks = table["leaf"].to_numpy(), table["blocks"].to_numpy()
    low = np.stack([table[f"min{d}"].to_numpy() for d in range(leading)], 1)
    high = np.stack([table[f"max{d}"].to_numpy() for d in range(leading)], 1)
    shared = boxes.sparkSession.sparkContext.broadcast((leaves, blocks, low, high))
    most = 2 - 2 * threshold + SLACK

    def pair(batches):
        leaves, blocks, low, high = shared.value
        for batch in batches:
            for i in np.searchsorted(leaves, batch.column(0).to_numpy()).tolist():
                gap = np.maximum(0, np.maximum(low[i:] - high[i], low[i] - high[i:]))
                for j in (np.flatnonzero((gap * gap).sum(1) <= most) + i).tolist():
                    x, y = (m.reshape(-1) for m in np.meshgrid(np.arange(blocks[i]), np.arange(blocks[j]), indexing="ij"))
                    if i == j:
                        x, y = x[x <= y], y[x <= y]
                    other = (x != y) if i == j else np.ones(len(x), bool)
                    task = pa.StructArray.from_arrays(
                        [pa.array(np.concatenate((v, v[other])).astype(np.int32)) for v in (np.full(len(x), i), x, np.full(len(x), j), y)],
                        ["a", "x", "b", "y"],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate((np.full(len(x), leaves[i]), np.full(other.sum(), leaves[j]))).astype(np.int32)),
                            pa.array(np.concatenate((x, y[other])).astype(np.int32)), task,
                            pa.array(np.repeat([0, 1], [len(x), other.sum()]).astype(np.int32)),
                        ],
                        ["leaf", "block", "task", "side"],
                    )

    plan = boxes.select("leaf").mapInArrow(pair, "leaf int, block int, task struct<a int, x int, b int, y int>, side int")
    return written(plan, "tile-plan")
