"""Best-fit packing of token sequences by large-item matching.

Lengths are whole numbers up to the capacity, so the plan is made on their histogram:
at most ``capacity`` counts reach the driver, however many documents there are. Pieces
above one third of the capacity are placed at most twice per bin, each with the largest
partner that fits; smaller ones, longest first, go to the smallest gap that takes them.
Bins of equal content are kept as ranges, so the plan is a bounded list of runs
(length, ranks) -> (first bin, offset). Ranks within a length are dealt without sorting
or a window over a length: each task counts its own pieces, and the counts of the tasks
before it are added.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written
from .wordids import word_ids


class Run(NamedTuple):
    length: int
    first_rank: int
    ranks: int
    first_bin: int
    offset: int


class _Bins:
    """Ranges of bins by their gap; ``mask`` has a bit for every gap that occurs."""

    def __init__(self, capacity: int):
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.mask, self.capacity, self.opened, self.runs = 0, capacity, 0, []

    def add(self, gap: int, start: int, count: int) -> None:
        if count:
            self.ranges[gap].append((start, count))
            self.mask |= 1 << gap

    def take(self, gap: int, most: int) -> tuple[int, int]:
        start, count = self.ranges[gap].pop()
        if count > most:
            self.ranges[gap].append((start + most, count - most))
        elif not self.ranges[gap]:
            self.mask &= ~(1 << gap)
        return start, min(count, most)

    def open(self, count: int) -> None:
        self.add(self.capacity, self.opened, count)
        self.opened += count

    def place(self, length: int, rank: int, gap: int, most: int) -> int:
        start, count = self.take(gap, most)
        self.runs.append(Run(length, rank, count, start, self.capacity - gap))
        self.add(gap - length, start, count)
        return count

    def smallest(self, length: int) -> int:
        """The smallest gap of at least ``length``, or -1."""
        rest = self.mask >> length
        return (rest & -rest).bit_length() - 1 + length if rest else -1


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs that place ``counts[length]`` pieces of each length, and the number of bins."""
    bins, rank = _Bins(capacity), dict.fromkeys(counts, 0)
    left = dict(counts)
    large = sorted((n for n in counts if n * 3 > capacity), reverse=True)

    def put(length: int, gap: int, most: int) -> int:
        done = bins.place(length, rank[length], gap, most)
        rank[length] += done
        left[length] -= done
        return done

    for length in large:
        while left[length]:
            # The largest partner that fits; a last piece cannot be its own.
            fits = (x for x in large if x <= capacity - length and left[x] > (x == length))
            partner = next(fits, None)
            if partner is None:
                bins.open(left[length])
                while left[length]:
                    put(length, capacity, left[length])
                break
            both = left[length] // 2 if partner == length else min(left[length], left[partner])
            bins.open(both)
            todo = both
            while todo:
                todo -= put(length, capacity, todo)
            todo = both
            while todo:
                todo -= put(partner, capacity - length, todo)
    for length in sorted((n for n in counts if n * 3 <= capacity), reverse=True):
        while left[length]:
            gap = bins.smallest(length)
            if gap < 0:
                bins.open(-(-left[length] // (capacity // length)))
                continue
            put(length, gap, left[length])
    return bins.runs, bins.opened


def _pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of all documents, numbered within their task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encoder, step, end = word_ids(vocabulary), capacity * 4, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            found = encoder.ids(t or b"" for t in batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    n = len(part) // 4
                    rows.append((doc_id, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    )


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """One row per piece of every document, with the sequence and the place it goes to.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are
    cut. A null or empty text is its end alone. Rows with equal or null ids are
    documents of their own. No rows give no sequences. Other columns are not read.
    """
    pieces = written(_pieces(docs, vocabulary, end_id, capacity), "pieces")
    per_task = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "pieces-per-task")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    runs, _ = plan(counts, capacity)
    runs.sort()
    lengths, ranks, n, bins, offsets = (np.array(c, np.int64) for c in (zip(*runs) if runs else [()] * 5))
    span = max(counts.values(), default=0) + 1
    keys = lengths * span + ranks

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bins[at] + rank - ranks[at]), pa.array(offsets[at])],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    # One row per task and length: a window over a length has as many rows as there are tasks.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = written(
        per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "earlier-pieces"
    )
    # Its rows grow with the tasks and compress far better than they unpack, so it is not broadcast.
    ranked = pieces.join(before.hint("merge"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
