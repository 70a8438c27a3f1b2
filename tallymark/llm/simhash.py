"""Near-duplicates by SimHash fingerprints (Charikar 2002; Manku et al. 2007).

A fingerprint is cut into five blocks. Two fingerprints that differ in at most two
bits agree in at least three blocks, so each is keyed ten times by three of its blocks
(38 or 39 bits) and compared only with those that share a key. Equal fingerprints are
one class before that, so copies cost nothing. A key that more than ``WIDE`` classes
share is not paired off: each of its members is entered once as it is and once with each
of the remaining bits flipped, and all that meet at one entry lie within two bits of
each other. That is as exact as the pairing and grows with the group, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .components import components
from .texts import whole_text

BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
MAX_BITS = 2
WIDE = 64
SEED = 42
_PIECE = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """The majority bits of the hashes of all word shingles, repeats included; 0 without words."""
    parts = text.lower().split()  # of bytes: folds A-Z and cuts at [\x20\x09-\x0D] only
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) < words:
        starts, ends = [0], [len(line)]
    else:
        stop = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate(([0], stop[: len(parts) - words])).tolist()
        ends = (stop[words - 1:] - 1).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _PIECE):  # a very long text takes no more memory than a piece
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + _PIECE], ends[at:at + _PIECE])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the unsigned fingerprint as a signed long. A null text has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or b"", words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, fp long"
    )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within two bits of each other.

    Below ``WIDE`` members of a key every pair is linked; above, enough of them that
    the components are the same.
    """
    picks = [sum(((1 << n) - 1) << at for at, n in pick) for pick in combinations(BLOCKS, len(BLOCKS) - MAX_BITS)]
    keyed = classes.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).cast("byte").alias("pick"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
            for i, m in enumerate(picks)
        ])).alias("block"),
    ).select("fp", "block.pick", "block.key")
    shared = written(keyed.groupBy("pick", "key").agg(F.count("*").alias("n")).where("n > 1"), "shared-blocks")
    members = written(keyed.join(shared, ["pick", "key"]), "block-members")
    few, many = members.where(F.col("n") <= WIDE), members.where(F.col("n") > WIDE)
    left, right = few.select("pick", "key", F.col("fp").alias("a")), few.select("pick", "key", F.col("fp").alias("b"))
    pairs = left.join(right, ["pick", "key"]).where("a < b").where(F.bit_count(F.expr("a ^ b")) <= MAX_BITS)
    flips = F.array(*[
        F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << bit)).cast("long") for bit in range(64) if not m >> bit & 1])
        for m in picks
    ])
    entered = many.select("pick", "fp", F.explode(F.element_at(flips, F.col("pick") + 1)).alias("flip")).select(
        "pick", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("entry")
    )
    least = entered.groupBy("pick", "entry").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = entered.join(least, ["pick", "entry"]).select(F.col("fp").alias("a"), "b").where("a <> b").where(
        F.bit_count(F.expr("a ^ b")) <= MAX_BITS
    )
    return pairs.select("a", "b").union(stars).distinct()


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    Linked are documents whose fingerprints differ in at most two bits, and
    ``component_id`` is the smallest id that links reach. A null or empty text has
    fingerprint 0 and links like any other. Rows with equal ids each come back; a null
    id is never the smallest unless its component has no other. Other columns are not read.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    met = components(links(classes)).join(classes.withColumnRenamed("fp", "id"), "id")
    met = written(met, "linked")
    least = written(met.groupBy("component").agg(F.min("first").alias("least")), "component-ids")
    linked = met.join(least, "component").select(F.col("id").alias("fp"), "least")
    named = written(
        classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "class-ids"
    )
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one document of each.

    Rows that repeat an id are decided by their own text: one whose fingerprint belongs to
    another document's group goes, and of those that stand for one group one row stays. A
    row without an id stays, as nothing can name it.
    """
    named = written(near_duplicates(docs, words), "near-duplicates")
    again = written(
        named.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"),
        "repeated-ids",
    )
    gone = named.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    if again.isEmpty():
        return docs.join(gone, "doc_id", "left_anti")
    once = docs.join(gone.unionByName(again), "doc_id", "left_anti")
    many = docs.join(again, "doc_id", "left_semi").withColumn("_near_text", F.xxhash64(whole_text("text")))
    prints = fingerprints(many.select(F.col("_near_text").alias("doc_id"), "text").dropDuplicates(["doc_id"]), words)
    prints = prints.select(F.col("doc_id").alias("_near_text"), F.col("fp").alias("_near_fp"))
    stands = named.where("doc_id = component_id").select("doc_id", F.col("fp").alias("_near_fp")).distinct()
    kept = many.join(prints, "_near_text").join(stands, ["doc_id", "_near_fp"], "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(kept.select(*docs.columns))
