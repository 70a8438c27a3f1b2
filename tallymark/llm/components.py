"""Connected components of a link table, by alternating large-star and small-star rounds.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.) Each round is
two pairs of a partial minimum and a join. The minima are written before they are
joined, so both sides of the join are exchanges and a centre with very many links is
split at run time. The driver sees a row count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of long ids to ``(id, component)``, where the component is its smallest id.

    Direction, repeats and links of an id with itself do not matter; links with a null
    are ignored. An id without links does not appear.
    """
    cur = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = _checksum(cur)
    while True:
        after = _small_star(_large_star(cur))
        mark = _checksum(after)
        cur = after
        if mark == seen:
            break
        seen = mark
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"), "least")
    down = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return down.join(least, "u", "left").select(
        F.col("v").alias("u"), F.coalesce("m", "u").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    edges = written(edges, "large-star")
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    met = edges.join(least, "u")
    return written(
        met.select("u", F.col("m").alias("v"))
        .union(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(),
        "small-star",
    )
