"""How far the term shares of each source stand from its language and from the other sources.

Only counts decide how far a term's shares stand apart, so terms are not compared one by
one: they are counted into cells. For a source against its language a cell is the pair
(count in the group, count in the language); ``f`` is worked out once per cell, the cells
are ranked by how many terms stand before them, cells of equal value are one, and only the
cells that reach the wanted ranks are opened into terms, in UTF-8 order. For a source
against another the cells are the pairs of their counts. Terms with the same counts in all
sources are one profile first, and what a source has alone follows from its own counts,
so absent terms are never listed.

Tasks count their own documents' terms and hand on the counts; all after that is DataFrame
code on whole numbers.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .texts import whole_text

PARTS = 1_000_000_000  # shares are whole parts of a billion
HELD = 500_000  # different terms that a task counts before it hands them on

# Bytes of a text as they count: A-Z lower-cased, other ASCII that is no letter a blank. Beyond ASCII all belongs to terms.
_AS_COUNTED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def _decimal(number: Column, digits: int = 19) -> Column:
    return number.cast(f"decimal({digits},0)")


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(PARTS * (n + 1) / (total + kept))``; no number is too large on the way."""
    parts = F.lit(PARTS).cast("decimal(10,0)") * _decimal(n + 1)
    return F.lit(1) + F.call_function("div", parts, _decimal(total + kept))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _counted(batches):
    """Counts of the terms of each group, and of the documents with them; handed on when many are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = text.translate(_AS_COUNTED).split()
            size -= len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n)
            if size >= HELD:
                yield from out()
                size = 0
    yield from out()


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, source, term, n, total, first)`` of the terms in enough documents of the language.

    ``total`` is the term's count in the language; ``first`` holds on one row per term and language.
    Tasks have added up their own counts, so all rows of a term meet in one exchange.
    """
    texts = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text("text").cast("binary").alias("text"))
    counted = (
        texts.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
        .withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    there = Window.partitionBy("lang", "term")
    return (
        counted.select(
            "lang", "source", "term", "n", F.sum("n").over(there).alias("total"),
            F.sum("docs").over(there).alias("docs"), (F.min("source").over(there) == F.col("source")).alias("first"),
        )
        .where(F.col("docs") >= min_docs).drop("docs")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, n_group, n_terms, n_lang, kept)`` of every group, also those without terms."""
    groups = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count("*").alias("n_terms"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("first").alias("kept"))
    return groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)


def ranked_terms(kept: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The terms a group uses more than its language, by ``f``: ranks to ``top``."""
    group = ["lang", "source"]
    p, q = share(F.col("n"), F.col("n_group"), F.col("kept")), share(F.col("total"), F.col("n_lang"), F.col("kept"))
    cells = (
        kept.groupBy(*group, "n", "total").agg(F.count("*").alias("terms")).join(totals, group)
        .withColumns({"p": p, "q": q}).where("p > q")
        .select(*group, "n", "total", "terms", distance(F.col("p"), F.col("q")).alias("value"))
    )
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    before = F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    # Every value stands for a term at least, so no more than ``top`` values reach the ranks.
    values = (
        cells.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
        .withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
        .withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    )
    opened = cells.join(values.select(*group, "value", "before"), [*group, "value"])
    by_name = Window.partitionBy(*group, "value").orderBy("term")
    return (
        kept.join(opened.select(*group, "n", "total", "value", "before"), [*group, "n", "total"])
        .select(*group, "term", "value", "before", F.row_number().over(by_name).alias("within")).where(F.col("within") <= top)
        .select(
            *group, F.lit("term").alias("part"), F.col("term").alias("item"), "value",
            (F.col("before") + F.col("within")).cast("int").alias("rank"),
        )
        .where(F.col("rank") <= top)
    )


def ranked_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Each group against each other source of its language, by ``f`` summed over all kept terms.

    With ``m`` terms in a cell of counts ``(a, b)``, terms in one source alone are those with
    that count there less those in cells of both, and likewise the terms in neither. So the
    sum is taken over three kinds of cells, and those of both sources also take back what the
    other two gave too much.
    """
    key = ["lang", "g", "h"]
    none = share(F.lit(0), F.col("n_group"), F.col("kept"))
    ours = totals.where("kept > 0").select(
        "lang", F.col("source").alias("g"), F.col("n_group").alias("n_g"), F.col("n_terms").alias("t_g"), none.alias("g_0"), "kept"
    )
    theirs = totals.where("kept > 0").select(
        "lang", F.col("source").alias("h"), F.col("n_group").alias("n_h"), F.col("n_terms").alias("t_h"), none.alias("h_0")
    )
    pairs = ours.join(theirs, "lang").where("g <> h")
    g_0, h_0 = F.col("g_0"), F.col("h_0")

    def summed(df: DataFrame, **values: Column) -> DataFrame:
        return df.groupBy(*key).agg(*[F.sum(_decimal(v, 38)).alias(name) for name, v in values.items()])

    counts = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    counts = counts.join(totals, ["lang", "source"]).select(
        "lang", "source", "m", share(F.col("n"), F.col("n_group"), F.col("kept")).alias("own")
    )
    m, own = _decimal(F.col("m")), F.col("own")
    neither = pairs.select(*key, _decimal(_decimal(F.col("kept") - F.col("t_g") - F.col("t_h")) * distance(g_0, h_0), 38).alias("value"))
    of_g = summed(counts.withColumnRenamed("source", "g").join(pairs, ["lang", "g"]), value=m * distance(own, h_0))
    of_h = summed(counts.withColumnRenamed("source", "h").join(pairs, ["lang", "h"]), value=m * distance(g_0, own))
    profiles = (
        kept.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"))
        .where(F.size("counts") > 1).groupBy("lang", "counts").agg(F.count("*").alias("m"))
    )
    cells = (
        profiles.select("lang", "m", "counts", F.explode("counts").alias("a"))
        .select("lang", "m", "a", F.explode("counts").alias("b")).where("a.source < b.source")
        .groupBy("lang", F.col("a.source").alias("g"), F.col("b.source").alias("h"), F.col("a.n").alias("a"), F.col("b.n").alias("b"))
        .agg(F.sum("m").alias("m"))
    )
    a, b = F.col("a"), F.col("b")
    shares = {"a": share(a, F.col("n_g"), F.col("kept")), "b": share(b, F.col("n_h"), F.col("kept"))}

    def taken_back(p: Column, q: Column, p_0: Column, q_0: Column) -> Column:
        return m * (distance(p, q) - distance(p, q_0) - distance(p_0, q) + distance(p_0, q_0))

    both = summed(
        cells.join(pairs, key).withColumns(shares), there=taken_back(a, b, g_0, h_0), back=taken_back(b, a, h_0, g_0)
    )
    turned = both.select(
        "lang", F.inline(F.array(
            F.struct(F.col("g").alias("g"), F.col("h").alias("h"), F.col("there").alias("value")),
            F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("back").alias("value")),
        ))
    )
    no_terms = totals.where("kept = 0").select("lang", F.col("source").alias("g"))
    zero = no_terms.join(no_terms.withColumnRenamed("g", "h"), "lang").where("g <> h").withColumn("value", _decimal(F.lit(0), 38))
    values = summed(neither.unionByName(of_g).unionByName(of_h).unionByName(turned).unionByName(zero), value=F.col("value"))
    order = Window.partitionBy("lang", "g").orderBy(F.desc("value"), "h")
    return values.select(
        "lang", F.col("g").alias("source"), F.lit("pair").alias("part"), F.col("h").alias("item"),
        F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"),
    )


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources (``pair``) and telling terms (``term``) of each group.

    A group is a (lang, source) that occurs, a null counting as empty in either and in the text. A row
    is a document, so rows that repeat count each. A language keeps the terms in ``min_docs`` of its
    documents or more; a group without any of them still stands against the others, with value 0 where
    its language keeps no term. Equal values are ranked by the item's bytes. A text of any length is
    counted whole by one task. Other columns are not read, whatever their names; no rows give none.
    """
    docs = docs.select("text", "lang", "source")
    kept = written(kept_terms(docs, min_docs), "kept-terms")
    totals = written(group_totals(docs, kept), "group-totals")
    return ranked_pairs(kept, totals).unionByName(ranked_terms(kept, totals, top))
