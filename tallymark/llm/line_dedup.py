"""Drop lines that many documents share, with DataFrame functions only.

Lines are normalised and hashed (MD5, 128 bits) once; the hashes of a document are
one row of a written table. Documents per hash are counted with partial sums, so a
line of a third of all documents travels as one row per task. Hashes over the
threshold are written and joined to the positions on equal terms: both sides of
that join are plain exchanges, which adaptive execution splits where a key is hot
and broadcasts where the measured size is small. Only positions travel; the texts
are shuffled once, to meet the positions that they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .texts import BLANKS, fold_ascii, whole_text


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z lower-cased."""
    return fold_ascii(F.btrim(line, F.lit(BLANKS)))


def _text_hash() -> Column:
    return F.xxhash64(F.col("text"))


def _by_document(hashed: DataFrame) -> DataFrame:
    """Each key once per document. Only ids on several rows need a distinct of their own; the rest is not shuffled."""
    keys = hashed.select("doc_id", F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
    again = written(
        hashed.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"),
        "repeated-ids",
    )
    if again.isEmpty():
        return keys.select("key")
    once = keys.join(again, "doc_id", "left_anti").select("key")
    return once.unionByName(keys.join(again, "doc_id", "left_semi").distinct().select("key"))


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` rid of the lines whose key stands in ``min_docs`` documents or more.

    Adds ``n_lines`` (before dropping) and ``n_dropped``; input columns of these names
    are replaced, all others stay. Rows of one id are one document for the count, however
    often it was loaded; a row without an id is a document of its own. A null or empty text is one empty line and comes
    back empty. Keys shorter than ``min_chars`` code points never drop. A document
    that loses all its lines stays with an empty text. Names starting with ``_line_``
    are reserved.
    """
    lines = F.split(whole_text("text"), "\n", -1)
    hashed = written(
        docs.select(
            F.col("doc_id"), _text_hash().alias("hash"),
            F.transform(
                lines,
                lambda x: F.when(F.length(F.btrim(x, F.lit(BLANKS))) >= min_chars, F.md5(F.encode(line_key(x), "UTF-8"))),
            ).alias("keys"),
        ),
        "line-keys",
    )
    shared = written(
        _by_document(hashed).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("key"),
        "shared-lines",
    )
    lost = (
        hashed.select("doc_id", "hash", F.posexplode("keys").alias("pos", "key")).where("key is not null")
        .join(shared, "key", "left_semi")
        .groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set("pos")).alias("lost"))
        .select(F.col("doc_id").alias("_line_id"), F.col("hash").alias("_line_hash"), F.col("lost").alias("_line_lost"))
    )
    kept = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    met = docs.join(
        lost, docs["doc_id"].eqNullSafe(lost["_line_id"]) & _text_hash().eqNullSafe(lost["_line_hash"]), "left"
    )
    held = met.select(
        *kept, lines.alias("_line_all"), F.coalesce("_line_lost", F.array().cast("array<int>")).alias("_line_lost")
    ).withColumn("n_lines", F.size("_line_all")).withColumn("n_dropped", F.size("_line_lost"))
    # What stays are the runs between dropped positions, so a document costs time in proportion to its lines.
    cuts = F.concat(F.array(F.lit(-1)), F.col("_line_lost"), F.array(F.col("n_lines")))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_line_cuts") - 1),
        lambda i: F.slice(
            F.col("_line_all"), F.element_at("_line_cuts", i) + 2,
            F.element_at("_line_cuts", i + 1) - F.element_at("_line_cuts", i) - 1,
        ),
    )
    text = F.array_join(F.flatten(runs), "\n").alias("text")
    out = held.withColumn("_line_cuts", cuts).select(*kept, text, "n_lines", "n_dropped")
    return out.select(*[c for c in docs.columns if c in out.columns and c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
