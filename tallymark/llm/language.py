"""Language of a text from bit-sliced Bloom filters of character n-grams.

A filter slot holds one bit per language, so one look-up of a gram's slots, joined by
AND, gives the set of all languages that have the gram. A language's hits are the
popcount of its bit over all grams of the text, less what its filter's fill rate lets
through by chance. The language with the most corrected hits is the answer.

A language has a gram if it saw it at least ``min_count`` times and its rate is at least
``ratio`` of the highest rate that any language has, so passages that strayed into
another language's documents do not count there.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import written

ORDERS = (2, 3, 4)
HASHES = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20  # code points looked up at once, however long a text is

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))
    return _LETTERS[0]


class Filters(NamedTuple):
    languages: list[str]
    common: str  # the most frequent one
    slots: np.ndarray  # (slots, bytes): bit b of byte p is language 8 p + b
    chance: np.ndarray  # per language, how often its filter holds a gram it never saw

    def corrected(self, grams: np.ndarray) -> np.ndarray:
        """Hits per language, less those expected by chance."""
        if not len(grams):
            return np.zeros(len(self.languages))
        masks = None
        for slot in _slots(grams, len(self.slots)):
            found = self.slots[slot]
            masks = found if masks is None else masks & found
        hits = np.array([
            np.count_nonzero(masks[:, lang >> 3] & np.uint8(1 << (lang & 7))) for lang in range(len(self.languages))
        ])
        return np.maximum(0.0, (hits - len(grams) * self.chance) / (1 - self.chance))


def _slots(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """``HASHES`` slots of each gram; ``size`` is a power of two."""
    high = (grams >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((grams + np.uint64(i) * high) & np.uint64(size - 1)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points with every run of other than letters as one space, and a space at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    codes = np.concatenate(([32], codes, [32])).astype(np.uint64)
    return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]


def grams_of(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of the text, repeats included; none if it has no letter."""
    codes = _codes(text)
    if len(codes) < 3:
        return
    for at in range(0, len(codes), _PIECE):
        part = codes[at:at + _PIECE + max(ORDERS) - 1]
        for n in ORDERS:
            count = min(_PIECE, len(part) - n + 1)
            if count <= 0:
                continue
            mixed = np.full(count, n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ part[k:k + count]) * _ODD
                mixed ^= mixed >> np.uint64(29)
            yield mixed


def learn(
    labelled: DataFrame, sample_docs: int = 3000, min_count: int = 3, ratio: float = 0.1, size: int = 1 << 20
) -> Filters:
    """Filters from ``(doc_id, text, lang)`` rows.

    ``sample_docs`` bounds the fitted sample: about as many documents of each language,
    chosen by a hash of their id, with their whole texts. The driver gets the counts of
    the languages and at most ``size`` filter slots. Rows without text or language
    teach nothing.
    """
    rows = labelled.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    planes = max(1, -(-len(languages) // 8))
    if not languages:
        return Filters([], "und", np.zeros((size, planes), np.uint8), np.zeros(0))
    share: Column = F.lit(0.0)
    number: Column = F.lit(-1)
    for i, lang in enumerate(languages):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / counts[lang]))).otherwise(share)
        number = F.when(F.col("lang") == lang, F.lit(i)).otherwise(number)
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 20)) < share * (1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for grams in grams_of(text):
                    found, n = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), lang, np.int32)), pa.array(found.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    seen = written(
        rows.where(drawn).select(number.alias("lang"), "text").mapInArrow(count, "lang int, gram long, n long")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n")),
        "seen-grams",
    )
    # The share of a gram within its order is what is compared; totals differ by language, not by gram.
    frequent = seen.where(F.col("n") >= min_count)
    totals = {r["lang"]: r["n"] for r in seen.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rate: Column = F.lit(0.0)
    for lang, total in totals.items():
        rate = F.when(F.col("lang") == lang, F.col("n") / F.lit(float(total))).otherwise(rate)
    rates = frequent.withColumn("rate", rate).groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("held")
    )
    has = rates.select("gram", "top", F.explode("held").alias("h")).where(F.col("h.rate") >= ratio * F.col("top"))
    high = F.shiftrightunsigned(F.col("gram"), 32).bitwiseOR(F.lit(1).cast("long"))

    def slot(i: int) -> Column:
        return F.pmod(_wrapped_sum(F.col("gram"), high, i), F.lit(size))

    slots = has.select(
        F.explode(F.array(*[slot(i) for i in range(HASHES)])).alias("slot"),
        F.expr("cast(floor(h.lang / 8) as int)").alias("plane"), F.expr("shiftleft(1, h.lang % 8)").alias("bit"),
    ).groupBy("slot", "plane").agg(F.bit_or("bit").alias("bits")).toArrow()
    filled = np.zeros((size, planes), np.uint8)
    filled[slots["slot"].to_numpy(), slots["plane"].to_numpy()] = slots["bits"].to_numpy()
    fill = np.array([np.count_nonzero(filled[:, i >> 3] & (1 << (i & 7))) / size for i in range(len(languages))])
    return Filters(languages, max(languages, key=counts.get), filled, fill ** HASHES)


def _wrapped_sum(gram: Column, high: Column, times: int) -> Column:
    """The low 32 bits of ``gram + times * high``, without overflow."""
    low = F.lit(0xFFFFFFFF).cast("long")
    return (gram.bitwiseAND(low) + F.lit(times) * high.bitwiseAND(low)).bitwiseAND(low)


def predict(docs: DataFrame, filters: Filters, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, then ``lang_pred`` and ``score``.

    ``score`` is the share of the text's grams that the language has. A text that is null or
    has no letter is ``und`` with score 0. One without a hit in any language is of the most
    frequent language, with score 0; equal hits go to the language first in order. With
    nothing learned all is ``und``. Only ``text`` decides. Columns of ``keep`` named like the
    two results give way to them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # the filter size is fixed, whatever the corpus
    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(0).to_pylist():
                n, hits = 0, np.zeros(max(1, len(held.languages)))
                for grams in grams_of(text or ""):
                    n += len(grams)
                    if held.languages:
                        hits = hits + held.corrected(grams)
                best = int(hits.argmax())
                known = hits[best] > 0
                langs.append("und" if not n else held.languages[best] if known else held.common)
                scores.append(min(1.0, float(hits[best]) / n) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    picked = docs.select(F.col("text").alias("_lang_text"), *keep)
    out = StructType([*picked.schema.fields[1:], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return picked.mapInArrow(run, out)


def drop_rejected(docs: DataFrame, filters: Filters, least: float = 0.3) -> DataFrame:
    """The rows whose language is told, with at least the share ``least`` of its grams known; columns as they were."""
    told = predict(docs.withColumnsRenamed(_HELD), filters, keep=tuple(_HELD.get(c, c) for c in docs.columns))
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(
        *[F.col(_HELD.get(c, c)).alias(c) for c in docs.columns]
    )


_HELD = {"lang_pred": "_lang_pred", "score": "_lang_score"}  # input columns of these names wait under others
