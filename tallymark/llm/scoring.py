"""Language-model scores of whole documents: word counts smoothed by a subword lattice.

The probability of a text is that of its words and one end. A word's probability is the
sum over all ways to write it: as itself, by its discounted count, or by any segmentation
into the pieces of an existing vocabulary, whose scores start from the vocabulary's own
order and are fitted to the training words by expectation maximisation. The weight of the
second way is what the discount sets free, so all probabilities add up to one.

Counts are gathered per task and then by one shuffle. The most frequent words, at most
``HOT`` in number whatever the corpus, are broadcast and settled where the text is; among
them are all that make up 1 / ``HOT`` of all tokens. All other words travel as (document,
word, count) to a join by word, and as none of them is frequent, no key of it is large.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, functions as F

from ..session import written
from .lattice import Lattice, vocabulary

HOT = 400_000  # so many of the most frequent words at most are settled without a shuffle
HELD = 400_000  # words and their counts that a task holds before it adds them up, and hands on what is then above half
PART = 1 << 24  # bytes of text whose tokens are held at once, or one longer text
ROUNDS = 2  # of expectation maximisation
BASE_ADD = 0.1
END = ""  # stands for the end of a text; no word is empty


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Parts of a batch with column ``text``, the row and the word of each token, and the part's distinct words.

    Folds A-Z and cuts at [\\x20\\x09-\\x0D] only, bytes above being no letters here. The ends of the texts are not among the tokens.
    """
    size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy())
    cuts = np.searchsorted(size, np.arange(PART, size[-1] if len(size) else 0, PART))
    for start, stop in pairwise(np.unique([0, *cuts, batch.num_rows]).tolist()):
        part = batch.slice(start, stop - start)
        found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part["text"], "")))
        flat = found.flatten()
        filled = pc.greater(pc.binary_length(flat), 0)  # a text's outer blanks cut off empty words
        rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(found).to_numpy())[filled.to_numpy(zero_copy_only=False)]
        coded = flat.filter(filled).dictionary_encode()
        yield part, rows, coded.indices.to_numpy(), coded.dictionary


def lexicon(docs: DataFrame) -> DataFrame:
    """``(word, c, c_all)``: tokens of the training documents, and of all, from ``(text, trains)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part, rows, words, distinct in _tokens(batch):
                trains = part["trains"].to_numpy(zero_copy_only=False).astype(bool)
                n = len(distinct)
                counts = [np.bincount(words[trains[rows]], minlength=n), np.bincount(words, minlength=n)]
                ends = [trains.sum(), len(trains)]
                held.append(pa.Table.from_arrays(
                    [pa.concat_arrays([distinct, pa.array([END])]), *(pa.array(np.append(c, e)) for c, e in zip(counts, ends))],
                    ["word", "c", "c_all"],
                ))
                size += n
                if size > HELD:
                    held = [_counted(held)]
                    if held[0].num_rows * 2 > HELD:
                        yield from held[0].to_batches()
                        held = []
                    size = sum(h.num_rows for h in held)
        if held:
            yield from _counted(held).to_batches()

    counted = docs.select("text", "trains").mapInArrow(run, "word string, c long, c_all long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def _counted(held: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum"), ("c_all", "sum")])
    return summed.select(["word", "c_sum", "c_all_sum"]).rename_columns(["word", "c", "c_all"]).combine_chunks()


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities fitted to the distinct training words; the driver gets one count per piece a round."""
    pieces = vocabulary(path)
    held = pieces.by_rank()
    known = words.where((F.col("c") > 0) & (F.col("word") != END)).select("word")
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], held: np.ndarray = held) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(vocabulary(path), held), 0.0
            for batch in batches:
                total = total + lattice.expected(batch.column(0).to_pylist())
            if np.ndim(total):
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "n"])

        seen = known.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(pieces.size, 0.01)  # a piece never seen stays possible
        counts[seen["piece"].to_numpy()] += seen["n"].to_numpy()
        held = counts / counts.sum()
    return held


def _step() -> Column:
    """How frequent a word is, in eighths of a doubling."""
    return F.floor(F.log2("c_all") * 8)


def _settled(steps: list[Row], n_all: int) -> Column:
    """Which words are settled in place: as many steps from the top as hold ``HOT`` words or fewer, and all with
    1 / ``HOT`` of all tokens, of which there are no more either."""
    words, least = 0, 64 * 8
    for row in sorted(steps, key=lambda r: -r["step"]):
        words += row["words"]
        if words > HOT:
            break
        least = row["step"]
    return (_step() >= least) | (F.col("c_all") * HOT >= n_all)


def _scored(words: DataFrame, path: str, held: np.ndarray, sums: dict[str, int]) -> DataFrame:
    """``words`` with the base score and the score of each, as log10."""
    n, distinct = sums["n"], sums["v"]
    discount = sums["n1"] / (sums["n1"] + 2 * sums["n2"]) if sums["n1"] else 0.5  # Ney, Essen and Kneser 1994
    free = discount * distinct / n if n else 0.5  # what goes to the lattice
    base = n + BASE_ADD * (distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary(path), held)
        for batch in batches:
            texts, c = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            spelled = np.exp(lattice.forward([w or " " for w in texts]))
            # With nothing learned the end takes the half that words leave.
            end = np.array([w == END for w in texts], bool)
            spelled[end] = 0.0
            itself = np.maximum(c - discount, 0) / n if n else end * 0.5
            with np.errstate(divide="ignore"):
                score = np.log10(itself + free * spelled)
            few = ~np.isfinite(score)  # too small to add up: in logarithms
            if few.any():
                score[few] = lattice.forward([texts[i] or " " for i in np.flatnonzero(few)]) / math.log(10) + math.log10(free or 1e-300)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.log10((c + BASE_ADD) / base)), pa.array(score)],
                [*batch.schema.names, "base", "score"],
            )

    return words.mapInArrow(run, "word string, c long, c_all long, base double, score double")


def score(docs: DataFrame, trains, path: str) -> DataFrame:
    """Scores of every row of ``docs``, learning from those where the condition ``trains`` holds.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; both
    scores are log10 probabilities of the whole text. A null or empty text is one end.
    Rows with equal or null ids are documents of their own. Where nothing trains, the base
    is that of no counts and the score is that of the vocabulary as it comes. Other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(trains, F.lit(False)).alias("trains"), "text"
    )
    words = written(lexicon(rows), "lexicon")
    steps = words.groupBy(_step().alias("step")).agg(  # some hundred rows
        F.sum("c").alias("n"), F.count_if(F.expr("c > 0")).alias("v"), F.count_if(F.expr("c = 1")).alias("n1"),
        F.count_if(F.expr("c = 2")).alias("n2"), F.sum("c_all").alias("n_all"), F.count("*").alias("words"),
    ).collect()
    sums = {k: sum(row[k] for row in steps) for k in ("n", "v", "n1", "n2", "n_all")}
    settled = _settled(steps, sums["n_all"])
    known = written(_scored(words, path, fit(words, path), sums), "scored-lexicon")
    often = known.where(settled).toArrow().combine_chunks()  # at most HOT rows
    hot = spark.sparkContext.broadcast((
        pa.concat_arrays(often["word"].chunks or [pa.array([], pa.string())]),
        *(np.append(often[c].to_numpy(), 0) for c in ("base", "score")), np.append(often["c"].to_numpy() > 0, False),
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (settled_words, *values), nth = hot.value, TaskContext.get().partitionId() << 33
        end = pc.index_in(pa.array([END]), settled_words).to_pylist()[0]
        for batch in batches:
            for part, rows, words, distinct in _tokens(batch):
                n = part.num_rows
                place = pc.fill_null(pc.index_in(distinct, settled_words), -1).to_numpy()  # the last value is that of none
                base, score_, known_ = (np.bincount(rows, v[place][words], n) for v in values)
                # The settled part of a document; a blank keeps its key apart from all words.
                own = np.arange(nth, nth + n)
                if end is not None:
                    base, score_, known_ = (total + v[end] for total, v in zip((base, score_, known_), values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array([f" {i}" for i in own.tolist()], pa.string()), pa.array(np.zeros(n, np.int32)), part["doc_id"],
                     pc.invert(part["trains"]), pa.array(base), pa.array(score_), pa.array(np.bincount(rows, minlength=n) + 1),
                     pa.array(known_.astype(np.int64))],
                    _PARTS,
                )
                some = np.flatnonzero((place < 0)[words])
                pairs, times = np.unique(rows[some] * len(distinct) + words[some], return_counts=True)
                at, which = np.divmod(pairs, max(len(distinct), 1))
                at, which = own[at], distinct.take(pa.array(which))
                if end is None:
                    at, times = np.append(at, own), np.append(times, np.ones(n, np.int64))
                    which = pa.concat_arrays([which, pa.array([END] * n, pa.string())])
                zero = [pa.array(np.zeros(len(at), k)) for k in (np.float64, np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), which, pa.array(times.astype(np.int32)), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.bool_()),
                     zero[0], zero[0], zero[1], zero[1]],
                    _PARTS,
                )
                nth += n

    parts = rows.mapInArrow(
        run, "nth long, word string, times int, doc_id long, held_out boolean, base_score double, score double, "
        "n_tokens long, n_known long"
    )
    rare = known.where(~settled).select(
        "word", F.col("base").alias("word_base"), F.col("score").alias("word_score"), (F.col("c") > 0).cast("long").alias("seen")
    )
    met = parts.join(rare, "word", "left").select(
        "nth", "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("times") * F.col("seen"), F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce(F.col("times") * F.col("word_base"), F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("times") * F.col("word_score"), F.lit(0.0))).alias("score"),
    )
    summed = met.groupBy("nth").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
    )
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(sums["n"]).cast("long").alias("train_tokens"), "base_score", "score"
    )


_PARTS = ["nth", "word", "times", "doc_id", "held_out", "base_score", "score", "n_tokens", "n_known"]
