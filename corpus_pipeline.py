"""From raw documents to packed sequences: language, shared lines, near-duplicates, packing.

Each stage works on all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.llm import language, line_dedup, packing, simhash
from tallymark.session import written


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts without letters and noise go."""
    return language.drop_rejected(docs, language.learn(docs))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that ten or more of them share; ``n_chars`` is that of the text left."""
    kept = line_dedup.drop_shared_lines(docs, min_docs=10, min_chars=1)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints chain within two bits."""
    return simhash.keep_one(docs, words=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language", by_language),
    ("line_dedup", without_shared_lines),
    ("simhash", one_of_each_group),
    ("packing", packed),
]

# Tokens and fingerprints are beyond SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
