"""Exact token counts of whole documents without running the tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .transducer import transducer


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row, by the vocabulary file ``model``.

    A null or empty text has no bytes and no tokens. Rows with equal or null ids each
    come back. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = transducer(model).counts(t or "" for t in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(counts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("n_bytes")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
