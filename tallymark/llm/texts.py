"""Column helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white space of the word and line rules, [\x20\x09-\x0D], and the letters they fold.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Plain ASCII takes the much faster ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: a fixed split of the documents. A null id falls into part 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) if isinstance(doc_id, str) else F.crc32(doc_id), F.lit(0)) % parts
