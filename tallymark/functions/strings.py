"""Trimming and word tests shared by the other functions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# All Unicode white space, which is more than the blank that SQL's trim removes.
_SPACE_CODES = [
    *range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITE_SPACE = "".join(map(chr, _SPACE_CODES))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def text_or_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def unless_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def has_any(name: Column, words: list[str]) -> Column:
    """True when a name contains one of the words, anywhere. One pattern keeps the plan small."""
    return name.rlike("|".join(re.escape(w) for w in words))


def text_has_any(text: Column, words: list[str]) -> Column:
    """The same for values met in every row: a byte search per word is several times faster than a pattern."""
    return reduce(or_, [text.contains(w) for w in words])


def ends_with_any(name: Column, suffixes: list[str]) -> Column:
    return name.rlike("(?:" + "|".join(re.escape(s) for s in suffixes) + ")$")
