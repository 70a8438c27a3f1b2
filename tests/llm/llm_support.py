"""Odd documents and plain versions for the tests of the corpus operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos int, hash long, n int, score string, lang_pred string, n_lines string, v string, word string, task int"


def odd_documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves, over several partitions."""
    full = [(i, t, "en", "s", 0, "k", 1, 2, 3, "x", "y", "z", "v", "w", 4) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def odd_rows(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    words = "the of and thhaher été ñandú 梦 x1 don't The OF can't ### 12 ﬁn".split()
    rows = [
        (None, "a b c"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "x" * 5000), (5, "one two three four\nTWO\n  two  \n"),
        (6, "same text here\nwith lines"), (6, "same text here\nwith lines"), (7, "same text here\nwith lines"), (8, "12 34 !!"),
        (9, "the of and " * 4000), (10, "a\r\nb\x0bc  d e f \x1c g"), (11, "<|endoftext|> <s> </s> ▁x ▁▁y \x00z"),
    ]
    for i in range(12, 60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\n\n", ", "]) for _ in range(rng.randint(0, 80)))
        rows.append((i, text + ("\nshared line" if i % 2 else "\nSHARED line ")))
    return rows


def groups(ids, links):
    """Smallest id reachable from each id over ``links``."""
    least = {i: i for i in ids}
    while True:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
        if not changed:
            return least
