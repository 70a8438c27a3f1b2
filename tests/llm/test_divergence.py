"""The audit of sources against a plain version."""

import re
from collections import Counter, defaultdict

from llm_support import SCHEMA
from tallymark.llm import divergence

FIND = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_audit(rows, min_docs, top):
    """All terms of all groups, one by one."""
    docs = [(lang or "", source or "", FIND.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, words in mine for t in set(words))
        kept = [t for t, n in seen.items() if n >= min_docs]
        counts = defaultdict(Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if seen[w] >= min_docs)
        whole = sum(counts.values(), Counter())

        def shares(n):
            return {t: 1 + 10**9 * (n[t] + 1) // (sum(n.values()) + len(kept)) for t in kept}

        p, q = {s: shares(n) for s, n in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, i): (v, k) for k, (v, i) in enumerate(order, 1)}
    return out


def check(spark, rows, min_docs=3, top=200):
    full = [(i, text, lang, source, 0, "k", 1, 2, 3, "x", "y", "z", "v", "w", 4) for i, (text, lang, source) in enumerate(rows)]
    docs = spark.createDataFrame(full, SCHEMA).repartition(5)
    found = divergence.audit(docs, min_docs, top).collect()
    got = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in found}
    assert len(got) == len(found) and got == plain_audit(rows, min_docs, top)
    return got


def odd():
    rows = [
        (None, None, None), ("", "en", ""), ("The the THE été x-ray x1y", "en", "a"), ("the \U0001f600 x ray \x00y", "en", "a"),
        ("the été ray", "en", None), ("nothing shared here", "de", "a"), ("other words", "de", "b"), ("same", "fr", "only"),
        ("same", "fr", "only"), ("same", "fr", "only"), ("123 !! \x7f", "en", "digits"),
    ]
    words = "alpha beta Gamma delta été ñandú 梦 zeta eta theta".split()
    for i in range(60):
        rows.append((" ".join(words[(i * k + k * k) % len(words)] for k in range(1, 3 + i % 17)), "en", f"s{i % 4}"))
    return rows + [rows[-1]] * 7 + [("hot " * 3000 + "alpha", "en", "s1")]


def test_against_a_plain_version(spark):
    got = check(spark, odd())
    assert got["de", "a", "pair", "b"] == (0, 1)  # a language that keeps no term
    assert ("fr", "only", "term", "same") not in got  # one source alone is its language


def test_cells_open_only_as_far_as_the_ranks_go(spark):
    rows = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)), "en", "a")] * 3 + [("other", "en", "b")] * 3
    got = check(spark, rows, top=7)
    assert sorted(r for (_, s, part, _), (_, r) in got.items() if part == "term" and s == "a") == list(range(1, 8))


def test_counts_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    check(spark, odd(), min_docs=1, top=5)


def test_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_of_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, kept = 10**15, 10**16, 10**9
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + kept)
