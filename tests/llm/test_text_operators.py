"""Corpus operators on texts against plain versions, odd inputs included."""

import hashlib
import math
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from llm_support import SCHEMA, groups, odd_documents, odd_rows
from tallymark.llm import bpe, components, language, lattice, licences, line_dedup, packing, scoring, simhash, token_counts, transducer
from tallymark.llm.texts import remainder

ROWS = odd_rows()
RANKS, PIECES, WORDS = (public_tokenizers.path(p) for p in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- line dedup


def plain_lines(rows, least):
    blank = " \t\n\x0b\x0c\r"
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    keys = [[x.strip(blank).translate(fold) for x in (t or "").split("\n")] for _, t in rows]
    n = Counter(k for ks in keys for k in set(ks) if k)
    out = Counter()
    for (i, t), ks in zip(rows, keys):
        kept = [x for x, k in zip((t or "").split("\n"), ks) if not (k and n[k] >= least)]
        out[i, "\n".join(kept), len(ks), len(ks) - len(kept)] += 1
    return out


@pytest.mark.parametrize("least", [2, 10])
def test_lines(docs, least):
    assert bag(line_dedup.drop_shared_lines(docs, least), "doc_id", "text", "n_lines", "n_dropped") == plain_lines(ROWS, least)


def test_lines_keep_other_columns(docs, none):
    kept = line_dedup.drop_shared_lines(docs)
    assert kept.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert kept.select("key", "pos", "hash").distinct().collect() == [("k", 1, 2)]
    assert line_dedup.drop_shared_lines(none).count() == 0


# ---- SimHash


def plain_print(text, words=3):
    parts = (text or "").encode().lower().split()
    rows = [b" ".join(parts)] if len(parts) < words else [b" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in rows] if parts else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_fingerprints(docs):
    found = bag(simhash.fingerprints(docs), "doc_id", "fp")
    assert found == Counter((i, struct.unpack("<q", struct.pack("<Q", plain_print(t)))[0]) for i, t in ROWS)


def test_native_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] == struct.unpack(
        "<q", struct.pack("<Q", xxhash.xxh64_intdigest("one two three", 42)))[0]


@pytest.mark.parametrize("wide", [2, 64])
def test_links_within_two_bits(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE", wide)
    rng = np.random.default_rng(3)
    prints = set()
    for start in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(25):
            prints.add(start)
            for bit in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                start ^= 1 << bit
    prints |= {0, (1 << 64) - 1, 1 << 63}
    held = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    near = [(a, b) for a in held for b in held if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    expected = groups(held, near)
    found = components.components(simhash.links(spark.createDataFrame([(p,) for p in held], "fp long"))).collect()
    linked = {x for pair in near for x in pair}
    assert {r["id"]: r["component"] for r in found} == {p: expected[p] for p in linked}


def test_near_duplicates(docs, none):
    found = simhash.near_duplicates(docs).where("doc_id is not null").collect()
    ids = sorted({i for i, _ in ROWS if i is not None})
    prints = [(i, plain_print(t)) for i, t in ROWS if i is not None]
    near = [(a, b) for a, x in prints for b, y in prints if (x ^ y).bit_count() <= 2]
    expected = groups(ids, near)
    assert {(r["doc_id"], r["component_id"]) for r in found} == set(expected.items())
    assert len(found) == sum(i is not None for i, _ in ROWS)
    kept = Counter(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert kept == Counter([i for i in ids if expected[i] == i] + [None] * 2)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(10, 60)] + [(60, 59), (5, 5), (None, 3)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {i: 100 for i in range(100, 161)} | {x: 7 for x in [7, *range(10, 61)]}
    assert len(found) == len({r["id"] for r in found})


# ---- packing


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(docs, capacity):
    library = Tokenizer.from_file(WORDS)
    pieces = Counter()
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            pieces[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = packing.pack(docs, WORDS, 1, capacity).collect()
    assert Counter(tuple(r)[:5] for r in rows) == pieces
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // capacity) * 1.25 + 1


def test_packing_of_nothing(none):
    assert packing.pack(none, WORDS).count() == 0


def test_large_pieces_pair_as_well_as_can_be():
    assert packing.plan({60: 2, 40: 2, 50: 3, 34: 1}, 100)[1] == 4  # 60+40 twice, 50+50, 50+34
    assert packing.plan({34: 3}, 100)[1] == 2  # three of more than a third never meet
    assert packing.plan({33: 6, 1: 2}, 100)[1] == 2
    assert packing.plan({}, 100) == ([], 0)


# ---- byte-level BPE


def test_byte_pairs(docs, none):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.byte_pairs(RANKS).ranks, special_tokens={})
    expected = Counter()
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected[i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert bag(bpe.digests(docs, RANKS), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
    encoded = bpe.encode(docs, RANKS)
    assert bag(bpe.decode(encoded, RANKS), "doc_id", "bytes") == Counter((i, (t or "").encode()) for i, t in ROWS)
    assert all(r["offsets"][-1] == r["size"] for r in encoded.join(
        docs.select("doc_id", F.octet_length("text").alias("size")).dropna().distinct(), "doc_id").collect())
    assert bpe.digests(none, RANKS).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_scan_finds_the_same_cuts_in_any_chunks(monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    texts = [t or "" for _, t in ROWS] + ["'s 's's I'll'll !'s\n's 1's", "   a", "a   ", "\n\n\n", "''''s"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.byte_pairs(RANKS).ranks, special_tokens={})
    found = [np.frombuffer(x, "<u4").tolist() for x in bpe.byte_pairs(RANKS).encode(texts)]
    assert found == [library.encode_ordinary(t) for t in texts]


# ---- token counts


def test_token_counts(docs, none):
    library = SentencePieceProcessor(model_file=PIECES)
    expected = Counter()
    for i, t in ROWS:
        n = len(library.encode(t or ""))
        expected[i, len((t or "").encode()), n, n > 500] += 1
    found = token_counts.token_counts(docs, PIECES, 500)
    assert bag(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_counts.token_counts(none, PIECES).count() == 0


@pytest.mark.parametrize("chunk", [1, 5, 512])
def test_counts_do_not_depend_on_chunks_or_table_size(monkeypatch, chunk):
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    monkeypatch.setattr(transducer, "STATES", 50)
    monkeypatch.setattr(transducer, "GROUP", 3000)
    texts = [t or "" for _, t in ROWS] + [" " * 15 + "x" + " " * 33 + "y", "梦" * 30, "   梦", "ab" * 700, "😀\n é "]
    library = SentencePieceProcessor(model_file=PIECES)
    assert list(transducer.Transducer(PIECES).counts(texts)) == [len(x) for x in library.encode(texts)]


# ---- language


def test_language(spark, none):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filters = language.learn(table.where(remainder("doc_id", 3) != 1))
    held = language.predict(table.where(remainder("doc_id", 3) == 1), filters, keep=("lang",)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)
    odd = odd_documents(spark, ROWS)
    found = {(r["doc_id"], r["lang_pred"]) for r in language.predict(odd, filters, keep=("doc_id", "score", "key")).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (8, "und")} <= found
    assert all(lang in {*filters.languages, "und"} for _, lang in found)
    kept = language.drop_rejected(odd, filters)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2, 3, 8)").count() == 0
    assert kept.where("lang_pred = 'y' and score = 'x'").count() == kept.count() > 0
    nothing = language.learn(none)
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(none, filters).count() == 0


def test_filter_masks_name_every_language_of_a_gram(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("abab abab", "aa"), ("abab xyxy", "bb"), ("xyxy xyxy", "cc")] * 3)]
    filters = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    hits = {t: [filters.corrected(g).round(3) for g in language.grams_of(t)] for t in ("abab", "xyxy")}
    assert all(h[0] > 0 and h[1] > 0 and h[2] < 0.01 for h in hits["abab"])
    assert all(h[0] < 0.01 and h[1] > 0 and h[2] > 0 for h in hits["xyxy"])


# ---- scoring


def plain_word(word, pieces, p):
    text = "▁" + word
    ways = [1.0]
    for j in range(1, len(text) + 1):
        total = sum(ways[i] * p[pieces[text[i:j]]] for i in range(j) if text[i:j] in pieces and not (i and text[i] == "▁"))
        c = text[j - 1]
        if c not in pieces or (c == "▁" and j > 1):
            total += ways[j - 1] * math.prod(p[len(pieces) + b] for b in c.encode())
        ways.append(total)
    return ways[-1]


def test_lattice_sums_all_segmentations():
    held = lattice.vocabulary(PIECES)
    p = held.by_rank()
    assert abs(p.sum() - 1) < 1e-9
    numbers = {piece: i for i, piece in enumerate(held.pieces)}
    words = ["the", "of", "thhaher", "a", "梦😀x", "été", "a▁b", "▁", "ﬁx\x01", "onwhtien,", "x" * 30, "x" * 30]
    spelled = lattice.Lattice(held, p)
    found = spelled.forward(words)
    assert found == pytest.approx([math.log(plain_word(w, numbers, p)) for w in words])
    long = "xy" * 300  # beyond LONG: worked on alone
    codes = np.array([[ord(c) for c in "▁" + long]], np.uint64)
    assert spelled.forward([long])[0] == pytest.approx(spelled._sweep(spelled._arcs(codes), 1)[-1, 0])
    # An expected count is how the log probability grows with a piece's own.
    number, step = numbers["th"], 1e-6
    up = p.copy()
    up[number] *= 1 + step
    gain = (lattice.Lattice(held, up).forward(words) - found).sum() / step
    assert spelled.expected(words)[number] == pytest.approx(gain, rel=1e-3)


def test_scores(docs, none, monkeypatch):
    train = [(t or "").encode().lower().split() + [b""] for i, t in ROWS if zlib.crc32(str(i).encode()) % 10 and i is not None]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)
    expected = Counter()
    for i, t in ROWS:
        words = (t or "").encode().lower().split() + [b""]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        held_out = i is None or zlib.crc32(str(i).encode()) % 10 == 0
        expected[i, held_out, len(words), sum(c[w] > 0 for w in words), n, round(base, 4)] += 1
    for hot in (scoring.HOT, 3):  # nearly all words settled in place, and nearly none
        monkeypatch.setattr(scoring, "HOT", hot)
        rows = scoring.score(docs, remainder("doc_id", 10) != 0, PIECES).collect()
        found = Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in rows)
        assert found == expected
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
        sums = sum(r["score"] for r in rows)
    assert sums == pytest.approx(sum(r["score"] for r in rows))
    assert scoring.score(none, F.lit(True), PIECES).count() == 0
    assert all(math.isfinite(r["score"]) for r in scoring.score(docs, F.lit(False), PIECES).collect())


def test_tokens_of_parts(monkeypatch):
    texts = [None, "", " \t", "A b\x0bA\x1cÄ\x85 \u2003c ", "x" * 50, " Ab  a\r\nb"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for size in (scoring.PART, 3):
        monkeypatch.setattr(scoring, "PART", size)
        found = [(part["text"][r].as_py(), distinct[w].as_py()) for part, rows, words, distinct in scoring._tokens(batch) for r, w in zip(rows.tolist(), words.tolist())]
        assert found == [(t, w.decode()) for t in texts for w in (t or "").encode().lower().split()]
        assert sum(part.num_rows for part, *_ in scoring._tokens(batch)) == len(texts)


def test_as_many_words_are_settled_in_place_as_the_bound_allows(spark, monkeypatch):
    rows = [(i, "often " * 500 + f"seldom{i % 20} once{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(scoring, "HOT", 30)  # a thirtieth of all tokens is one word; 22 words occur twice or more
    with monkeypatch.context() as watched:
        watched.setattr(type(spark.sparkContext), "broadcast", lambda _, value: kept.append(value) or broadcast(value))
        found = {r["doc_id"]: r["score"] for r in scoring.score(docs, F.lit(True), PIECES).collect()}
    assert set(kept[-1][0].to_pylist()) == {"often", "", *(f"seldom{i}" for i in range(20))}
    monkeypatch.setattr(scoring, "HOT", 1)
    for r in scoring.score(docs, F.lit(True), PIECES).collect():
        assert r["score"] == pytest.approx(found[r["doc_id"]])


def test_word_probabilities_add_up_to_at_most_one(spark):
    rows = [(i, w) for i, w in enumerate(["a b a", "b c", "a d e", "f"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    probes = [(100 + i, w) for i, w in enumerate([*"abcdefghijklmnopqrstuvwxyz", ""])]
    both = docs.union(spark.createDataFrame(probes, docs.schema))
    found = {r["doc_id"]: r["score"] for r in scoring.score(both, F.col("doc_id") < 100, PIECES).collect()}
    end = found[126]
    assert sum(10 ** (found[100 + i] - end) for i in range(26)) + 10 ** end < 1


# ---- licences


def test_licences_in_any_spelling(spark, none):
    mit = licences.TEXTS["MIT"]
    rows = [
        (1, "The MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit), (2, "Copyright 2020-2024 Them\n" + mit.upper().replace(",", ";")),
        (3, mit.replace("sublicense", "sub-licence").replace("\n", "  \n  ")), (4, mit + "\nMore."), (5, None), (6, ""),
        (7, "x\nThis work is licenced under  CC-BY-NC 4.0!\ny"), (8, "Licensed under love"), (8, "MIT"), (None, "Released under MIT."),
    ]
    found = bag(licences.scan(odd_documents(spark, rows)), "doc_id", "scope", "licence")
    whole = {k[0] for k in found if k[1] == "document"}
    assert whole == {2, 3, None} and found[1, "line", "MIT"] == 1
    assert found[7, "line", "CC-BY-NC-4.0"] == 1 and not any(k[0] in (4, 5, 6, 8) for k in found)
    assert licences.scan(none).count() == 0


def test_full_texts_inside_documents(spark):
    mit, isc, bsd = (licences.TEXTS[x] for x in ("MIT", "ISC", "BSD-2-Clause"))
    commented = "\n".join(f" * {x}" for x in ["MIT License", "Copyright Some One and others", *mit.split("\n")])
    rows = [
        (1, "The MIT License (MIT)\n\nCopyright (c) 2020 Some One\n\n" + mit), (2, f"/*\n{commented}\n */\n\nint main() {{}}\n"),
        (3, f"Notices\n\n{bsd}\n\nand\n\n{mit}\n\n{mit}\n\nThe end."), (4, "ISC License\nCopyright Joyent, Inc.\n" + isc.replace("\n\n", "\n")),
        (5, "x\n\n" + mit.rsplit("\n\n", 1)[0]), (6, mit.replace("free of charge", "for a fee") + "\n\ny"), (7, mit.split("\n\n")[0]),
        (8, "x\n\n" + mit + "\nMore."),
    ]
    found = bag(licences.scan(odd_documents(spark, rows)).where("scope = 'passage'"), "doc_id", "nth", "licence")
    assert found == Counter({
        (1, 0, "MIT"): 1, (2, 0, "MIT"): 1, (3, 1, "BSD-2-Clause"): 1, (3, 6, "MIT"): 1, (3, 9, "MIT"): 1, (4, 0, "ISC"): 1,
    })


def test_known_side_covers_texts_headers_names_and_identifiers(spark):
    """Hits in all four scopes, also by the SQL."""
    import duckdb

    apache, gpl = dict(licences.known_texts())["Apache-2.0"], (licences.Path(licences.__file__).parent / "licence_texts/GPL-3.0.txt").read_text()
    full = (licences.Path(licences.__file__).parent / "licence_texts/Apache-2.0.txt").read_text()
    rows = [
        (1, full), (2, gpl), (3, "/*\n" + "\n".join(f" * {x}" for x in licences.HEADERS["Apache-2.0"].split("\n")) + "\n */\nint x;"), (4, "MIT License"),
        (5, "x\nThis code is licensed under the MIT License.\ny"), (6, "# SPDX-License-Identifier: GPL-3.0-or-later\nimport x"), (7, "Notices\n\n" + full + "\n\nEnd."),
        (8, "SPDX-License-Identifier: GPL-2.0+"), (9, None), (10, "Copyright Some One\n\n" + licences.HEADERS["MPL-2.0"]), (11, licences.TEXTS["MIT"] + "\n\nmore"),
    ]
    assert apache
    found = bag(licences.scan(odd_documents(spark, rows)), "doc_id", "scope", "nth", "licence")
    told = {(k[0], k[3]) for k in found}
    assert {(1, "Apache-2.0"), (2, "GPL-3.0"), (3, "Apache-2.0"), (4, "MIT"), (5, "MIT"), (6, "GPL-3.0"), (7, "Apache-2.0"), (8, "GPL-2.0"), (10, "MPL-2.0"), (11, "MIT")} <= told
    assert {k[1] for k in found} == {"document", "paragraph", "line", "passage"}
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert Counter(duck.execute(licences.sql()).fetchall()) == found
