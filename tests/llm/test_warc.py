"""Archives written and read back, and the merge of capture runs, against plain versions."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallymark.llm import warc
from tallymark.session import scratch

SCHEMA = "page_id long, url string, html string, digest string, place int, run string, urlkey string, first int, payload string"


def at():
    return F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id") % 7)


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, "r", "k", 2, "p") for i, u, h in rows], SCHEMA).repartition(4)


def odd():
    long = "<p>same text</p>" * 20
    rows = [
        (None, None, None), (None, "http://a.example/x", long), (1, "http://a.example/", None), (2, "", ""), (3, "no url\r\nWARC/1.1", "x\r\n\r\nWARC/1.1\r\n\r\n" * 9),
        (4, "HTTPS://WWW.B.example:443/p?q=ü#frag", "é" * 49), (5, "//b.example", "é" * 50), (6, "http://b.example/p", "é" * 50),
        (7, "http://a.example/x", "a" * 99), (8, "http://a.example/x", "a" * 99), (9, "http://a.example/x", "b" * 100), (10, "http://a.example/x", "b" * 100),
        (11, "http://a.example/x", "\x00\x1f\x8b" + "z" * 300_000), (12, "http://c.example/😀", "😀"),
    ]
    rows += [(100 + i, f"http://s{i % 5}.example/{i % 3}", long) for i in range(60)]
    return rows + [(200, "http://dup.example/", "dup" * 50)] * 5 + [(201, "http://dup.example/", "dup" * 50)] * 2


def archived(spark, rows):
    folder = scratch(spark, "warc")
    warc.write_archives(table(spark, rows), at(), folder)
    return folder


def test_written_and_read_back(spark):
    rows = odd()
    found = warc.resolved(warc.histories(warc.read_runs(spark, archived(spark, rows)))).collect()
    least = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            least[h] = min(i, least.get(h, i))
    expected = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h)
        again = first is not None and i != first
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["response_page"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r["intact"] for r in found if r["record_type"] == "response")


def test_order_is_global(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 7)
    rows = odd() + [(1000 + i, "http://hot.example/", f"page {i}") for i in range(150)]
    found = warc.histories(warc.read_runs(spark, archived(spark, rows))).orderBy("section", "position").collect()
    keys = [(r["urlkey"].encode(), r["captured"], r["run"], r["place"]) for r in found]
    assert keys == sorted(keys) and len(set(keys)) == len(rows)
    sizes = {}
    for r in found:
        sizes[r["section"]] = sizes.get(r["section"], 0) + 1
    assert len(sizes) > 15 and max(sizes.values()) < 40  # the hot URL is cut too


def test_records_stand_where_the_index_says(spark):
    folder = archived(spark, odd())
    runs = warc.read_runs(spark, folder).collect()
    for r in runs:
        with open(r["run"].removeprefix("file:"), "rb") as archive:
            archive.seek(r["offset"])
            record = gzip.decompress(archive.read(r["length"]))
        assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: <{r['record_id']}>".encode() in record and record.endswith(b"\r\n\r\n")


def test_foreign_archives(spark, tmp_path):
    def record(kind, uri, block, date="2020-01-02T03:04:05Z", more=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {date}\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    plain = record("warcinfo", "", b"software: x") + record("response", "http://z.example/", b"body") + record("response", "http://a.example/", b"WARC/1.0\r\n\r\n")
    (tmp_path / "plain.warc").write_bytes(plain)
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(plain))
    (tmp_path / "gone.warc.gz").write_bytes(gzip.compress(record("revisit", "http://q.example/", b"", more="WARC-Refers-To: <urn:x>\r\nWARC-Payload-Digest: sha256:ab\r\n")))
    (tmp_path / "empty.warc").write_bytes(b"")
    found = warc.resolved(warc.histories(warc.read_runs(spark, f"file://{tmp_path}"))).orderBy("section", "position").collect()
    assert [(r["urlkey"], r["record_type"], r["payload_bytes"], r["response_page"]) for r in found if r["record_type"] == "response"] == [
        ("example,a)/", "response", 12, None), ("example,a)/", "response", 12, None), ("example,z)/", "response", 4, None), ("example,z)/", "response", 4, None),
    ]
    assert [(r["payload_digest"], r["payload_bytes"]) for r in found if r["record_type"] == "revisit"] == [("ab", None)]
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(plain)[:-20])
    with pytest.raises(Exception, match="cut off"):
        warc.read_runs(spark, f"file://{tmp_path}/cut.warc.gz").collect()


def test_loser_tree():
    rng = random.Random(4)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randint(0, 30), j, i) for i in range(rng.randint(0, 40))) for j in range(k)]
        assert list(warc.merged(runs)) == sorted(sum(runs, []))


def test_nothing(spark):
    assert warc.resolved(warc.histories(warc.read_runs(spark, archived(spark, [])))).count() == 0
