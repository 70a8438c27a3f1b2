"""WARC archives of captured pages, and their captures in one global order.

Each task sorts its captures by URL key and time and writes them as one archive, a gzip
member per record; a payload that was captured before becomes a revisit record without
the bytes. Reading an archive gives its captures as a sorted run with the place of every
record. The runs are then merged externally: evenly drawn captures set the bounds of
ranges, each run is cut at them, and a range merges the pieces of all runs by a loser
tree. Ranges follow each other, so the whole is in order. A capture's key ends with its
archive and place, so a URL, or a capture repeated, that a third of all rows share is cut
like any other.

Archives go through Spark's own text writer, which reaches any store and commits only
whole files: a row is a gzip member, and the line separator is the empty member, which
readers of gzip pass over.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written

LEVEL = 4
RANGE = 10_000  # captures of a range, about
RANGES = 40_000  # most ranges; beyond it they grow
DRAWN = 10  # captures drawn per range to set the bounds
CHUNK = 1 << 16


def member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, wbits=31)
    return squeeze.compress(record) + squeeze.flush()


EMPTY = member(b"").decode("latin-1")

_CAPTURE = (
    "run string, place long, offset long, length long, page_id long, url string, date string, record_id string, "
    "record_type string, refers_to string, payload_bytes long, payload_digest string, intact boolean"
)
_ORDER = ["urlkey", "captured", "run", "place"]


def url_key(url: str | Column) -> Column:
    """Host labels from the right, then the path: captures of a site lie together. Empty for a null URL."""
    url = F.trim(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")))
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^#]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"^www\.|:(80|443)?$", "")
    path = F.regexp_extract(url, parts, 2)
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host == "", url).otherwise(F.concat(turned, F.lit(")"), F.when(path == "", "/").otherwise(path)))


def _record_id(page_id: str) -> Column:
    return F.concat(F.lit("urn:sha256:"), F.sha2(F.concat_ws("/", F.coalesce(F.col(page_id).cast("string"), F.lit("none")), "digest"), 256))


def captures(pages: DataFrame, captured: Column, least: int) -> DataFrame:
    """Pages as records: the first page of each payload of ``least`` bytes or more has it, the others refer to it."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(captured, F.timestamp_seconds(F.lit(0))).alias("captured"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = (
        own.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
        .withColumn("again", F.lit(True))
    )
    again = F.coalesce(F.col("again") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return own.join(firsts, "digest", "left").select(
        "page_id", "url", "captured", "digest", F.octet_length("payload").alias("bytes"),
        _record_id("page_id").alias("record_id"), F.when(again, _record_id("first")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"), url_key("url").alias("urlkey"),
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def head(*lines: str) -> bytes:
        return "\r\n".join(lines).encode() + b"\r\n\r\n"

    for batch in batches:
        out = []
        for page_id, url, date, digest, size, record_id, refers_to, payload in zip(*(c.to_pylist() for c in batch.columns)):
            block = head("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}") + (payload or b"")
            lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
            if url is not None:
                lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
            if page_id is not None:
                lines.append(f"Page-Id: {page_id}")
            if refers_to:
                lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
            lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
            out.append(member(head(*lines) + block + b"\r\n\r\n"))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(pages: DataFrame, captured: Column, folder: str, least: int = 100) -> None:
    """A record per row of ``pages`` (``page_id, url, html``) into archives below ``folder``.

    A null ``html`` is an empty payload, a null URL leaves the record without one, a null time is the
    first second of 1970. Of equal payloads of ``least`` bytes or more the smallest ``page_id`` has the
    response, those with another id or none revisit it. Rows that repeat that id and payload are all
    responses under one record id, and so are equal payloads that have no id at all. Other columns are
    not read, whatever their names.
    """
    date = F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    run = captures(pages, captured, least).sortWithinPartitions("urlkey", "captured", "page_id")
    records = run.select("page_id", "url", date.alias("date"), "digest", "bytes", "record_id", "refers_to", "payload").mapInArrow(_members, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY).text(folder)


def _members_of(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and contents of each gzip member; an archive that is not compressed is one."""
    if not data.startswith(b"\x1f\x8b"):
        yield 0, len(data), data
        return
    at = 0
    while at < len(data):
        start, opened, parts = at, zlib.decompressobj(31), []
        while not opened.eof:
            piece = data[at:at + CHUNK]
            if not piece:
                raise ValueError(f"the gzip member at {start} is cut off")
            parts.append(opened.decompress(piece))
            at += len(piece)
        at -= len(opened.unused_data)
        yield start, at - start, b"".join(parts)


def _records_of(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and block of each record."""
    for offset, size, contents in _members_of(data):
        at, packed = 0, data is not contents
        while at < len(contents):
            stop = contents.find(b"\r\n\r\n", at)
            if not contents.startswith(b"WARC/", at) or stop < 0:
                raise ValueError(f"no record at {offset if packed else at}")
            lines = contents[at:stop].decode().split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            end = stop + 4 + int(fields["content-length"])
            if len(contents) < end:
                raise ValueError(f"the record at {offset if packed else at} is cut off")
            yield (offset, size, fields, contents[stop + 4:end]) if packed else (at, end + 4 - at, fields, contents[stop + 4:end])
            at = end + 4


def _captured_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        (name, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind])
        for name, kind in (column.split() for column in _CAPTURE.split(", "))
    ])
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), (x.as_buffer() for x in batch.column(1))):
            rows = []
            for place, (offset, length, fields, block) in enumerate(_records_of(data.to_pybytes())):
                kind = fields.get("warc-type")
                if kind not in ("response", "revisit"):
                    continue
                http = fields.get("content-type", "").startswith("application/http")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
                said = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                digest = hashlib.sha256(payload).hexdigest()
                whole = kind == "response"
                rows.append((
                    path, place, offset, length, int(fields["page-id"]) if "page-id" in fields else None, fields.get("warc-target-uri"),
                    fields.get("warc-date"), fields.get("warc-record-id", "").strip("<>"), kind,
                    fields.get("warc-refers-to", "").strip("<>") or None, len(payload) if whole else None, digest if whole else said,
                    digest == said if whole and said else None,
                ))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(schema), schema.types)], schema=schema)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives below ``folder``, those of an archive in order, with the place of each record.

    An archive (gzip member by member, or not compressed) is held by one task. Records that are
    neither responses nor revisits are passed over; a damaged archive is an error that names the
    place. ``intact`` tells whether a response's payload has the digest its header says.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    found = files.mapInArrow(_captured_in, _CAPTURE)
    named = found.withColumn("urlkey", url_key("url")).withColumn("captured", F.coalesce(F.expr("try_cast(date AS timestamp)"), F.timestamp_seconds(F.lit(0))))
    return named.drop("date").sortWithinPartitions("run", "urlkey", "captured", "place")


def merged(runs: list[list[tuple]]) -> Iterator[tuple]:
    """All entries of sorted runs in order, by a loser tree: an inner node holds the loser of its match, so the
    next winner takes one comparison per level."""
    end = (True,)
    runs = [run for run in runs if run]
    if not runs:
        return
    k = len(runs)
    at, front, losers = [0] * k, [(False, run[0]) for run in runs], [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if front[a] <= front[b] else (b, a)
    best = winners[1] if k > 1 else 0
    while front[best] != end:
        yield front[best][1]
        at[best] += 1
        front[best] = (False, runs[best][at[best]]) if at[best] < len(runs[best]) else end
        node = (k + best) // 2
        while node:
            if front[losers[node]] < front[best]:
                losers[node], best = best, losers[node]
            node //= 2


def _keys(entries: pa.StructArray | pa.RecordBatch) -> list[tuple]:
    """Comparable keys: URL key as its bytes, time as a number, archive, place."""
    def column(name: str) -> pa.Array:
        return entries.field(name) if isinstance(entries, pa.StructArray) else entries.column(name)

    return list(zip(
        column("urlkey").cast(pa.binary()).to_pylist(), column("captured").cast(pa.int64()).to_pylist(),
        column("run").to_pylist(), column("place").to_pylist(),
    ))


def histories(runs: DataFrame) -> DataFrame:
    """The captures of all runs in one order: ``section`` and ``position`` in it come before their columns.

    Sections follow each other, and positions within one, by URL key, time, archive and place. ``runs``
    holds the columns of ``read_runs``, each run in order.
    """
    spark = runs.sparkSession
    runs = written(runs, "capture-runs")
    total = runs.count()
    ranges = min(RANGES, -(-total // RANGE))
    gap = max(1, total // max(1, ranges * DRAWN))
    drawn = runs.where(F.pmod(F.col("place") + F.xxhash64("run"), F.lit(gap)) == 0).select(*_ORDER) if ranges > 1 else runs.limit(0).select(*_ORDER)
    keys = sorted(key for batch in drawn.toArrow().to_batches() for key in _keys(batch))  # DRAWN per range, about
    bounds = [keys[len(keys) * i // ranges] for i in range(1, ranges) if keys]
    shared = spark.sparkContext.broadcast(bounds)  # at most RANGES keys
    columns = runs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _keys(batch)
            to = np.array([bisect_right(shared.value, key) for key in keys], np.int32)
            names = batch.column("run").dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (to[1:] != to[:-1]) | (names[1:] != names[:-1]))))
            piece = pa.ListArray.from_arrays(np.append(starts, len(to)).astype(np.int32), pa.StructArray.from_arrays(batch.columns, batch.schema.names))
            yield pa.RecordBatch.from_arrays([pa.array(to[starts]), piece], ["section", "piece"])

    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in runs.schema)
    flat = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)

    def merge(section: pa.Table) -> pa.Table:
        pieces = section["piece"].combine_chunks()
        entries = pieces.flatten()
        keys, offsets = _keys(entries), pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        by_run: dict[str, list[list[tuple]]] = {}
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if a < b:
                by_run.setdefault(keys[a][2], []).append([(*keys[i], i) for i in range(a, b)])
        # The pieces of a run follow each other.
        order = [entry[-1] for entry in merged([sum(sorted(found), []) for found in by_run.values()])]
        held = entries.take(pa.array(order, pa.int64()))
        n = len(order)
        return pa.table({
            "section": pa.array(np.full(n, section["section"][0].as_py(), np.int32)), "position": pa.array(np.arange(n, dtype=np.int64)),
            **{name: held.field(name) for name in columns},
        })

    pieces = runs.mapInArrow(cut, f"section int, piece array<struct<{fields}>>")
    return pieces.groupBy("section").applyInArrow(merge, f"section int, position long, {flat}")


def resolved(found: DataFrame) -> DataFrame:
    """Captures with what revisits refer to: the page of the response, its payload's length and digest as read.

    A revisit whose response is not there keeps the digest of its header and has no length.
    """
    found = written(found, "captures")
    responses = (
        found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.min("page_id").alias("response_page"), F.min("payload_bytes").alias("b"), F.min("payload_digest").alias("d"))
    )
    revisits = found.where("record_type = 'revisit'").join(responses, "refers_to", "left").withColumns({
        "payload_bytes": F.col("b"), "payload_digest": F.coalesce("d", "payload_digest"),
    }).drop("b", "d")
    return found.where("record_type = 'response'").withColumn("response_page", F.lit(None).cast("long")).unionByName(revisits)
