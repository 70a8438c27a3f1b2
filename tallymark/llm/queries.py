"""The registered corpus queries: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import table
from ..session import scratch
from . import (
    bpe, divergence, embedding_dedup, language, licences, line_dedup, neighbours, packing, scoring, simhash, token_counts,
    warc, whitening,
)
from .texts import remainder, whole_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)


_LINES_SQL = """
WITH placed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), shared AS (
  SELECT key FROM placed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT p.*, s.key IS NOT NULL AS gone FROM placed p LEFT JOIN shared s ON p.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(_LINES_SQL)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, folder, "documents"), min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"),
        F.sha2(whole_text("text"), 256).alias("kept_sha256"),
    )


@query()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query()
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


@query()
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 3) == 1)
    filters = language.learn(docs.where("not held_out"))
    return language.predict(docs, filters, keep=("doc_id", "held_out"))


@query()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query()
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scoring.score(docs, remainder("doc_id", 10) != 0, public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query()
def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


@query(licences.sql())
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


_AUDIT_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), found AS (
  SELECT d, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), own AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)
), shares AS (
  SELECT d.lang, source, term, n,
         (1 + (1000000000 * (n + 1)::HUGEINT) // (sum(n) OVER (PARTITION BY d.lang, source) + v))::HUGEINT AS p,
         (1 + (1000000000 * (lang_n + 1)::HUGEINT) // (total + v))::HUGEINT AS q
  FROM dense d JOIN sizes z ON z.lang = d.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM valued QUALIFY part = 'pair' OR rank <= 200
"""


@query(_AUDIT_SQL)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"), min_docs=3, top=200)


_ARCHIVE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query(_ARCHIVE_SQL)
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch(spark, "archives")
    captured = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id"))  # the table has no times
    warc.write_archives(table(spark, folder, "pages"), captured, archives, least=100)
    found = warc.resolved(warc.histories(warc.read_runs(spark, archives)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("response_page").alias("refers_to"))


@query()
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"), most=4, scale=256)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
