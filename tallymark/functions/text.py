"""Ids, post types, hashtags and mentions, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..session import built_once
from .strings import text_has_any, text_or_blank, unless_blank


def urn_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, K.URN_PATTERN, 1), F.lit(""))


def short_md5(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def day_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(""))


def make_post_id(urn: Column, url: Column, content: Column, post_date: Column) -> Column:
    """From the urn, else the url, else the first 100 characters and the day."""
    described = F.concat(F.substring(F.coalesce(content, F.lit("")), 1, 100), F.lit("|"), day_text(post_date))
    return short_md5(F.coalesce(unless_blank(urn), unless_blank(url), described))


def unique_id(*parts: Column) -> Column:
    """From all parts that are not NULL, joined by ``|``."""
    return short_md5(F.concat_ws("|", *parts))


def with_post_type(df: DataFrame, raw: Column, *texts: Column, name: str = "post_type") -> DataFrame:
    """Adds one of text, article, image, document, video. The order of the tests is the meaning.

    ``texts`` are content, url and title; one that repeats another can be left
    out. Lower case is made in a projection of its own: Spark would otherwise
    make it again for every word.
    """
    word = F.lower(text_or_blank(raw))
    prepared = df.withColumns({
        "_kind": F.when(word.isin(K.DISTRIBUTION_WORDS), "").otherwise(word),
        "_text": F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in texts])),
    })
    return prepared.withColumn(name, _type_found()).drop("_kind", "_text")


@built_once
def _type_found() -> Column:
    kind, text = F.col("_kind"), F.col("_text")
    return (
        F.when(kind.contains("video") | text.contains("video"), "video")
        .when(text_has_any(kind, K.IMAGE_TYPE_WORDS) | text_has_any(text, K.IMAGE_TEXT_WORDS), "image")
        .when(text_has_any(kind, K.DOCUMENT_TYPE_WORDS) | text_has_any(text, K.DOCUMENT_TEXT_WORDS), "document")
        .when(text_has_any(kind, K.ARTICLE_TYPE_WORDS) | text.contains(K.ARTICLE_TEXT_WORD), "article")
        .when(text_has_any(kind, K.TEXT_TYPE_WORDS), "text")
        .when(text.contains("http"), "article")
        .otherwise("text")
    )


def _tagged(text: Column, sign: str, pattern: str) -> Column:
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1)))
    return F.transform(F.slice(found, 1, K.MAX_TAGS), lambda t: F.concat(F.lit(sign), t))


def hashtags(text: Column) -> Column:
    """Distinct ``#tags`` in order of first use; ``&#39;`` and the like do not count."""
    return _tagged(text, "#", K.HASHTAG_PATTERN)


def mentions(text: Column) -> Column:
    return _tagged(text, "@", K.MENTION_PATTERN)
