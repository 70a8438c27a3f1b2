"""Page numbers out of digest mails, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from .numbers import digits_with_commas, or_zero
from .strings import strip, unless_blank

_SPACES = r"[\s\p{Z}\x1c-\x1f\x85]+"


def plain_text(html: Column) -> Column:
    untagged = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")
    return strip(F.regexp_replace(untagged, _SPACES, " "))


def first_match(text: Column, patterns: list[str]) -> Column:
    """What the first matching pattern caught, or NULL."""
    return F.coalesce(*[unless_blank(F.regexp_extract(text, p, 1)) for p in patterns])


def with_digest_numbers(messages: DataFrame) -> DataFrame:
    """Adds the page numbers found in ``body``; those a digest does not hold are 0.

    In steps, so that the text is cleaned once and each pattern runs once. A
    match that is no number counts as 0; later patterns are not tried then.
    """
    nothing = F.lit(0).cast("bigint")
    return (
        messages.withColumn("digest_text", plain_text(F.col("body")))
        .withColumns({
            "followers_count": first_match(F.col("digest_text"), K.DIGEST_FOLLOWER_PATTERNS),
            "impressions": first_match(F.col("digest_text"), K.DIGEST_IMPRESSION_PATTERNS),
        })
        .drop("digest_text")
        .withColumns({n: or_zero(digits_with_commas(F.col(n))) for n in ("followers_count", "impressions")})
        .withColumns({
            "unique_impressions": F.col("impressions"),
            "clicks": nothing,
            "engagement_rate": F.lit(0.0),
            "reach": F.col("impressions"),
            "total_posts": nothing,
            "avg_post_engagement": F.lit(0.0),
        })
    )
