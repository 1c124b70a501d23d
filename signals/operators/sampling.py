"""Fixed-size samples for annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HUMAN_COLUMNS = [
    "language_human", "sentiment_human", "theme_human", "product_human", "is_spam_human",
    "annotation_notes",
]


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The n rows with the smallest keyed hash: exact size, same rows on every run.

    Each task keeps its own n best, so no global sort happens.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(digest, key).limit(n)


def annotation_sample(comments: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """Sampled comments with empty label columns to fill in."""
    columns = [
        "comment_id", "platform", "published_at", "author_handle", "comment_text", "like_count",
        "reply_to_id",
    ]
    picked = sample_exact(comments.select(*columns), n, "comment_id", seed)
    return picked.select("*", *[F.lit("").alias(c) for c in HUMAN_COLUMNS])
