"""Recent-comment lists, filters, previews and display projections.

Every list is ``orderBy(...).limit(k)``: a top-k that keeps k rows per task, never a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palaver import values
from palaver.functions.scalars import fixed


def preview(text: str, length: int = 100) -> Column:
    return F.substring(text, 1, length)


def newest_first(ts: str = "ingestion_time", key: str = "comment_id") -> list[Column]:
    """Missing times lead, as in the source system; ties by key."""
    return [F.col(ts).desc_nulls_first(), F.col(key).asc()]


def choose(df: DataFrame, sentiments=None, toxic_only: bool = False) -> DataFrame:
    """Optional filters; an absent one keeps all rows."""
    if sentiments:
        df = df.filter(F.col("sentiment").isin(list(sentiments)))
    if toxic_only:
        df = df.filter(F.col("is_toxic"))
    return df


def newest_with_text(narrow: DataFrame, texts: DataFrame, limit: int, sentiments=None, toxic_only: bool = False,
                     key: str = "comment_id") -> DataFrame:
    """The newest rows of a frame without text, with their texts fetched afterwards.

    Where the texts lie in another table than the scores, choosing first means that no text but
    those of the list goes through a join. The broadcast side has ``limit`` rows.
    """
    top = choose(narrow, sentiments, toxic_only).orderBy(*newest_first(key=key)).limit(limit)
    return texts.join(F.broadcast(top), key)


def recent_comments(df: DataFrame, limit: int = 100) -> DataFrame:
    return df.orderBy(*newest_first()).limit(limit).select(
        "comment_id", "post_id", "username", preview("comment").alias("comment_preview"), "label",
        fixed("toxicity_score", 4).alias("toxicity_score"), "sentiment",
        fixed("sentiment_score", 4).alias("sentiment_score"), "created_time", "ingestion_time",
    )


def recent_filtered(df: DataFrame, limit: int = 50, sentiments=None, toxic_only: bool = False) -> DataFrame:
    return choose(df, sentiments, toxic_only).orderBy(*newest_first()).limit(limit).select(
        "comment_id", "username", "comment", "label",
        fixed("toxicity_score", 3).alias("toxicity_score"), "sentiment",
        fixed("sentiment_score", 3).alias("sentiment_score"), "is_toxic", "created_time", "ingestion_time",
    )


def recent_toxic(df: DataFrame, limit: int = 100) -> DataFrame:
    return choose(df, toxic_only=True).orderBy(*newest_first()).limit(limit).select(
        "comment_id", "username", "comment", "toxicity_score", "sentiment", "ingestion_time",
    )


def row_range(df: DataFrame, order: str, start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (exclusive) of an explicit order."""
    return df.orderBy(order).limit(stop).offset(start)


def display(df: DataFrame, names=values.DISPLAY_NAMES) -> DataFrame:
    """Those of the wanted columns that exist, under their display names."""
    wanted = [c for c in names if c in df.columns]
    return df.select(*[F.col(c).alias(names[c]) for c in wanted])
