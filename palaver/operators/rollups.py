"""Statistics over the result table.

All aggregates are sums, counts, averages and extremes: they are combined within each task before
the shuffle, so hot days, users or labels need no special care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.scalars import day_of, days, fixed, hour_of, hours, minutes, percentage, tally, week_of, within

BUCKETS = ("0-20%", "20-40%", "40-60%", "60-80%", "80-100%")


def _is(sentiment: str) -> Column:
    return F.col("sentiment") == sentiment


def _counts() -> dict[str, Column]:
    return {
        "total": F.count(F.lit(1)),
        "toxic": tally("is_toxic"),
        "non_toxic": tally(~F.col("is_toxic")),
        "positive": tally(_is("positive")),
        "negative": tally(_is("negative")),
        "neutral": tally(_is("neutral")),
    }


def _named(columns: dict[str, Column], names: dict[str, str]) -> list[Column]:
    return [columns[k].alias(v) for k, v in names.items()]


def global_statistics(df: DataFrame) -> DataFrame:
    """One row: counts and averages to 3 digits, 0.5 and 0 when there is nothing to average."""
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in _counts().items()]
    return df.agg(
        *counts,
        F.coalesce(fixed(F.avg("sentiment_score"), 3), F.lit(0.5)).alias("avg_sentiment"),
        F.coalesce(fixed(F.avg("toxicity_score"), 3), F.lit(0.0)).alias("avg_toxicity"),
    )


def kpi_percentages(stats: DataFrame) -> DataFrame:
    """Shares of the total in percent, 0 over an empty table."""
    def share(name):
        return F.coalesce(fixed(percentage(name, "total"), 4), F.lit(0.0))
    return stats.select(
        "total", share("toxic").alias("toxic_pct"), share("positive").alias("positive_pct"),
        share("negative").alias("negative_pct"), "avg_sentiment",
    )


def daily_summary(df: DataFrame, ts: str = "created_time") -> DataFrame:
    """Per day of creation, newest first."""
    counts = _counts()
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(day_of(ts).alias("date"))
        .agg(
            *_named(counts, {
                "total": "total_comments", "toxic": "toxic_count", "non_toxic": "non_toxic_count",
                "positive": "positive_count", "negative": "negative_count", "neutral": "neutral_count",
            }),
            fixed(F.avg("toxicity_score"), 4).alias("avg_toxicity"),
            fixed(F.avg("sentiment_score"), 4).alias("avg_sentiment"),
            fixed(percentage(counts["toxic"], counts["total"]), 2).alias("toxic_percentage"),
        )
        .orderBy(F.col("date").desc())
    )


def daily_summary_ingested(df: DataFrame, ts: str = "ingestion_time") -> DataFrame:
    """Per day of ingestion, narrow form."""
    return (
        df.groupBy(day_of(ts).alias("date"))
        .agg(
            *_named(_counts(), {
                "total": "total_comments", "toxic": "toxic_comments", "positive": "positive",
                "negative": "negative", "neutral": "neutral",
            }),
            fixed(F.avg("toxicity_score"), 4).alias("avg_toxicity"),
        )
        .orderBy(F.col("date").desc())
    )


def daily_summary_recent(df: DataFrame, as_of: Column, n_days: int = 30, ts: str = "ingestion_time") -> DataFrame:
    """Per day over the last days, averages to 3 digits."""
    return (
        df.filter(within(ts, as_of, days(n_days)))
        .groupBy(day_of(ts).alias("date"))
        .agg(
            *_named(_counts(), {
                "total": "total_comments", "toxic": "toxic_count",
                "positive": "positive_count", "negative": "negative_count",
            }),
            fixed(F.avg("toxicity_score"), 3).alias("avg_toxicity"),
            fixed(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
        )
        .orderBy(F.col("date").desc())
    )


def hourly_activity(df: DataFrame, as_of: Column, ts: str = "ingestion_time") -> DataFrame:
    """Per hour over the last 24 hours, newest first."""
    return (
        df.filter(within(ts, as_of, hours(24)))
        .groupBy(hour_of(ts).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            tally("is_toxic").alias("toxic_count"),
            fixed(F.avg("toxicity_score"), 4).alias("avg_toxicity"),
            fixed(F.avg("sentiment_score"), 4).alias("avg_sentiment"),
        )
        .orderBy(F.col("hour").desc())
    )


def timeline(df: DataFrame, as_of: Column, span: Column, ts: str = "ingestion_time") -> DataFrame:
    """Per hour over a span, oldest first."""
    return (
        df.filter(within(ts, as_of, span))
        .groupBy(hour_of(ts).alias("hour"))
        .agg(*_named(_counts(), {
            "total": "total_count", "toxic": "toxic_count",
            "positive": "positive_count", "negative": "negative_count",
        }))
        .orderBy("hour")
    )


def _known_users(df: DataFrame) -> DataFrame:
    return df.filter(F.col("username").isNotNull() & (F.col("username") != "Unknown"))


def top_users(df: DataFrame, limit: int = 50) -> DataFrame:
    """Most active users; ties by name. The limit is a top-k: only k rows per task are kept."""
    counts = _counts()
    return (
        _known_users(df)
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            counts["toxic"].alias("toxic_count"),
            fixed(percentage(counts["toxic"], counts["total"]), 2).alias("toxic_percentage"),
            fixed(F.avg("sentiment_score"), 4).alias("avg_sentiment"),
            F.max("ingestion_time").alias("last_comment"),
        )
        .orderBy(F.col("comment_count").desc(), "username")
        .limit(limit)
    )


def top_users_short(df: DataFrame, limit: int = 10) -> DataFrame:
    return (
        _known_users(df)
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            tally("is_toxic").alias("toxic_count"),
            fixed(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
        )
        .orderBy(F.col("comment_count").desc(), "username")
        .limit(limit)
    )


def toxicity_histogram(df: DataFrame) -> DataFrame:
    """Five half-open buckets; empty ones are absent, a NULL score falls into the last."""
    score = F.col("toxicity_score")
    bucket = (
        F.when(score < 0.2, BUCKETS[0]).when(score < 0.4, BUCKETS[1])
        .when(score < 0.6, BUCKETS[2]).when(score < 0.8, BUCKETS[3]).otherwise(BUCKETS[4])
    )
    return df.groupBy(bucket.alias("range")).agg(F.count(F.lit(1)).alias("count")).orderBy("range")


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))


def _statistics_columns() -> list[Column]:
    counts = _counts()

    def share(name):
        return F.coalesce(fixed(percentage(counts[name], counts["total"]), 6), F.lit(0.0))
    return [
        *_named(counts, {
            "total": "total_comments", "toxic": "toxic_count", "non_toxic": "non_toxic_count",
            "positive": "positive_count", "negative": "negative_count", "neutral": "neutral_count",
        }),
        F.coalesce(fixed(F.avg("toxicity_score"), 6), F.lit(0.0)).alias("avg_toxicity_score"),
        F.coalesce(fixed(F.avg("sentiment_score"), 6), F.lit(0.5)).alias("avg_sentiment_score"),
        share("toxic").alias("toxic_percentage"),
        share("positive").alias("positive_percentage"),
        share("negative").alias("negative_percentage"),
    ]


def realtime_statistics(df: DataFrame, as_of: Column, n_minutes: int = 5, ts: str = "ingestion_time") -> DataFrame:
    """Snapshot row of the trailing minutes. Without rows the counts but the total are NULL."""
    return (
        df.filter(within(ts, as_of, minutes(n_minutes)))
        .agg(*_statistics_columns())
        .select(
            as_of.alias("timestamp"), "*",
            (as_of - minutes(n_minutes)).alias("period_start"), as_of.alias("period_end"),
            F.lit("realtime").alias("period_type"),
        )
    )


def period_statistics(df: DataFrame, period: str, ts: str = "ingestion_time") -> DataFrame:
    """Snapshot rows per calendar hour, day or week (from Monday)."""
    start, length = {
        "hourly": (hour_of(ts), hours(1)),
        "daily": (day_of(ts).cast("timestamp_ntz"), days(1)),
        "weekly": (week_of(ts).cast("timestamp_ntz"), days(7)),
    }[period]
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(start.alias("period_start"))
        .agg(*_statistics_columns())
        .select(
            (F.col("period_start") + length).alias("timestamp"), "*",
            (F.col("period_start") + length).alias("period_end"), F.lit(period).alias("period_type"),
        )
    )


def latest_row(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The newest row, ties by the remaining columns in order; a top-1, not a sort."""
    ties = [c for c in df.columns if c != ts]
    return df.orderBy(F.col(ts).desc_nulls_last(), *ties).limit(1)


def run_counters(fetched: DataFrame, message: str, key: str, recorded_at: Column) -> DataFrame:
    """Collector counters as ``(metric_name, metric_value, recorded_at)`` rows.

    Records with a message are sent once per key; further copies are skipped duplicates, records
    without a message are fetched only.
    """
    per_key = fetched.groupBy(key).agg(
        F.count(F.lit(1)).alias("_fetched"),
        F.sum(F.when(F.coalesce(F.col(message), F.lit("")) != "", 1).otherwise(0)).alias("_usable"),
    )
    totals = per_key.agg(
        F.sum("_fetched").alias("total_fetched"),
        F.sum(F.least("_usable", F.lit(1))).alias("total_sent"),
        F.sum(F.greatest(F.col("_usable") - 1, F.lit(0))).alias("duplicates_skipped"),
    )
    return totals.unpivot(
        [], ["total_fetched", "total_sent", "duplicates_skipped"], "metric_name", "metric_value"
    ).select("metric_name", F.coalesce(F.col("metric_value"), F.lit(0)).cast("double").alias("metric_value"),
             recorded_at.alias("recorded_at"))
