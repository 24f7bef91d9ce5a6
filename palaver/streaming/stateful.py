"""Stateful streams: duplicates, windowed statistics, label join.

The source system has no watermark; 10 minutes is our default, later rows are dropped and counted
in the query progress. State grows with the key count within the watermark: on a cluster use the
RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver.functions.scalars import tally


def without_duplicates(df: DataFrame, ts: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a key within the watermark."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_statistics(df: DataFrame, ts: str = "ingestion_time", length: str = "5 minutes",
                        slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts and score sums per event-time window; a slide makes the windows trail.

    Sums and counts rather than means are kept, so rows of an ``update`` stream can be replaced by
    window and means taken when read. ``is_toxic`` rows are combined in each task first.
    """
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        df.withWatermark(ts, delay)
        .groupBy(window.alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("total_comments"),
            tally("is_toxic").alias("toxic_count"),
            tally(~F.col("is_toxic")).alias("non_toxic_count"),
            tally(F.col("sentiment") == "positive").alias("positive_count"),
            tally(F.col("sentiment") == "negative").alias("negative_count"),
            tally(F.col("sentiment") == "neutral").alias("neutral_count"),
            F.sum("toxicity_score").alias("toxicity_sum"),
            F.sum("sentiment_score").alias("sentiment_sum"),
        )
        .select(F.col("_window.start").alias("period_start"), F.col("_window.end").alias("period_end"),
                "total_comments", "toxic_count", "non_toxic_count", "positive_count", "negative_count",
                "neutral_count", "toxicity_sum", "sentiment_sum")
    )


def join_truth_stream(predictions: DataFrame, truth: DataFrame, key: str, predicted_at: str, labelled_at: str,
                      within: str = "1 hour", delay: str = "10 minutes", unlabelled: bool = False) -> DataFrame:
    """Join of two streams; a label may come up to ``within`` before or after its prediction.

    With ``unlabelled`` a prediction that has no label by then comes out without one, once the watermark has passed its time limit. The state
    holds the predictions and labels of ``within`` and ``delay``. A label that comes later still finds its prediction in a
    keyed table (``sinks.to_keyed``).
    """
    left = predictions.withWatermark(predicted_at, delay).alias("p")
    right = truth.withWatermark(labelled_at, delay).alias("t")
    span = F.expr(f"INTERVAL {within}")
    at, labelled = F.col(f"p.{predicted_at}"), F.col(f"t.{labelled_at}")
    together = (F.col(f"p.{key}") == F.col(f"t.{key}")) & (labelled >= at - span) & (labelled <= at + span)
    rest = [F.col(f"t.{c}") for c in truth.columns if c != key]
    return left.join(right, together, "left_outer" if unlabelled else "inner").select("p.*", *rest)
