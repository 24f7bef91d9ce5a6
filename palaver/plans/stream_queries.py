"""Streaming queries: file streams run to completion, results read back.

Each writes to a new run folder below the session's shared folder.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from palaver import schemas, session
from palaver.functions.scalars import fixed
from palaver.operators import keywords
from palaver.operators.evaluation import label_outcome
from palaver.operators.records import encode_envelope
from palaver.plans import bindings, stages
from palaver.plans.registry import query
from palaver.plans.report_queries import rounded_trending
from palaver.sources import keyed
from palaver.streaming import hops, sinks, stateful

FILES_PER_TRIGGER = 64  # the size of a micro-batch, whatever the size of the table
# The tables are not in time order: any file may hold any time. The delay covers their whole span, so that
# no row is late; a live source has its own, far smaller one.
DISORDER = "400 days"


def _stream(spark, folder, name, key):
    """A table as a file stream. The pattern stands for a single file as well as for a folder."""
    stored = bindings.table(spark, folder, name)
    stream = hops.read_files_stream(spark, os.path.join(folder, f"{name}.parquet*"), stored.schema, FILES_PER_TRIGGER)
    return session.spread(stream, key)


def _texts(spark, folder):
    return _stream(spark, folder, "documents", "doc_id").select(
        F.col("source").alias("post_id"), F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        F.col("text").alias("message"), "doc_id",
    )


def _comments(spark, folder):
    """The stream of texts with author and time from the table of events."""
    return bindings.with_events(_texts(spark, folder), spark, folder)


def _folders(spark, name):
    run = session.run_folder(spark, name)
    return os.path.join(run, "table"), os.path.join(run, "checkpoint")


@query
def stream_clean(spark, folder):
    """One stateless hop to a file sink."""
    path, checkpoint = _folders(spark, "stream-clean")
    cleaned = stages.clean_stage(_texts(spark, folder)).select("comment_id", "cleaned_message")
    hops.drained(sinks.to_files(cleaned, path, checkpoint))
    return spark.read.schema(cleaned.schema).parquet(path)


@query
def stream_hops(spark, folder):
    """Three chained message hops, each drained from the files the one before wrote."""
    run = session.run_folder(spark, "stream-hops")
    message = spark.createDataFrame([], "key string, value string").schema
    raw = _comments(spark, folder).select(
        F.lit("facebook").alias("source"), "post_id", "comment_id", F.col("username").alias("user"), "message",
        F.concat(F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("created_time"),
    )

    def hop(messages, name):
        path = os.path.join(run, name)
        hops.drained(sinks.to_files(messages, path, os.path.join(run, f"{name}-checkpoint")))
        stored = hops.read_files_stream(spark, path, message)
        return stored.withColumn("timestamp", F.lit(None).cast("timestamp"))

    features = hop(hops.feature_builder(hop(hops.normaliser(hop(encode_envelope(raw), "raw")), "cleaned")), "features")
    path = os.path.join(run, "predictions")
    predicted = stages.prediction_record(hops.scorer(features)).drop("prediction_time")
    hops.drained(sinks.to_files(predicted, path, os.path.join(run, "predictions-checkpoint")))
    return spark.read.schema(predicted.schema).parquet(path).withColumn("sentiment_score", fixed("sentiment_score", 6))


@query
def stream_score_upsert(spark, folder):
    """Scored stream into the epoch table, run twice over the same input: the replay changes nothing."""
    path, checkpoint = _folders(spark, "stream-upsert")
    scored = stages.analyse(_comments(spark, folder)).withColumnRenamed("message", "original_message")
    rows = stages.result_record(scored, F.col("created_time"), F.col("ingestion_time"))
    hops.drained(sinks.to_epochs(rows, path, checkpoint))
    hops.drained(sinks.to_epochs(rows, path, f"{checkpoint}-replay"))
    current = sinks.current_rows(spark, path, schemas.RESULT)
    return current.withColumn("sentiment_score", fixed("sentiment_score", 6))


@query
def stream_fold(spark, folder):
    """Scored stream, folded into a keyed table between two runs over the same input; read by one path."""
    path, checkpoint = _folders(spark, "stream-fold")
    scored = stages.analyse(_comments(spark, folder)).withColumnRenamed("message", "original_message")
    rows = stages.result_record(scored, F.col("created_time"), F.col("ingestion_time"))
    hops.drained(sinks.to_epochs(rows, path, checkpoint))
    sinks.fold(spark, path, schemas.RESULT, ended=True, buckets=8)
    hops.drained(sinks.to_epochs(rows, path, f"{checkpoint}-replay"))
    current = sinks.current_rows(spark, path, schemas.RESULT)
    return current.withColumn("sentiment_score", fixed("sentiment_score", 6))


@query
def stream_fan_out(spark, folder):
    """One scored stream, two outputs from the same computed batch: table rows and messages."""
    path, checkpoint = _folders(spark, "stream-fan-out")
    messages = f"{path}-messages"
    scored = stages.analyse(_comments(spark, folder)).withColumnRenamed("message", "original_message")
    rows = stages.result_record(scored, F.col("created_time"), F.col("ingestion_time"))

    def publish(batch, run, epoch):
        sinks.write_epoch(encode_envelope(batch, "comment_id", ["comment_id", "label", "is_toxic"]), messages, run, epoch)
    hops.drained(sinks.to_epochs(rows, path, checkpoint, also=publish))
    return spark.read.schema("key string, value string").parquet(messages).drop("run", "epoch")


@query
def stream_window_stats(spark, folder):
    """Hourly statistics as an update stream; the last version of each window counts."""
    path, checkpoint = _folders(spark, "stream-windows")
    scored = stages.analyse(_comments(spark, folder)).withColumn("ts", F.col("ingestion_time").cast("timestamp"))
    return _window_rows(spark, stateful.windowed_statistics(scored, "ts", "1 hour", delay=DISORDER), path, checkpoint)


def _window_rows(spark, windows, path, checkpoint):
    """Drain an update stream of windows; the last version of each counts."""
    hops.drained(sinks.to_epochs(windows, path, checkpoint, mode="update"))
    rest = tuple(c for c in windows.columns if c != "period_start")
    last = sinks.current_rows(spark, path, windows.schema, "period_start", ("period_start",), rest)
    return last.select(
        F.col("period_start").cast("timestamp_ntz").alias("period_start"),
        F.col("period_end").cast("timestamp_ntz").alias("period_end"),
        "total_comments", "toxic_count", "non_toxic_count", "positive_count", "negative_count", "neutral_count",
        fixed(F.col("toxicity_sum") / F.col("total_comments"), 6).alias("avg_toxicity_score"),
        fixed(F.col("sentiment_sum") / F.col("total_comments"), 6).alias("avg_sentiment_score"),
    )


@query
def stream_sliding_stats(spark, folder):
    """Statistics of the trailing two hours, every hour."""
    path, checkpoint = _folders(spark, "stream-sliding")
    scored = stages.analyse(_comments(spark, folder)).withColumn("ts", F.col("ingestion_time").cast("timestamp"))
    windows = stateful.windowed_statistics(scored, "ts", "2 hours", "1 hour", delay=DISORDER)
    return _window_rows(spark, windows, path, checkpoint)


@query
def stream_dedup(spark, folder):
    """Distinct texts of the stream, by content hash, within a watermark longer than the data."""
    path, checkpoint = _folders(spark, "stream-dedup")
    rows = _comments(spark, folder).select(
        F.md5("message").alias("content_key"), F.col("ingestion_time").cast("timestamp").alias("ts"))
    distinct = stateful.without_duplicates(rows, "ts", ["content_key"], DISORDER).select("content_key")
    hops.drained(sinks.to_files(distinct, path, checkpoint))
    return spark.read.schema(distinct.schema).parquet(path)


@query
def stream_dedup_table(spark, folder):
    """Distinct texts of the stream against the keys stored by earlier batches: no watermark, no state in memory."""
    path, checkpoint = _folders(spark, "stream-distinct")
    rows = _texts(spark, folder).select(F.md5("message").alias("content_key"), "doc_id")
    for _ in range(2):  # a second checkpoint reads the same texts again and adds nothing
        hops.drained(sinks.to_distinct(rows, "content_key", ["doc_id"], path, checkpoint))
        checkpoint = f"{checkpoint}-again"
    return spark.read.schema("content_key string").parquet(path).drop("run", "epoch")


@query
def stream_label_join(spark, folder):
    """Prediction stream joined with the label stream; labels come with the time of their comment."""
    path, checkpoint = _folders(spark, "stream-labels")
    predicted = stages.analyse(_comments(spark, folder)).select(
        "comment_id", "toxicity_score", "is_toxic", F.col("ingestion_time").cast("timestamp").alias("predicted_at"))
    labels = bindings.with_events(_stream(spark, folder, "labels", "doc_id"), spark, folder).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), "toxic",
        F.col("ingestion_time").cast("timestamp").alias("labelled_at"))
    joined = stateful.join_truth_stream(predicted, labels, "comment_id", "predicted_at", "labelled_at", delay=DISORDER)
    out = joined.select("comment_id", "toxicity_score", "is_toxic", "toxic")
    hops.drained(sinks.to_files(out, path, checkpoint))
    return spark.read.schema(out.schema).parquet(path)


@query
def stream_label_outcomes(spark, folder):
    """Predictions and labels, which come 0 to 90 minutes after their comment, meet in a keyed table, in whatever order."""
    path, checkpoint = _folders(spark, "stream-outcomes")
    unknown = {"toxicity_score": "double", "is_toxic": "boolean", "predicted_at": "timestamp_ntz"}
    unlabelled = {"toxic": "int", "labelled_at": "timestamp_ntz"}
    columns = ["comment_id", *unknown, *unlabelled]
    predicted = stages.analyse(_comments(spark, folder)).withColumn("predicted_at", F.col("ingestion_time"))
    labels = bindings.with_events(_stream(spark, folder, "labels", "doc_id"), spark, folder).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), F.col("toxic").cast("int").alias("toxic"),
        (F.col("ingestion_time") + F.make_dt_interval(mins=F.lit(30) * (F.col("doc_id") % 4).cast("int"))).alias("labelled_at"))

    def filled(df, types):
        return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items()}).select(*columns)
    hops.drained(sinks.to_keyed(
        filled(labels, unknown), path, f"{checkpoint}-labels", "comment_id", ["labelled_at"], tuple(unlabelled), buckets=8))
    hops.drained(sinks.to_keyed(
        filled(predicted, unlabelled), path, checkpoint, "comment_id", ["predicted_at"], tuple(unknown), buckets=8))
    rows = keyed.read(spark, path, filled(labels, unknown).schema)
    return rows.select("comment_id", "toxicity_score", "is_toxic", "toxic",
                       label_outcome("predicted_at", "labelled_at", bindings.as_of()).alias("outcome"))


@query
def stream_trending(spark, folder):
    """Trending keywords kept by a stream: partial sums of each micro-batch, folded into a table by keyword."""
    path, checkpoint = _folders(spark, "stream-trending")
    scored = stages.analyse(_comments(spark, folder))
    found = keywords.comment_keywords(scored, "cleaned_message").select(
        "keywords", "sentiment_score", "toxicity_score", "ingestion_time")
    for _ in range(2):  # the second run finds nothing new and adds nothing
        hops.drained(sinks.to_combined(found, path, checkpoint, "keyword", keywords.trending, keywords.merge_trending, buckets=8))
    return rounded_trending(keyed.read(spark, path, keywords.trending(found).schema))


@query
def stream_drain(spark, folder):
    """Two drains over one checkpoint: the second finds nothing new and adds nothing."""
    path, checkpoint = _folders(spark, "stream-drain")
    rows = _texts(spark, folder).select("comment_id", "post_id", F.length("message").alias("char_count"))
    hops.drained(sinks.to_files(rows, path, checkpoint))
    hops.drained(sinks.to_files(rows, path, checkpoint))
    return spark.read.schema(rows.schema).parquet(path)
