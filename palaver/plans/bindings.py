"""The driver's tables as comments: documents give the texts, events their time and author."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from palaver import session
from palaver.functions.scalars import moment
from palaver.plans import stages
from palaver.sources import files

AS_OF = "2024-01-10 00:00:00"


def as_of():
    return moment(AS_OF)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return files.read_table(spark, os.path.join(folder, f"{name}.parquet"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with their post and comment id; small inputs are spread over the cores."""
    return session.spread(table(spark, folder, "documents"), "doc_id").select(
        F.col("source").alias("post_id"),
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        F.col("text").alias("message"), "doc_id", "lang",
    )


def with_events(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add author and times: a comment's event is the one numbered five times its id."""
    events = table(spark, folder, "events").select(
        F.col("event_id"), F.col("ts").alias("created_time"), F.col("ts").alias("ingestion_time"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
    )
    return df.join(events, F.col("event_id") == F.col("doc_id") * 5).drop("event_id")


def comments(spark: SparkSession, folder: str) -> DataFrame:
    return with_events(texts(spark, folder), spark, folder)


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Comments in the raw record form: all text, ISO time with zone."""
    return comments(spark, folder).select(
        F.lit("facebook").alias("source"), "post_id", "comment_id", F.col("username").alias("user"), "message",
        F.concat(F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("created_time"),
    )


def raw_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records whose author and time are not needed: scored where they are read, no join."""
    unknown = F.lit(None).cast("string")
    return texts(spark, folder).select(
        F.lit("facebook").alias("source"), "post_id", "comment_id", unknown.alias("user"), "message", unknown.alias("created_time"))


RESULT = ["post_id", "comment_id", "username", "comment", "cleaned_comment", "toxicity_score", "label", "is_toxic",
          "sentiment", "sentiment_score", "word_count", "char_count", "created_time", "ingestion_time"]


def _as_result(df: DataFrame) -> DataFrame:
    renamed = df.withColumnsRenamed({"message": "comment", "cleaned_message": "cleaned_comment"})
    return renamed.select(*RESULT, "doc_id", "lang", "toxic_word_count", "lexical_score")


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, folder: str, name: str, write) -> str:
    """Path of a table derived from a folder of tables, written on its first use in this application.

    ``write(path)`` is the job that a collector would run once; the reports then read what it wrote.
    """
    key = (spark.conf.get("spark.app.id", ""), folder, name)
    if key not in _STORED:
        path = session.run_folder(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def result_table(spark: SparkSession, folder: str) -> str:
    """The result table of all comments by ingestion day.

    Texts meet their events first and are scored afterwards, so that a join by shuffle moves each text once, without its cleaned form.
    """
    def write(path: str) -> None:
        files.write_results(_as_result(stages.analyse(comments(spark, folder))), path)
    return stored(spark, folder, "results", write)


def results(spark: SparkSession, folder: str, span=None) -> DataFrame:
    """The stored results; with a span (an interval) only the days that it reaches back from ``as_of``."""
    path = result_table(spark, folder)
    if span is None:
        return files.read_results(spark, path)
    return files.read_results(spark, path, as_of() - span, as_of())


def results_until(spark: SparkSession, folder: str) -> DataFrame:
    """What was stored before ``as_of``."""
    rows = files.read_results(spark, result_table(spark, folder), until=as_of())
    return rows.filter(F.col("ingestion_time") < as_of())
