"""Queries over texts and records: cleaning, envelopes, features, scores, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver import schemas, values
from palaver.functions import text
from palaver.functions.scalars import fixed
from palaver.operators import quality, records
from palaver.plans import bindings, stages
from palaver.plans.registry import query


@query
def clean_text(spark, folder):
    return stages.clean_stage(bindings.texts(spark, folder)).select("comment_id", "cleaned_message")


@query
def clean_text_quick(spark, folder):
    return bindings.texts(spark, folder).select("comment_id", text.clean_text_quick("message").alias("cleaned_message"))


@query
def clean_text_minimal(spark, folder):
    return bindings.texts(spark, folder).select(
        "comment_id", text.clean_text_minimal("message").alias("cleaned_message"))


@query
def clean_switches(spark, folder):
    """The main cleaner without hashtags and numbers, and with the narrow emoji ranges."""
    return stages.clean_stage(
        bindings.texts(spark, folder), emoji_ranges=values.EMOJI_RANGES_STRICT, hashtags=True, numbers=True,
    ).select("comment_id", "cleaned_message")


@query
def raw_record_shape(spark, folder):
    """Nested API records with missing parts, shaped, blanks dropped, with the stream they go to."""
    n = F.col("doc_id")
    record = F.struct(
        F.col("comment_id").alias("id"),
        F.when(n % 7 != 0, F.col("message")).alias("message"),
        F.when(n % 5 != 0, F.struct(F.col("username").alias("name"))).alias("from"),
        F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_time"),
        F.when(n % 3 != 0, (n % 50).cast("int")).alias("like_count"),
    )
    sent = bindings.comments(spark, folder).select("post_id", F.to_json(record).alias("value"))
    parsed = sent.select("post_id", F.from_json("value", schemas.API_RECORD).alias("record"))
    shaped = records.drop_blank_messages(records.shape_api_record(parsed, "record"))
    stage = F.when(F.col("like_count") > 25, "cleaned").when(F.col("like_count") > 10, "labels").otherwise("other")
    return shaped.select("*", records.topic_of(stage).alias("topic"))


@query
def json_envelope_roundtrip(spark, folder):
    """Raw messages to JSON envelopes and back."""
    sent = records.encode_envelope(bindings.raw_messages(spark, folder)).select(
        "key", "value", F.lit(None).cast("timestamp_ntz").alias("timestamp"))
    return records.decode_envelope(sent, schemas.RAW).drop("broker_timestamp")


@query
def text_features(spark, folder):
    built = stages.feature_stage(stages.clean_stage(bindings.texts(spark, folder)))
    return built.select(
        "comment_id", "char_count", "word_count", fixed("avg_word_length", 6).alias("avg_word_length"),
        fixed("lexical_score", 6).alias("lexical_score"), "toxic_word_count", "positive_word_count",
        fixed("uppercase_ratio", 6).alias("uppercase_ratio"),
    )


@query
def text_features_full(spark, folder):
    return stages.full_features(bindings.texts(spark, folder), "message").drop("post_id", "message", "doc_id", "lang")


@query
def toxicity_rules(spark, folder):
    """Rule score of the cleaned text, and of the text as written (where shouting counts)."""
    cleaned = stages.clean_stage(bindings.texts(spark, folder))
    both = stages.rule_stage(stages.rule_stage(cleaned, "cleaned_message"), "message", "raw_toxicity_score")
    return both.select("comment_id", "toxicity_score", "raw_toxicity_score")


@query
def score_comments(spark, folder):
    """Result records from raw messages, with the time parsed from its text."""
    scored = stages.analyse(bindings.raw_messages(spark, folder)).withColumnsRenamed(
        {"user": "username", "message": "original_message"})
    record = stages.result_record(scored, ingestion_time=bindings.as_of())
    return record.withColumn("sentiment_score", fixed("sentiment_score", 6))


@query
def toxicity_quick(spark, folder):
    rows = stages.quick_record(bindings.raw_texts(spark, folder), bindings.as_of())
    return rows.select("comment_id", "cleaned_comment", fixed("toxicity_score", 6).alias("toxicity_score"), "label",
                       "is_toxic", "word_count", "char_count")


@query
def sentiment_quick(spark, folder):
    rows = stages.quick_record(bindings.raw_texts(spark, folder), bindings.as_of())
    return rows.select("comment_id", "sentiment", "sentiment_score")


@query
def flag_minimal(spark, folder):
    rows = stages.minimal_record(bindings.raw_texts(spark, folder), bindings.as_of())
    return rows.select("comment_id", "cleaned_comment", "toxicity_score", "label", "is_toxic", "sentiment",
                       "sentiment_score", "word_count", "char_count")


@query
def write_time_labels(spark, folder):
    """Write-time rule over rows whose sentiment is in part missing or blank."""
    n = F.col("doc_id")
    rows = bindings.results(spark, folder).select(
        "comment_id", "toxicity_score", "label", "is_toxic",
        F.when(n % 3 == 0, F.lit(None)).when(n % 3 == 1, F.lit("")).otherwise(F.col("sentiment")).alias("sentiment"),
        "sentiment_score", F.lit(False).alias("requires_review"),
    )
    return quality.write_time_labels(rows).withColumn("sentiment_score", fixed("sentiment_score", 6))


@query
def validate_rows(spark, folder):
    """Rows that break table rules, with the names of the rules; some rows are damaged on purpose."""
    n = F.col("doc_id")
    rows = bindings.results(spark, folder).select(
        "comment_id",
        F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("post_id")).alias("post_id"),
        (F.col("toxicity_score") * 2).alias("toxicity_score"),
        F.when(n % 11 == 0, F.col("lang")).otherwise(F.col("label")).alias("label"),
        F.when(n % 17 == 0, F.lit("mixed")).otherwise(F.col("sentiment")).alias("sentiment"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(F.col("sentiment_score") - 0.2).alias("sentiment_score"),
    )
    _, rejected = quality.split_rows(rows)
    return rejected.select("comment_id", F.array_join(F.array_sort("reasons"), ",").alias("reasons"))


@query
def validate_keys(spark, folder):
    """Texts that occur more than once, by content hash."""
    rows = bindings.texts(spark, folder).select(F.md5("message").alias("content_key"))
    return quality.repeated_keys(rows, "content_key")


@query
def fill_defaults(spark, folder):
    """Rows that name a few columns only, brought to the full table with its defaults."""
    n = F.col("doc_id")
    rows = bindings.comments(spark, folder).select(
        "post_id", "comment_id", F.when(n % 4 != 0, F.col("username")).alias("username"),
        F.col("message").alias("comment"), "created_time", "ingestion_time",
    )
    return quality.with_defaults(rows).withColumn("keywords", F.array_join("keywords", " "))


@query
def fill_nulls(spark, folder):
    """Explicit NULLs replaced by the column defaults."""
    n = F.col("doc_id")
    rows = bindings.comments(spark, folder).select(
        "comment_id", F.when(n % 4 != 0, F.col("username")).alias("username"),
        F.when(n % 3 != 0, F.lit(0.25)).alias("toxicity_score"),
        F.when(n % 2 != 0, F.lit("positive")).alias("sentiment"),
    )
    return quality.replace_nulls(rows)
