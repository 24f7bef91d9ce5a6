"""Declared schemas of every record and table."""

from __future__ import annotations

from pyspark.sql import types as T

from palaver import values


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType(), "words": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """Columns written as ``name type, ...``. Needs no session, so the module can be imported first."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW = _struct("source string, post_id string, comment_id string, user string, message string, created_time string")

API_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("from", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("created_time", T.StringType()),
    T.StructField("like_count", T.IntegerType()),
])

CLEANED = _struct(
    "source string, post_id string, comment_id string, username string, original_message string, "
    "cleaned_message string, created_time string, processing_time string"
)

FEATURES = _struct(
    "source string, post_id string, comment_id string, username string, original_message string, "
    "cleaned_message string, created_time string, char_count int, word_count int, avg_word_length double, "
    "lexical_score double, toxic_word_count int, positive_word_count int, uppercase_ratio double, "
    "feature_extraction_time string"
)

PREDICTIONS = _struct(
    "comment_id string, toxicity_score double, label string, is_toxic boolean, sentiment string, "
    "sentiment_score double, prediction_time string"
)

RESULT = _struct(
    "post_id string, comment_id string, username string, comment string, cleaned_comment string, "
    "toxicity_score double, label string, is_toxic boolean, sentiment string, sentiment_score double, "
    "word_count int, char_count int, created_time timestamp_ntz, ingestion_time timestamp_ntz"
)

RESULT_WIDE = _struct(
    "post_id string, comment_id string, username string, comment string, cleaned_comment string, "
    "toxicity_score double, " + ", ".join(f"{c} double" for c in values.SUB_SCORES) + ", "
    "label string, is_toxic boolean, sentiment string, sentiment_score double, word_count int, char_count int, "
    "keywords words, created_time timestamp_ntz, ingestion_time timestamp_ntz, "
    "requires_review boolean, is_processed boolean"
)

STATISTICS = _struct(
    "timestamp timestamp_ntz, total_comments bigint, toxic_count bigint, non_toxic_count bigint, "
    "positive_count bigint, negative_count bigint, neutral_count bigint, avg_toxicity_score double, "
    "avg_sentiment_score double, toxic_percentage double, positive_percentage double, "
    "negative_percentage double, period_start timestamp_ntz, period_end timestamp_ntz, period_type string"
)

KEYWORDS = _struct(
    "keyword string, count bigint, sentiment_avg double, toxicity_avg double, "
    "last_updated timestamp_ntz, first_seen timestamp_ntz"
)

METRICS = _struct("metric_name string, metric_value double, recorded_at timestamp_ntz")

CORPUS = _struct("id string, comment_text string, " + ", ".join(f"{c} int" for c in values.TOXICITY_LABELS))
CORPUS_TEXT = _struct("id string, comment_text string")
CORPUS_LABELS = _struct("id string, " + ", ".join(f"{c} int" for c in values.TOXICITY_LABELS))

# Values a column takes when the writer leaves it out.
RESULT_DEFAULTS = {
    "username": "Unknown",
    "toxicity_score": 0.0,
    **{c: 0.0 for c in values.SUB_SCORES},
    "label": "non_toxique",
    "is_toxic": False,
    "sentiment": "neutral",
    "sentiment_score": 0.5,
    "word_count": 0,
    "char_count": 0,
    "requires_review": False,
    "is_processed": True,
}
