"""Clean, feature and score stages: the same functions run on batch and on streaming frames.

Each stage adds columns, so a caller carries whatever else it needs along; the ``*_record``
functions then shape the declared record of a hop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver import values
from palaver.functions import scores, text
from palaver.functions.once import computed_once
from palaver.functions.scalars import fixed, safe_timestamp


def clean_stage(df: DataFrame, message: str = "message", **options) -> DataFrame:
    """Add ``cleaned_message`` and drop rows where nothing is left of the text.

    The empty rows are dropped by exploding a filtered one-element array rather than by a filter:
    a filter on the cleaned text would be moved below its projection with a second copy of the
    whole cleaning expression, and every text would be cleaned twice.
    """
    kept = F.filter(F.array(text.clean_text(message, **options)), lambda c: F.length(c) > 0)
    return df.select("*", F.explode(kept).alias("cleaned_message"))


def feature_stage(df: DataFrame, message: str = "message", cleaned: str = "cleaned_message") -> DataFrame:
    """Add the lexical features; ``lexicon_hits`` keeps the tokens any of the lists knows.

    Counts and score read the cleaned text, ``lexical_score`` and ``uppercase_ratio`` the original.
    """
    read = computed_once(df, {
        "_cleaned": text.token_summary(
            text.cleaned_tokens_sql(cleaned), values.TOXIC_WORDS, values.POSITIVE_WORDS,
            values.SEVERE_WORDS, values.MODERATE_WORDS),
        "_original": text.token_summary(
            text.tokens_sql(f"lower(`{message}`)"), values.TOXIC_WORDS, values.POSITIVE_WORDS),
    }).select(*df.columns, F.col("_cleaned.n").alias("word_count"), F.col("_cleaned.hits").alias("lexicon_hits"),
              F.col("_original.n").alias("_original_count"), F.col("_original.hits").alias("_original_hits"))
    # All blanks of a cleaned text stand between two of its tokens.
    letters = F.length(cleaned) - F.col("word_count") + 1
    return read.select(
        *df.columns,
        scores.char_count(cleaned).alias("char_count"),
        "word_count",
        scores.average_length(letters, "word_count").alias("avg_word_length"),
        scores.lexical_score(
            text.count_in("_original_hits", values.TOXIC_WORDS),
            text.count_in("_original_hits", values.POSITIVE_WORDS),
            "_original_count",
        ).alias("lexical_score"),
        text.count_in("lexicon_hits", values.TOXIC_WORDS).alias("toxic_word_count"),
        text.count_in("lexicon_hits", values.POSITIVE_WORDS).alias("positive_word_count"),
        scores.uppercase_ratio(message).alias("uppercase_ratio"),
        "lexicon_hits",
    )


def full_features(df: DataFrame, message: str) -> DataFrame:
    """The full feature set of one text, rounded to 2 and 4 digits; all of it on the given text."""
    lists = (values.TOXIC_WORDS, values.POSITIVE_WORDS)
    words = text.tokens_sql(f"lower(`{message}`)")
    read = computed_once(df, {"_read": text.token_summary(words, *lists)})
    matched = read.select(*df.columns, F.col("_read.n").alias("word_count"), F.col("_read.hits").alias("_hits"))
    letters = F.length(F.regexp_replace(F.lower(message), rf"[{text.BLANK}]+", ""))
    toxic, positive = (text.count_in("_hits", entries) for entries in lists)
    return matched.select(
        *df.columns,
        scores.char_count(message).alias("char_count"),
        "word_count",
        fixed(scores.average_length(letters, "word_count"), 2).alias("avg_word_length"),
        fixed(scores.punctuation_ratio(message), 4).alias("punctuation_ratio"),
        fixed(scores.uppercase_ratio(message), 4).alias("uppercase_ratio"),
        toxic.alias("toxic_word_count"),
        positive.alias("positive_word_count"),
        F.coalesce(scores.occurrences(message, "!"), F.lit(0)).alias("exclamation_count"),
        F.coalesce(scores.occurrences(message, "?"), F.lit(0)).alias("question_count"),
        fixed(scores.lexical_score(toxic, positive, "word_count"), 4).alias("lexical_score"),
    )


def rule_stage(df: DataFrame, message: str, out: str = "toxicity_score") -> DataFrame:
    """Add the rule score of a text that has not been through the feature stage."""
    words = text.tokens_sql(f"lower(`{message}`)")
    read = computed_once(df, {"_read": text.token_summary(words, values.SEVERE_WORDS, values.MODERATE_WORDS)})
    matched = read.select(*df.columns, F.col("_read.hits").alias("_hits"))
    return matched.select(*df.columns, scores.rule_score(message, "_hits").alias(out))


def score_stage(df: DataFrame, threshold: float = 0.5, cleaned: str = "cleaned_message") -> DataFrame:
    """Add toxicity score and label, sentiment and its score."""
    if "lexicon_hits" in df.columns:
        scored = df.select("*", scores.rule_score(cleaned, "lexicon_hits").alias("toxicity_score"))
    else:
        scored = rule_stage(df, cleaned)
    return scored.select(
        "*",
        scores.toxicity_label("toxicity_score", threshold).alias("label"),
        scores.is_toxic("toxicity_score", threshold).alias("is_toxic"),
        scores.sentiment("lexical_score").alias("sentiment"),
        scores.sentiment_score("lexical_score").alias("sentiment_score"),
    )


def analyse(df: DataFrame, message: str = "message", threshold: float = 0.5) -> DataFrame:
    """The three stages in one plan."""
    return score_stage(feature_stage(clean_stage(df, message), message), threshold)


# --- records of the hops ---------------------------------------------------------------------


def cleaned_record(df: DataFrame) -> DataFrame:
    return clean_stage(df).select(
        "source", "post_id", "comment_id", F.col("user").alias("username"),
        F.col("message").alias("original_message"), "cleaned_message", "created_time",
        F.current_timestamp().alias("processing_time"),
    )


def feature_record(df: DataFrame) -> DataFrame:
    kept = ["source", "post_id", "comment_id", "username", "original_message", "cleaned_message", "created_time"]
    built = feature_stage(df.select(*kept), "original_message")
    return built.select(
        *kept, "char_count", "word_count", "avg_word_length", "lexical_score", "toxic_word_count",
        "positive_word_count", "uppercase_ratio", F.current_timestamp().alias("feature_extraction_time"),
    )


def prediction_record(scored: DataFrame) -> DataFrame:
    return scored.select(
        "comment_id", "toxicity_score", "label", "is_toxic", "sentiment", "sentiment_score",
        F.current_timestamp().alias("prediction_time"),
    )


def result_record(scored: DataFrame, created_time=None, ingestion_time=None) -> DataFrame:
    """Row of the result table; ``created_time`` is parsed from text unless a column is given."""
    created = safe_timestamp("created_time") if created_time is None else created_time
    ingested = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else ingestion_time
    return scored.select(
        "post_id", "comment_id", "username", F.col("original_message").alias("comment"),
        F.col("cleaned_message").alias("cleaned_comment"), "toxicity_score", "label", "is_toxic",
        "sentiment", "sentiment_score", "word_count", "char_count",
        created.alias("created_time"), ingested.alias("ingestion_time"),
    )


def quick_record(df: DataFrame, ingestion_time=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows of the quick path: substring scorers on the raw text, no feature hop. Columns ``keep`` stay beside them."""
    counted = df.select(
        "*", text.token_count("message").alias("word_count"), F.length("message").alias("char_count"),
        scores.substring_hits("message", values.QUICK_POSITIVE).alias("_positive"),
        scores.substring_hits("message", values.QUICK_NEGATIVE).alias("_negative"),
        scores.substring_hits("message", values.QUICK_TOXIC).alias("_toxic"),
    ).withColumn("_ratio", scores.quick_ratio("_toxic", "word_count"))
    toxic, clean = values.LABELS
    ingested = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else ingestion_time
    return counted.select(
        *keep, "post_id", "comment_id", F.col("user").alias("username"), F.col("message").alias("comment"),
        text.clean_text_quick("message").alias("cleaned_comment"),
        scores.quick_score("_ratio").alias("toxicity_score"),
        F.when(scores.quick_is_toxic("_ratio"), toxic).otherwise(clean).alias("label"),
        scores.quick_is_toxic("_ratio").alias("is_toxic"),
        scores.quick_sentiment("_positive", "_negative").alias("sentiment"),
        scores.quick_sentiment_score("_positive", "_negative").alias("sentiment_score"),
        "word_count", "char_count", F.col("created_time"), ingested.alias("ingestion_time"),
    )


def minimal_record(df: DataFrame, ingestion_time=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows of the minimal path: one flag decides fixed scores. Columns ``keep`` stay beside them."""
    toxic, clean = values.LABELS
    ingested = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else ingestion_time
    flagged = df.select("*", scores.minimal_flag("message").alias("is_toxic"))
    return flagged.select(
        *keep, "post_id", "comment_id", F.col("user").alias("username"), F.col("message").alias("comment"),
        text.clean_text_minimal("message").alias("cleaned_comment"),
        F.when(F.col("is_toxic"), 0.8).otherwise(0.1).alias("toxicity_score"),
        F.when(F.col("is_toxic"), toxic).otherwise(clean).alias("label"),
        "is_toxic",
        F.when(F.col("is_toxic"), "negative").otherwise("neutral").alias("sentiment"),
        F.when(F.col("is_toxic"), 0.2).otherwise(0.5).alias("sentiment_score"),
        text.token_count("message").alias("word_count"), F.length("message").alias("char_count"),
        F.col("created_time"), ingested.alias("ingestion_time"),
    )
