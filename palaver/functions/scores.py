"""Lexical features, rule scores, sentiment and write-time labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from palaver import values
from palaver.functions.scalars import as_column, clamp, fixed
from palaver.functions.text import BLANK, count_in


def occurrences(text, sign: str) -> Column:
    """How often a one-character sign occurs."""
    text = as_column(text)
    return F.length(text) - F.length(F.translate(text, sign, ""))


def char_count(text) -> Column:
    return F.coalesce(F.length(as_column(text)), F.lit(0))


def average_length(n_letters, n_words) -> Column:
    """Mean token length, 0 without tokens."""
    n_letters, n_words = as_column(n_letters), as_column(n_words)
    return F.when(n_words > 0, n_letters / n_words).otherwise(F.lit(0.0))


def uppercase_ratio(text) -> Column:
    text = as_column(text)
    upper = F.length(F.regexp_replace(text, r"[^\p{IsUppercase}]+", ""))
    return F.when(F.length(text) > 0, upper / F.length(text)).otherwise(F.lit(0.0))


def punctuation_ratio(text) -> Column:
    text = as_column(text)
    rest = F.length(F.translate(text, values.FEATURE_PUNCTUATION, ""))
    return F.when(F.length(text) > 0, (F.length(text) - rest) / F.length(text)).otherwise(F.lit(0.0))


def lexical_score(toxic, positive, n_words) -> Column:
    """``(2 toxic - positive) / words`` held to [-1, 1]; 0 without words."""
    toxic, positive, n_words = as_column(toxic), as_column(positive), as_column(n_words)
    score = (toxic * 2 - positive) / F.greatest(n_words, F.lit(1))
    return F.when(n_words > 0, clamp(score, -1.0, 1.0)).otherwise(F.lit(0.0))


def rule_score(text, words: str, severe_words=values.SEVERE_WORDS, moderate_words=values.MODERATE_WORDS) -> Column:
    """Rule toxicity: word severities, then bonuses for shouting and for more than two ``!``.

    ``words`` are the tokens of the text, or only those in the lists; a blank text scores 0.
    """
    text = as_column(text)
    severe, moderate = count_in(words, severe_words), count_in(words, moderate_words)
    base = F.least(severe * 0.5 + moderate * 0.25, F.lit(0.95))
    shouting = F.when((text != F.lower(text)) & (uppercase_ratio(text) > 0.5), 0.1).otherwise(0.0)
    excited = F.when(occurrences(text, "!") > 2, 0.05).otherwise(0.0)
    score = F.least(fixed(base + shouting + excited, 4), F.lit(1.0))
    return F.when(text.rlike(f"[^{BLANK}]"), score).otherwise(F.lit(0.0))


def is_toxic(score, threshold: float = 0.5) -> Column:
    return F.coalesce(as_column(score) >= threshold, F.lit(False))


def toxicity_label(score, threshold: float = 0.5) -> Column:
    toxic, clean = values.LABELS
    return F.when(is_toxic(score, threshold), toxic).otherwise(clean)


def sentiment(lexical) -> Column:
    x = as_column(lexical)
    return F.when(x > 0.05, "negative").when(x < -0.05, "positive").otherwise("neutral")


def sentiment_score(lexical) -> Column:
    x = as_column(lexical)
    return (
        F.when(x > 0.05, F.greatest(F.lit(0.1), 0.5 - x))
        .when(x < -0.05, F.least(F.lit(0.9), 0.5 + F.abs(x)))
        .otherwise(F.lit(0.5))
    )


# --- quick scorers: substring hits on raw text ------------------------------------------------


def substring_hits(text, entries) -> Column:
    """How many of the entries occur anywhere in the lower-cased text, each counted once."""
    lowered = F.lower(as_column(text))
    total = F.lit(0)
    for entry in entries:
        total = total + lowered.contains(entry).cast("int")
    return total


def quick_ratio(hits, n_words) -> Column:
    return as_column(hits) / F.greatest(as_column(n_words), F.lit(1))


def quick_is_toxic(ratio, threshold: float = 0.1) -> Column:
    return as_column(ratio) > threshold


def quick_score(ratio) -> Column:
    return F.least(as_column(ratio) * 2, F.lit(1.0))


def quick_sentiment(positive, negative) -> Column:
    positive, negative = as_column(positive), as_column(negative)
    return F.when(positive > negative, "positive").when(negative > positive, "negative").otherwise("neutral")


def quick_sentiment_score(positive, negative) -> Column:
    positive, negative = as_column(positive), as_column(negative)
    return F.when(positive > negative, 0.7).when(negative > positive, 0.3).otherwise(0.5)


def minimal_flag(text, entries=values.MINIMAL_TOXIC) -> Column:
    lowered = F.lower(as_column(text))
    return reduce(lambda a, b: a | b, [lowered.contains(e) for e in entries], F.lit(False))
