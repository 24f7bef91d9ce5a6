"""Labelled corpora: joins, label statistics, preparation and cleaning of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver import values
from palaver.functions.once import computed_once
from palaver.functions.scalars import fixed
from palaver.functions.text import drop_punctuation, drop_stopwords, expand_abbreviations, long_tokens, substitute


def join_labels(comments: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    return comments.join(labels, key, "inner")


def used_rows(df: DataFrame, label: str = "toxic") -> DataFrame:
    """Drop the rows marked as unused (-1)."""
    return df.filter(F.col(label) >= 0)


def label_prevalence(df: DataFrame, labels=values.TOXICITY_LABELS) -> DataFrame:
    """Per label: rows with a label, positive rows and their share in percent; one pass over all."""
    total = F.count(labels[0])
    sums = df.agg(total.alias("_rows"), *[F.sum(c).cast("bigint").alias(c) for c in labels])
    return sums.unpivot(["_rows"], list(labels), "label", "positives").select(
        "label", F.col("_rows").alias("labelled_rows"), "positives",
        fixed(F.try_divide(F.col("positives"), F.col("_rows")) * 100, 3).alias("percentage"),
    )


def prepare(df: DataFrame, text: str = "comment_text", strict: bool = False, stopwords=values.STOPWORDS,
            abbreviations=values.ABBREVIATIONS) -> DataFrame:
    """Prepare the text column, then drop rows left without text.

    Substitutions, punctuation, tokens of three characters, stopwords, abbreviations. ``strict``
    also turns every other blank string into NULL, as is done for test data. The empty rows go by
    an exploded filter, so that the long substitution chain is not planned twice.
    """
    kept = []
    for field in df.schema.fields:
        if field.name != text:
            blank_is_null = strict and field.dataType.typeName() == "string"
            kept.append(F.nullif(F.col(field.name), F.lit("")).alias(field.name) if blank_is_null else field.name)
    words = long_tokens(drop_punctuation(substitute(text)))
    names = [c for c in df.columns if c != text]
    split = computed_once(df, {"_words": words}).select(*kept, "_words")
    lowered = split.select(*names, drop_stopwords("_words", stopwords).alias("_words"))
    prepared = F.filter(F.array(expand_abbreviations("_words", abbreviations)), lambda t: t != "")
    return lowered.select(*names, F.explode(prepared).alias(text)).select(*df.columns)


def split_columns(df: DataFrame, text: str = "comment_text", drop=("id",)) -> tuple[DataFrame, DataFrame]:
    """Text frame and label frame."""
    rest = df.drop(*drop)
    return rest.select(text), rest.drop(text)


def held_out(key: str, parts: int = 5) -> Column:
    """One part in ``parts`` of the rows, by the MD5 of their key: the same in every run and engine."""
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % parts == 0
