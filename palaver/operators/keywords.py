"""Keywords per comment and trending keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver import values
from palaver.functions.once import computed_once
from palaver.functions.text import kept_words_sql, literal, term_counts


def keyword_tokens_sql(cleaned: str, min_length: int = 3, stopwords=values.STOPWORDS) -> str:
    """Tokens of a cleaned text without edge punctuation, long enough and not stopwords."""
    edges = literal(r"(?<![^ ])[.,!?']+|[.,!?']+(?![^ ])")
    bare = f"split(regexp_replace(coalesce(`{cleaned}`, ''), {edges}, ''), ' ')"
    return kept_words_sql(bare, stopwords, min_length)


def comment_keywords(df: DataFrame, cleaned: str = "cleaned_comment", limit: int = 10, min_length: int = 3,
                     stopwords=values.STOPWORDS) -> DataFrame:
    """Add ``keywords``: the most frequent keyword tokens of each comment, ties by word.

    Counted and ranked inside the row: no shuffle, whatever the length of the comments.
    """
    kept = [c for c in df.columns if c != "keywords"]
    terms = term_counts(keyword_tokens_sql(cleaned, min_length, stopwords))
    ranked = F.sort_array(F.transform(terms, lambda t: F.struct((-t["n"]).alias("r"), t["term"].alias("w"))))
    words = F.transform(F.slice(ranked, 1, limit), lambda t: t["w"])
    return computed_once(df.select(*kept), {"keywords": words})


def trending(df: DataFrame, keywords: str = "keywords", ts: str = "ingestion_time") -> DataFrame:
    """Per keyword: occurrences, mean sentiment and toxicity and of how many scores, first and last time seen.

    A keyword listed twice in one comment counts twice. Sums are combined within each task first.
    """
    return (
        df.select(F.explode(keywords).alias("keyword"), "sentiment_score", "toxicity_score", F.col(ts).alias("_ts"))
        .groupBy("keyword")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("sentiment_score").alias("sentiment_avg"),
            F.avg("toxicity_score").alias("toxicity_avg"),
            F.count("sentiment_score").alias("sentiment_n"),
            F.count("toxicity_score").alias("toxicity_n"),
            F.max("_ts").alias("last_updated"),
            F.min("_ts").alias("first_seen"),
        )
    )


def merge_trending(existing: DataFrame, update: DataFrame) -> DataFrame:
    """Fold a new aggregate into the stored one: counts add up, means are weighted by the scores they are of."""
    both = existing.unionByName(update)

    def mean(name, n):
        return (F.sum(F.col(name) * F.col(n)) / F.nullif(F.sum(n), F.lit(0))).alias(name)
    return both.groupBy("keyword").agg(
        F.sum("count").alias("count"),
        mean("sentiment_avg", "sentiment_n"),
        mean("toxicity_avg", "toxicity_n"),
        F.sum("sentiment_n").alias("sentiment_n"),
        F.sum("toxicity_n").alias("toxicity_n"),
        F.max("last_updated").alias("last_updated"),
        F.min("first_seen").alias("first_seen"),
    )


def top_keywords(trending_table: DataFrame, limit: int = 20) -> DataFrame:
    return trending_table.select("keyword", "count").orderBy(F.col("count").desc(), "keyword").limit(limit)


