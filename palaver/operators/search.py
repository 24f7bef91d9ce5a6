"""Term search over comments: direct, and through a posting table.

Terms are lower-case word runs without stopwords. They are not stemmed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from palaver import values
from palaver.functions.once import computed_once
from palaver.functions.scalars import as_column
from palaver.functions.text import WORD, kept_words_sql, words_sql


def with_terms(df: DataFrame, text: str, out: str = "terms", stopwords=values.STOPWORDS) -> DataFrame:
    """Add the distinct search terms of a text as an array."""
    words = kept_words_sql(words_sql(f"lower(`{text}`)", f"[{WORD}]+"), stopwords)
    return computed_once(df, {out: F.array_distinct(F.expr(words))})


def _normal(terms, stopwords=values.STOPWORDS) -> list[str]:
    """Query terms as they stand in texts: lower-case, stopwords ignored."""
    return [t.lower() for t in terms if t.lower() not in stopwords]


def matches(terms, all_of=(), any_of=(), none_of=()) -> Column:
    """AND, OR and NOT of terms over a term array. A query that wants stopwords only matches nothing."""
    terms, wanted = as_column(terms), [*_normal(all_of), *_normal(any_of)]
    if (all_of or any_of) and not wanted:
        return F.lit(False)
    tests = [F.array_contains(terms, t) for t in _normal(all_of)]
    if _normal(any_of):
        tests.append(F.arrays_overlap(terms, F.array(*[F.lit(t) for t in _normal(any_of)])))
    tests += [~F.array_contains(terms, t) for t in _normal(none_of)]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def search(df: DataFrame, text: str, all_of=(), any_of=(), none_of=()) -> DataFrame:
    """Matching rows by one scan, without a shuffle.

    The wanted terms are first looked for as plain substrings, which rejects most rows before any
    text is split into terms; a hit is then confirmed on the terms.
    """
    lowered = F.lower(text)
    for term in _normal(all_of):
        df = df.filter(lowered.contains(term))
    if _normal(any_of):
        df = df.filter(reduce(lambda a, b: a | b, [lowered.contains(t) for t in _normal(any_of)]))
    return with_terms(df, text, "_terms").filter(matches("_terms", all_of, any_of, none_of)).drop("_terms")


def posting_table(df: DataFrame, text: str, key: str = "comment_id") -> DataFrame:
    """``(term, key)`` once per term of each comment; distinct within the row, so no shuffle."""
    return with_terms(df, text, "_terms").select(F.explode("_terms").alias("term"), key)


def write_postings(postings: DataFrame, path: str, buckets: int = 256) -> None:
    """Store postings by term hash, so a query reads only the folders of its terms.

    Rows are dealt by ranges of bucket, term and key: a list takes as many tasks as its length needs.
    """
    placed = postings.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    spread = placed.repartitionByRange("bucket", "term", *[c for c in postings.columns if c != "term"])
    spread.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_postings(spark, path: str, terms, buckets: int = 256) -> DataFrame:
    """The stored lists of the given terms; folders of other buckets are not read."""
    wanted = _normal(terms)
    # constants, which the optimiser folds: the folders are known when the files are listed
    folders = [F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)).cast("int") for t in wanted]
    return spark.read.parquet(path).filter(F.col("bucket").isin(*folders) & F.col("term").isin(wanted)).drop("bucket")


def search_postings(postings: DataFrame, key: str, all_of=(), any_of=(), none_of=()) -> DataFrame:
    """Keys whose terms satisfy the query, from the posting table alone.

    Only the lists of the query's terms are read. The flags are combined per key within each task.
    A query needs at least one wanted term: a pure NOT has no list to start from.
    """
    all_of, any_of, none_of = _normal(all_of), _normal(any_of), _normal(none_of)
    if not (all_of or any_of):
        raise ValueError("give at least one wanted term")
    term = F.col("term")
    lists = postings.filter(term.isin(*all_of, *any_of, *none_of))

    def seen(t):
        return F.bool_or(term == t)
    tests = [seen(t) for t in all_of] + [~seen(t) for t in none_of]
    if any_of:
        tests.append(F.bool_or(term.isin(any_of)))
    return lists.groupBy(key).agg(reduce(lambda a, b: a & b, tests).alias("_hit")).filter("_hit").select(key)
