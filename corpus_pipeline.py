"""From documents to tokens: quality rules, near-duplicates, repeated passages, mixture, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it kept. The
last returns the tokens; the others return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import anomaly, bpe, mixing, near_copies, queries, substrings
from palaver.session import bound_batches, written

#: SQL has no form for the forest and the random mixture; tests compare the stages with brute force.
ORACLE_SQL = None


def bounded(stage):
    """The stage with batches of a few MB between Spark and Python."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@bounded
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest accept."""
    return anomaly.accepted_rows(docs, queries.table(spark, sf_dir, "labels"))


@bounded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return near_copies.one_per_group(docs, percent=near_copies.PERCENT)


@bounded
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand anywhere else as well."""
    return substrings.without_repeats(docs)


@bounded
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share takes them."""
    return mixing.mixed_rows(docs, mixing.pivotal_mix(docs))


@bounded
def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids`` of each taken document."""
    ranks = bpe.load_ranks(spark, queries.vocabulary_path())
    return bpe.encode(docs, ranks, queries.piece_pattern(), keep=["doc_id", "lang", "source"])


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("substring dedup", substring_dedup),
          ("mix sources", mix_sources), ("encode tokens", encode_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what goes from one to the next is written to the shared folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
