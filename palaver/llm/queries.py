"""One query per operator over its whole table; the SQL of those that SQL can express is in ``checks``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import (
    anomaly, bayes, bpe, centroids, html_text, license_scan, markov, maxscore, mixing, near_copies, piece_table, sharding, substrings)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """Place of the public rank file, as a path that Spark reads from the driver's machine or a shared one."""
    import public_tokenizers

    return "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")


def piece_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.rendezvous_shards(table(spark, sf_dir, "documents"), shards=24)


def op2_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host="source", path="lang")


def op3_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.pivotal_mix(table(spark, sf_dir, "documents"))
    return mixing.taken_words(mix).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.scores(table(spark, sf_dir, "documents"))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies.near_duplicates(table(spark, sf_dir, "documents"), percent=near_copies.OP5_PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(spark, vocabulary_path())
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, piece_pattern(), keep=["doc_id"], with_ids=False)


def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False)


def op9_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"))


def op10_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.written_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    forest, limit = anomaly.fit(stats, table(spark, sf_dir, "labels"))
    return anomaly.judged(stats, forest, limit)


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"], with_output=False)


def op12_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op13_hadamard_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_rendezvous_shards, op2_site_bayes, op3_pivotal_mix, op4_hidden_markov, op5_chosen_path,
    op6_boosted_dom, op7_byte_bpe, op8_repeated_windows, op9_maxscore, op10_isolation_rules,
    op11_piece_table, op12_license_join, op13_hadamard_centroids)}
