"""TF-IDF, vocabulary, padded sequences and word vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from palaver import session
from palaver.functions.scalars import as_column
from palaver.functions.text import WORD, literal, term_counts, words_sql

# Signs that separate words for the vocabulary; apostrophes stay inside words.
SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def tfidf_tokens(text: str) -> str:
    """Lower-case runs of at least two word characters, as SQL text."""
    return words_sql(f"lower(`{text}`)", f"[{WORD}]{{2,}}")


def vocabulary_tokens(text: str) -> str:
    """Lower-case words between separators, as SQL text."""
    blanks = literal(" " * len(SEPARATORS))
    spaced = f"translate(lower(coalesce(`{text}`, '')), {literal(SEPARATORS)}, {blanks})"
    return f"filter(split({spaced}, ' '), w -> w <> '')"


def counted(df: DataFrame, key: str, words: str) -> DataFrame:
    """``(key, terms)``: each text once, as the array ``<term, n>`` of its distinct tokens (``words`` as SQL text)."""
    return df.select(key, term_counts(words).alias("terms"))


def placed(df: DataFrame, key: str, words: str) -> DataFrame:
    """``(key, terms)``: each text once, as the array of its tokens in text order (``words`` as SQL text)."""
    return df.select(key, F.expr(words).alias("terms"))


def idf_of(lists: DataFrame) -> DataFrame:
    """``(term, df, idf)`` of counted texts, with ``idf = ln((1 + n) / (1 + df)) + 1``."""
    n_texts = lists.count()
    counts = lists.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.select("term", "df", (F.log((1 + n_texts) / (1 + F.col("df"))) + 1).alias("idf"))


def fit_idf(df: DataFrame, key: str, text: str) -> DataFrame:
    return idf_of(counted(df, key, tfidf_tokens(text)))


def weights(lists: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """``(key, term, n, tfidf)`` of counted texts with unit length per text. Terms the fit has not seen are dropped.

    The join is left to the engine: it broadcasts the term table when its measured size allows
    and otherwise shuffles by term, splitting the partitions of very common terms. A text is
    already one row, so the window that takes its length holds no more than that row did.
    """
    weighted = lists.select(key, F.inline("terms")).join(idf.select("term", "idf"), "term")
    weighted = weighted.withColumn("_w", F.col("n") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "n", (F.col("_w") / length).alias("tfidf"))


def tfidf(df: DataFrame, idf: DataFrame, key: str, text: str) -> DataFrame:
    """``weights`` of texts that are tokenised here."""
    return weights(counted(df, key, tfidf_tokens(text)), idf, key)


def global_rank(df: DataFrame, order, rank: str = "index") -> DataFrame:
    """Add the 1-based position in a total order without pulling all rows into one task.

    The rows are range-sorted once and checkpointed, which fixes their partitions; a row's rank is
    its position in its partition plus the sizes of the partitions before. Only those sizes, one
    row per partition, go through a window in a single task.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(session.shared_folder(spark))
    placed = df.orderBy(*order).checkpoint().withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_at") - F.shiftleft("_part", 33)
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + position + 1).alias(rank))


def vocabulary_of(lists: DataFrame, size: int | None = None) -> DataFrame:
    """``(word, n, index)`` of placed texts: words by falling frequency from 1, ties by word.

    With ``size`` only the most frequent words are kept and numbered.
    """
    totals = lists.select(F.explode("terms").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("word")]
    if size is not None:
        totals = totals.orderBy(*order).limit(size)
    return global_rank(totals, order)


def fit_vocabulary(df: DataFrame, text: str, size: int | None = None) -> DataFrame:
    return vocabulary_of(df.select(F.expr(vocabulary_tokens(text)).alias("terms")), size)


def _in_head(words: list[str], numbers: list[int]):
    """Mapper of ``(key, terms)``: ``coded`` has place and number, in one integer, of each token among ``words``, ``rare`` the others."""
    wanted, number = pa.array(words, pa.string()), np.array([*numbers, 0], np.int64)

    def run(incoming):
        for batch in incoming:
            terms, n = batch.column(1), batch.num_rows
            flat, sizes = terms.flatten(), np.diff(terms.offsets.to_numpy())
            row = np.repeat(np.arange(n), sizes)
            at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            code = number[pc.fill_null(pc.index_in(flat, value_set=wanted.cast(flat.type)), -1).to_numpy(zero_copy_only=False)]
            found, rare = code > 0, (code == 0) & pc.is_valid(flat).to_numpy(zero_copy_only=False)

            def lists(own: np.ndarray, values: pa.Array) -> pa.Array:
                ends = np.append(0, np.cumsum(np.bincount(row[own], minlength=n)))
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            others = pa.StructArray.from_arrays([flat.filter(pa.array(rare)), pa.array(at[rare], pa.int64())], names=["term", "at"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(found, pa.array(at[found] << 32 | code[found], pa.int64())), lists(rare, others)], names=["key", "coded", "rare"])
    return run


def codes(lists: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """``(key, codes)``: each placed text as the numbers of its words in text order, unknown words dropped.

    The ``session.HEAD_RANKS`` most frequent words of bounded length go to every task and are looked up in the row, so they never
    move as words and are never listed anew. Only rarer ones meet their numbers by shuffle, and come back to their text as place and
    number in one integer. ``key`` should be unique: texts of one key are merged. ``vocabulary`` is read twice and should be written.
    """
    numbered = vocabulary.select(F.col("word").alias("term"), F.col("index").cast("int").alias("code"))
    in_head = (F.col("code") <= session.HEAD_RANKS) & (F.octet_length("term") <= session.LONGEST_HEAD_KEY)
    head = numbered.filter(in_head).collect()
    form = StructType([lists.schema[key], *StructType.fromDDL("coded array<bigint>, rare array<struct<term: string, at: bigint>>")])
    halves = session.written(lists.select(key, "terms").mapInArrow(_in_head([r.term for r in head], [r.code for r in head]), form), "looked-up")
    rare = halves.select(key, F.expr("inline(rare)")).join(numbered.filter(~in_head), "term")
    rare = rare.select(key, F.array(F.shiftleft("at", 32).bitwiseOR(F.col("code").cast("bigint"))).alias("coded"))
    # dealt by key first: summing up within the tasks before would hold a list for each text and shrink nothing
    whole = halves.select(key, "coded").unionByName(rare).repartition(key).groupBy(key).agg(F.flatten(F.collect_list("coded")).alias("coded"))
    return whole.select(key, F.expr("transform(sort_array(coded), c -> cast(c & 4294967295 AS int))").alias("codes"))


def pad(sequence, length: int, padding: str = "post", truncating: str = "post") -> Column:
    """Cut or zero-fill an int array to ``length`` at its end (post) or its start (pre)."""
    sequence = as_column(sequence)
    if truncating == "post":
        cut = F.slice(sequence, 1, length)
    else:
        cut = F.slice(sequence, F.greatest(F.size(sequence) - length + 1, F.lit(1)), F.lit(length))
    missing = F.greatest(F.lit(length) - F.size(sequence), F.lit(0))
    fill = F.array_repeat(F.lit(0), missing)
    return F.concat(cut, fill) if padding == "post" else F.concat(fill, cut)


def sequences(df: DataFrame, vocabulary: DataFrame, key: str, text: str, length: int = 20,
              padding: str = "post", truncating: str = "post") -> DataFrame:
    """``(key, sequence)``: word numbers in text order, unknown words dropped, fixed length.

    A text without a known word gives zeros. Texts that are coded already need only ``pad``.
    """
    coded = codes(placed(df, key, vocabulary_tokens(text)), vocabulary, key)
    return coded.select(key, pad("codes", length, padding, truncating).alias("sequence"))


def embedding_matrix(vocabulary: DataFrame, vectors: DataFrame, dim: int, key: str = "word") -> DataFrame:
    """``(word, index, vector)``: the vector of each vocabulary word, zeros when it has none."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    joined = vocabulary.join(vectors.select(key, "vector"), key, "left")
    return joined.select("word", "index", F.coalesce("vector", zeros).alias("vector"))


def mean_of_codes(coded: DataFrame, matrix: DataFrame, key: str, dim: int) -> DataFrame:
    """``(key, vector)``: mean vector of the coded words of each text, repeats counted; texts without a word are left out.

    Numbers are counted inside the row. Those up to ``session.HEAD_RANKS`` meet the broadcast head of the matrix, the others the rest by
    shuffle. One sum per dimension is a plain hash aggregate: each task sends one row per text, not one
    vector per word. Texts and matrix are read by both parts and should be written.
    """
    numbers = coded.select(key, F.inline(term_counts("codes"))).withColumnRenamed("term", "index")
    vectors = matrix.select("index", "vector")
    in_head = F.col("index") <= session.HEAD_RANKS
    known = numbers.filter(in_head).join(F.broadcast(vectors.filter(in_head)), "index").unionByName(
        numbers.filter(~in_head).join(vectors.filter(~in_head), "index"))
    sums = [F.expr(f"sum(n * cast(get(vector, {i}) AS double))").alias(f"_s{i}") for i in range(dim)]
    totals = known.groupBy(key).agg(F.sum("n").alias("_n"), *sums)
    return totals.select(key, F.expr(f"array({', '.join(f'_s{i} / _n' for i in range(dim))})").alias("vector"))


def mean_embedding(df: DataFrame, matrix: DataFrame, key: str, text: str, dim: int) -> DataFrame:
    """``mean_of_codes`` of texts that are tokenised and coded here."""
    coded = session.written(codes(placed(df, key, vocabulary_tokens(text)), matrix, key), "codes")
    return mean_of_codes(coded, matrix, key, dim)
