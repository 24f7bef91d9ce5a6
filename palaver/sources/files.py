"""File sources and sinks: tables, labelled corpora, word vectors, parameterised scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from palaver import schemas, session

TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "quote": '"', **TIMES}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_results(df: DataFrame, path: str, ts: str = "ingestion_time", mode: str = "append") -> None:
    """Append scored rows to the result table, in a folder per ingestion day.

    A task keeps files of several days open instead of sorting its texts by day, and a join with narrow rows, such as events, hashes
    these where they are few enough instead of sorting the texts.
    """
    spark = df.sparkSession
    with (session.setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(session.OPEN_FILES)),
          session.setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", session.MOST_HASHED)):
        dated = df.withColumn("ingestion_day", F.to_date(ts))
        dated.write.mode(mode).option("compression", session.TEXT_CODEC).partitionBy("ingestion_day").parquet(path)


def read_results(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """The result table, or only its folders of the days from ``since`` to ``until`` (columns or dates, both inclusive)."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.filter(F.col("ingestion_day") >= F.to_date(since))
    if until is not None:
        rows = rows.filter(F.col("ingestion_day") <= F.to_date(until))
    return rows


def read_csv(spark: SparkSession, path: str, schema: StructType = schemas.CORPUS) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; the schema is always declared.

    A quoted line break keeps a file in one task, so a large corpus should come as many files.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV without an index column; each task writes its own file."""
    df.write.mode(mode).options(header=True, escape='"', quote='"', **TIMES).csv(path)


def read_word_vectors(spark: SparkSession, path: str, dim: int = 100) -> DataFrame:
    """``word v1 .. vn`` lines to ``(word, vector)``. Values that are no numbers give NULL elements."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        F.element_at(parts, 1).alias("word"),
        F.transform(F.slice(parts, 2, dim), lambda v: v.try_cast("float")).alias("vector"),
    )


def write_word_vectors(df: DataFrame, path: str, word: str = "word", vector: str = "vector") -> None:
    numbers = F.array_join(F.transform(vector, lambda v: v.cast("string")), " ")
    df.select(F.concat_ws(" ", F.col(word), numbers).alias("value")).write.text(path)


def query(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **parameters) -> DataFrame:
    """SQL text with bound parameters (``:name``), never pasted into the text."""
    return spark.sql(text, args=parameters, **(tables or {}))
