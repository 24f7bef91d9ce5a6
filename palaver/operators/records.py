"""Message envelopes, record shaping, first-seen rows and page unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from palaver import values


def decode_envelope(df: DataFrame, schema: StructType) -> DataFrame:
    """``(key, value, timestamp)`` messages to flat columns; a malformed value gives NULL fields."""
    return df.select(
        F.col("key").cast("string").alias("comment_id_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("broker_timestamp"),
    ).select("comment_id_key", "data.*", "broker_timestamp")


def encode_envelope(df: DataFrame, key: str = "comment_id", fields=None) -> DataFrame:
    """Rows to ``(key, value)`` messages. NULL fields are left out of the JSON text."""
    names = fields or df.columns
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*names)).alias("value"))


def shape_api_record(df: DataFrame, record: str, post_id="post_id", source: str = "facebook") -> DataFrame:
    """Nested API records (a struct column) to raw records with the missing fields filled."""
    field = F.col(record)
    return df.select(
        F.lit(source).alias("source"),
        F.col(post_id).alias("post_id"),
        F.coalesce(field["id"], F.lit("")).alias("comment_id"),
        F.coalesce(field["from"]["name"], F.lit("Unknown")).alias("user"),
        F.coalesce(field["message"], F.lit("")).alias("message"),
        field["created_time"].alias("created_time"),
        F.coalesce(field["like_count"], F.lit(0)).alias("like_count"),
    )


def drop_blank_messages(df: DataFrame, message: str = "message") -> DataFrame:
    return df.filter(F.coalesce(F.col(message), F.lit("")) != "")


def topic_of(stage: Column, default: str = values.STAGE_TOPICS["raw"]) -> Column:
    """Stream name of a stage, the raw stream for an unknown one."""
    names = F.create_map(*[F.lit(x) for pair in values.STAGE_TOPICS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, stage), F.lit(default))


def union_pages(*pages: DataFrame) -> DataFrame:
    """All rows of all pages, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), pages)


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``.

    An aggregate, not a ranked window: copies of a hot key are reduced to one row per task before
    the shuffle, so a key that holds a third of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def first_texts(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """``first_seen`` of whole texts: grouped by their SHA-256, the texts themselves fetched at the end.

    ``order`` has to tell rows apart. Only the hash and ``order`` go through the grouping; the rows
    chosen are then joined to the texts where they are read. A null text is a text of its own.
    """
    at = F.struct(*order)
    named = df.withColumn("_hash", F.sha2(F.col(text), 256)).withColumn("_at", at)
    chosen = named.groupBy("_hash").agg(F.min("_at").alias("_at")).select(F.col("_at").alias("_chosen"))
    return named.join(chosen, named["_at"].eqNullSafe(chosen["_chosen"]), "left_semi").select(*df.columns)
