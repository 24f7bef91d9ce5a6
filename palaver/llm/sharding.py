"""Rendezvous hashing of record keys over weighted shards, in native expressions only.

Each shard draws a number from the key; with ``u`` uniform in (0, 1) the shard with the largest
``-weight / ln(u)`` wins, so a shard gets rows in proportion to its weight. A new shard changes no
other shard's number: it only takes the rows it wins. The numbers come from MD5, so that the
placement is the same in any engine and release. The key alone decides, nothing is shuffled.

Edge cases: a null key is one key of its own, equal keys share a shard; a null text has no bytes;
an empty table gives no rows; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OVERHEAD_BYTES = 8
SLOT_CELLS = 4096
DIGITS = 13  # hex digits of a draw: 52 bits are exact in a double


def draw(key: Column, shard: int) -> Column:
    """Uniform in (0, 1), from the key and the shard's number."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}")))
    whole = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**DIGITS))


def score(key: Column, shard: int, weight: float) -> Column:
    return F.lit(-float(weight)) / F.log(draw(key, shard))


def best_shard(key: Column, weights: list[float]) -> Column:
    """Number of the winning shard, with its score: a struct ``(score, shard)``."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    return F.array_max(F.array(*[
        F.struct(score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]))


def placements(df: DataFrame, key: str, text: str, weights: list[float]) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, grown_shard)`` per row; the key's column is called ``doc_id``.

    ``grown_shard`` is the shard once one more of weight 1 is added.
    """
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    narrow = df.select(F.col(key).alias("doc_id"),
                       (F.octet_length(data) + OVERHEAD_BYTES).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    won = narrow.withColumn("_won", best_shard(F.col("doc_id"), weights))
    grown = F.when(score(F.col("doc_id"), len(weights), 1.0) > F.col("_won.score"), F.lit(len(weights)))
    return won.select("doc_id", "size", "text_crc32", F.col("_won.shard").alias("shard"),
                      F.coalesce(grown, F.col("_won.shard")).alias("grown_shard"))


def cell() -> Column:
    """Part of a shard in which rows are numbered by one task."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("doc_id", "size", "text_crc32")]
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 3), 16, 10).cast("int")


def with_slots(placed: DataFrame) -> DataFrame:
    """Add ``slot``, 0, 1, 2, ... without a gap in each shard.

    Equal rows are counted first, so that copies cost one row per task. A shard is numbered in
    ``SLOT_CELLS`` cells: each cell on its own, after the sizes of the cells before it, which are
    the only rows that meet per shard (24 shards have fewer than 100,000 of them whatever the input).
    """
    alike = placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_cell", cell())
    cells = alike.groupBy("shard", "_cell").agg(F.sum("_n").alias("_cell_n"))
    before_cell = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("shard", "_cell", F.coalesce(F.sum("_cell_n").over(before_cell), F.lit(0)).alias("_before"))
    before = Window.partitionBy("shard", "_cell").orderBy("doc_id", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = alike.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    first = F.col("_before") + F.col("_inside")
    return inside.join(cells, ["shard", "_cell"]).select(
        *placed.columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"))


def rendezvous_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24,
                      weights: list[float] | None = None) -> DataFrame:
    """Place every row; see the module's text for the law and the edge cases."""
    placed = with_slots(placements(df, key, text, weights or [1.0] * shards))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
