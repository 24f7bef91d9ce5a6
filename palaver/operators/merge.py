"""Keyed latest-wins merge and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.scalars import days
from palaver.session import TEXT_CODEC, written

SCORE_COLUMNS = ("toxicity_score", "label", "is_toxic", "sentiment", "sentiment_score", "ingestion_time")
SCORE_ONLY_COLUMNS = ("toxicity_score", "ingestion_time")


def latest_wins(rows: DataFrame, key: str, order: list[str], update: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """One row per key: ``update`` columns of its last row by ``order``, all others of its first.

    Both halves are aggregates, so the many versions of a hot key shrink to one row per task
    before the shuffle.
    """
    columns = [c for c in rows.columns if c not in order]
    first = [c for c in columns if c != key and c not in update]
    last = [c for c in columns if c != key and c in update]
    halves = [F.max_by(F.struct(*last), F.struct(*order)).alias("_last")]
    fields = ["_last.*"]
    if first:
        halves.append(F.min_by(F.struct(*first), F.struct(*order)).alias("_first"))
        fields.append("_first.*")
    return rows.groupBy(key).agg(*halves).select(key, *fields).select(*columns)


def summary(batch: DataFrame, key: str = "comment_id", order: list[str] | None = None,
            update: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """``(key, _last, _first)``: per key the ``update`` columns of its last row and the other columns of its first.

    A column of ``order`` that is not among the ``update`` ones only decides and is left out.
    """
    order = ["ingestion_time"] if order is None else order
    last = [c for c in batch.columns if c != key and c in update]
    first = [c for c in batch.columns if c != key and c not in update and c not in order]
    by = F.struct(*order)
    return batch.groupBy(key).agg(F.max_by(F.struct(*last), by).alias("_last"),
                                  (F.min_by(F.struct(*first), by) if first else F.lit(None)).alias("_first"))


def merged(existing: DataFrame, rows: DataFrame, key: str, broadcast: bool = False) -> DataFrame:
    """Stored rows after the updates of a summary (to be read twice), and a row for each new key.

    With ``broadcast`` the summary's keys and last updates go to the stored rows, which then do not move.
    """
    last = rows.select(key, "_last")
    changed = set(rows.schema["_last"].dataType.names)
    known = existing.join(F.broadcast(last) if broadcast else last, key, "left").select(*[
        F.when(F.col("_last").isNotNull(), F.col("_last")[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in existing.columns])
    keys = rows.select(key)
    found = existing.select(key).join(F.broadcast(keys), key, "left_semi") if broadcast else existing.select(key)
    new = rows.join(F.broadcast(found) if broadcast else found, key, "left_anti")
    return known.unionByName(inserted(new, key, existing.columns))


def inserted(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows of a summary as new rows of a table."""
    changed = set(rows.schema["_last"].dataType.names)
    return rows.select(*[F.col(c) if c == key else F.col("_last" if c in changed else "_first")[c].alias(c) for c in columns])


def merged_once(existing: DataFrame, batch: DataFrame, key: str, order: list[str], update: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """What ``upsert`` gives, for stored rows with one row per key (as in a keyed table; null keys may repeat).

    Stored rows are the earliest versions of their keys, so one aggregate does it: every text moves once and nothing is written between.
    """
    names = existing.columns
    last = [c for c in names if c != key and c in update]
    first = [c for c in names if c != key and c not in update]
    kinds = dict(batch.dtypes)
    before = F.struct(F.lit(0).alias("_new"), *[F.lit(None).cast(kinds[c]).alias(c) for c in order]).alias("_at")
    later = F.struct(F.lit(1).alias("_new"), *order).alias("_at")
    rows = existing.filter(F.col(key).isNotNull()).select(*names, before).unionByName(batch.select(*names, later))
    halves = [F.max_by(F.struct(*last), "_at").alias("_last")] + [F.min_by(F.struct(*first), "_at").alias("_first")] * bool(first)
    merged_rows = rows.groupBy(key).agg(*halves).select(key, "_last.*", *["_first.*"] * bool(first)).select(*names)
    return existing.filter(F.col(key).isNull()).unionByName(merged_rows)


def upsert(existing: DataFrame, batch: DataFrame, key: str = "comment_id", order: list[str] | None = None,
           update: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """Insert new keys; for a known key overwrite only the ``update`` columns.

    ``existing`` has one row per key. Within the batch ``order`` (columns of the batch) decides.
    Replaying a batch changes nothing. The batch is computed once, to one row per key, and written; stored
    rows meet its narrow last updates in one join, and their keys alone tell the new ones.
    """
    return merged(existing, written(summary(batch, key, order, update), "summary", TEXT_CODEC), key)


def expired(as_of: Column, keep_days: int, ts: str = "timestamp") -> Column:
    """Real-time statistics past their keep time. Unknown times never expire."""
    old = (F.col(ts) < as_of - days(keep_days)) & (F.col("period_type") == "realtime")
    return F.coalesce(old, F.lit(False))


def retain(statistics: DataFrame, as_of: Column, keep_days: int = 30) -> DataFrame:
    return statistics.filter(~expired(as_of, keep_days))


def expired_count(statistics: DataFrame, as_of: Column, keep_days: int = 30) -> DataFrame:
    """One row: how many rows ``retain`` drops."""
    return statistics.agg(F.count_if(expired(as_of, keep_days)).alias("deleted_count"))
