"""The statistics table: snapshots appended by key, and retention that drops whole folders.

Rows stand in a folder of their day and type. A snapshot is one period of one type; appending it again replaces it. An append rewrites
the folders of its own days and types only, each in one step, and readers of a span open the folders of its days.
"""

from __future__ import annotations

import os
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver.operators.merge import expired
from palaver.session import written
from palaver.sources.keyed import remove


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace(rows: DataFrame, path: str) -> None:
    """Write whole days and types; other folders stay."""
    placed = rows.repartition("day", "period_type")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "period_type").parquet(path)


def append(statistics: DataFrame, path: str) -> None:
    """Add snapshots ``(timestamp, period_type, period_start, ...)``; one of a known type, day and start replaces the old one.

    A missing start is a start of its own, a missing time a day of its own.
    """
    keys = ["day", "period_type", "period_start"]
    new = written(statistics.withColumn("day", F.to_date("timestamp")), "snapshots")
    rows, old = new.withColumn("_new", F.lit(1)), _stored(statistics.sparkSession, path)
    if old is not None:
        own = new.select(F.col("day").alias("_d"), F.col("period_type").alias("_t")).distinct()
        match = F.col("day").eqNullSafe(F.col("_d")) & F.col("period_type").eqNullSafe(F.col("_t"))
        rows = rows.unionByName(old.join(own, match, "left_semi").withColumn("_new", F.lit(0)))
    rest = [c for c in new.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_new").alias("_row")).select(*keys, "_row.*").select(*new.columns)
    _replace(written(last, "snapshots"), path)


def read(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """All snapshots, or those of the days from ``since`` to ``until`` (columns or dates, both inclusive)."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.filter(F.col("day") >= F.to_date(since if isinstance(since, Column) else F.lit(since)))
    if until is not None:
        rows = rows.filter(F.col("day") <= F.to_date(until if isinstance(until, Column) else F.lit(until)))
    return rows.drop("day")


def retain(spark: SparkSession, path: str, as_of: datetime, keep_days: int = 30) -> int:
    """Drop real-time snapshots past their keep time; the number of rows dropped. Unknown times never expire.

    Days before the limit go as whole folders; the folder of the limit's own day is rewritten without them.
    """
    limit, stored = as_of - timedelta(days=keep_days), _stored(spark, path)
    if stored is None:
        return 0
    rows = stored.filter((F.col("day") <= limit.date()) & (F.col("period_type") == "realtime"))
    gone = expired(F.lit(as_of).cast("timestamp_ntz"), keep_days)
    counts = {r.day: r for r in rows.groupBy("day").agg(F.count_if(gone).alias("old"), F.count(F.lit(1)).alias("n")).collect()}
    for day, r in counts.items():
        if r.old == r.n:
            remove(spark, os.path.join(path, f"day={day}", "period_type=realtime"))
        elif r.old:
            _replace(written(rows.filter((F.col("day") == day) & ~gone), "snapshots"), path)
    return sum(r.old for r in counts.values())
