"""A keyed table in Parquet: rows by bucket of their key, and a small manifest that says which folders count.

A merge reads and rewrites only the buckets that its batch touches, into folders of a new version. One manifest file then makes
all of them visible at once: before it is written, readers see the old version; a merge that dies leaves nothing that is read. A
reader keeps the version it began with, since folders are never changed, until ``cleanup`` drops versions by age. A
merge may carry commits (``{run: epoch}``); one whose commits are all stored already changes nothing, so replays are harmless. One
writer at a time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from palaver import session
from palaver.operators import merge as merging

MANIFEST = "kind string, name string, value string"
#: A batch of so many keys or fewer is broadcast to the stored rows, by its keys and last updates alone; a larger one meets them by shuffle.
MOST_BROADCAST = 200_000


@dataclass
class Version:
    number: int = -1
    buckets: int = 0
    folders: dict[int, str] = field(default_factory=dict)
    commits: dict[str, int] = field(default_factory=dict)


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{MANIFEST}, at bigint").parquet(os.path.join(path, "manifest"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def version(spark: SparkSession, path: str, at: int | None = None) -> Version:
    """The newest version, or a given one; number -1 if the table has none."""
    stored = _manifests(spark, path)
    if stored is None:
        return Version()
    newest = stored.agg(F.max("at")).first()[0] if at is None else at
    if newest is None:
        return Version()
    found = Version(newest)
    for r in stored.filter(F.col("at") == newest).collect():
        if r.kind == "bucket":
            found.folders[int(r.name)] = r.value
        elif r.kind == "commit":
            found.commits[r.name] = int(r.value)
        else:
            found.buckets = int(r.value)
    return found


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _folder(path: str, folder: str, bucket: int) -> str:
    return os.path.join(path, "data", f"version={folder}", f"bucket={bucket}")


def _rows(spark: SparkSession, path: str, schema: StructType, folders: dict[int, str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(path, f, b) for b, f in sorted(folders.items())])


def read(spark: SparkSession, path: str, schema: StructType, at: int | None = None) -> DataFrame:
    """The rows of the newest version, or of a given one that is still kept."""
    return _rows(spark, path, schema, version(spark, path, at).folders)


def merge(spark: SparkSession, path: str, batch: DataFrame, key: str = "comment_id", order: list[str] | None = None,
          update: tuple[str, ...] = merging.SCORE_COLUMNS, buckets: int = 64, commits: dict[str, int] | None = None,
          base: int | None = None) -> int:
    """Insert new keys, overwrite the ``update`` columns of known ones; the number of the new version.

    The batch is read once: it is shrunk to one row per key, which is written; for a table without rows as its first version. ``order`` columns that are no columns of the table
    (a run, an epoch) only decide within the batch. ``base`` merges on top of an older version. A new table takes ``buckets``.
    """
    known = version(spark, path, base)
    newest = known if base is None else version(spark, path)
    if commits and all(known.commits.get(run, -1) >= epoch for run, epoch in commits.items()):
        return known.number
    count = known.buckets or buckets
    summary = merging.summary(batch, key, order, update).withColumn("bucket", _bucket(key, count))
    fields = [f for f in batch.schema.fields if f.name not in (order or []) or f.name in update]
    schema = StructType(fields)
    old = Version(newest.number, count, known.folders, known.commits)
    if not known.folders:
        return _replace(spark, path, merging.inserted(summary, key, schema.names), key, old, None, commits)
    staged = session.written(summary, "staged", session.TEXT_CODEC)
    touched = {r.bucket for r in staged.select("bucket").distinct().collect()}
    stored = _rows(spark, path, schema, {b: f for b, f in known.folders.items() if b in touched})
    rows = merging.merged(stored, staged.drop("bucket"), key, broadcast=staged.count() <= MOST_BROADCAST)
    return _replace(spark, path, rows, key, old, touched, commits)


def combine(spark: SparkSession, path: str, batch: DataFrame, key: str, function: Callable[[DataFrame, DataFrame], DataFrame],
            buckets: int = 64, commits: dict[str, int] | None = None) -> int:
    """Fold partial results, one row per key, into the stored ones by ``function(stored, batch)``; the number of the new version.

    Both sides of the function are of the touched buckets alone, and so must its rows be. Sums would count a replay twice, so a batch that
    may come again carries its commits, by which it is known.
    """
    known = version(spark, path)
    if commits and all(known.commits.get(run, -1) >= epoch for run, epoch in commits.items()):
        return known.number
    count = known.buckets or buckets
    staged = session.written(batch.withColumn("bucket", _bucket(key, count)), "staged")
    touched = {r.bucket for r in staged.select("bucket").distinct().collect()}
    stored = _rows(spark, path, batch.schema, {b: f for b, f in known.folders.items() if b in touched})
    rows = function(stored, staged.drop("bucket")).select(*batch.columns)
    return _replace(spark, path, rows, key, Version(known.number, count, known.folders, known.commits), touched, commits)


def _replace(spark: SparkSession, path: str, rows: DataFrame, key: str, old: Version, touched: set[int] | None,
             commits: dict[str, int] | None) -> int:
    """Write the new rows of the touched buckets and publish them; the number of the new version. With None these are all that got rows."""
    folder = uuid.uuid4().hex
    target = os.path.join(path, "data", f"version={folder}")
    placed = rows.withColumn("bucket", _bucket(key, old.buckets))
    placed.write.option("compression", session.TEXT_CODEC).partitionBy("bucket").parquet(target)
    if touched is None:
        touched = {r.bucket for r in spark.read.schema("bucket int").parquet(target).distinct().collect()}
    kept = dict(old.commits)
    for run, epoch in (commits or {}).items():
        kept[run] = max(epoch, kept.get(run, -1))
    _publish(spark, path, Version(old.number + 1, old.buckets, {**old.folders, **{b: folder for b in touched}}, kept))
    return old.number + 1


def _publish(spark: SparkSession, path: str, new: Version) -> None:
    lines = [("buckets", "", str(new.buckets)), *[("bucket", str(b), f) for b, f in sorted(new.folders.items())],
             *[("commit", run, str(epoch)) for run, epoch in sorted(new.commits.items())]]
    manifest = spark.createDataFrame(lines, MANIFEST).coalesce(1)
    manifest.write.mode("overwrite").parquet(os.path.join(path, "manifest", f"at={new.number}"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cleanup(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Drop all but the newest ``keep`` versions, and the folders that only they read; the number of folders dropped."""
    stored = _manifests(spark, path)
    if stored is None:
        return 0
    numbers = sorted(r["at"] for r in stored.select("at").distinct().collect())
    old, kept = numbers[:-keep], numbers[-keep:]

    def folders(which: list[int]) -> set[tuple[str, str]]:
        rows = stored.filter((F.col("kind") == "bucket") & F.col("at").isin(which)).select("name", "value").distinct()
        return {tuple(r) for r in rows.collect()} if which else set()

    gone = folders(old) - folders(kept)
    for number in old:  # first the manifests: what they alone name is then read by nobody new
        remove(spark, os.path.join(path, "manifest", f"at={number}"))
    for bucket, folder in gone:
        remove(spark, _folder(path, folder, int(bucket)))
    return len(gone)
