"""Sinks: plain files, and an append-by-epoch table with latest-wins reading.

The table is a folder of row versions, ``run=<run>/epoch=<n>``. A run is the life of one checkpoint:
its name is kept in the checkpoint's folder and begins with the time it started. A stream that goes
on from its checkpoint goes on with its run, and a batch that is tried again replaces its own folder.
A stream with a new checkpoint is a new run, so it never touches what an earlier one has stored.
"""

from __future__ import annotations

import os
import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palaver.operators.merge import SCORE_COLUMNS, latest_wins, merged_once
from palaver.operators.records import first_seen
from palaver.session import TEXT_CODEC
from palaver.sources import keyed


def to_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return (
        df.writeStream.format("parquet").outputMode(mode)
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run of a checkpoint; a checkpoint without one starts a run that sorts after all earlier ones."""
    place = os.path.join(checkpoint, "run")
    try:
        stored = [r["value"] for r in spark.read.text(place).collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = []
    if not stored:
        stored = [f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"]
        spark.createDataFrame([(stored[0],)], "value string").coalesce(1).write.mode("overwrite").text(place)
    return stored[0]


def epoch_path(path: str, run: str, epoch: int) -> str:
    return os.path.join(path, f"run={run}", f"epoch={epoch}")


def write_epoch(batch: DataFrame, path: str, run: str, epoch: int) -> None:
    """Write a micro-batch to its own folder, replacing what an earlier try of it left.

    The cost is that of the batch, whatever the size of the table; a replay gives the same files.
    """
    batch.write.mode("overwrite").option("compression", TEXT_CODEC).parquet(epoch_path(path, run, epoch))


def to_epochs(df: DataFrame, path: str, checkpoint: str, mode: str = "append", also=None) -> DataStreamWriter:
    """Epoch sink. ``also(batch, run, epoch)`` writes a second output from the same computed batch.

    With a second output the batch is written first and read back for it, so the source is read
    and scored once. Errors fail the query: a batch that was not written is tried again.
    """
    run = run_of(df.sparkSession, checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, path, run, epoch)
        if also is not None:
            stored = batch.sparkSession.read.schema(batch.schema).parquet(epoch_path(path, run, epoch))
            also(stored, run, epoch)
    return df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)


def to_distinct(df: DataFrame, key: str, order: list[str], path: str, checkpoint: str, within: tuple[str, str] | None = None) -> DataStreamWriter:
    """Epoch sink that keeps the first row of each key, without state that grows in memory.

    A micro-batch is first combined to one row per key and task, so a hot key costs one row; the keys are then
    looked up among those stored by earlier epochs, one narrow column, and only new ones are written. ``within`` (a time column, an
    interval) bounds the look back from the earliest time of the batch, for tables too long to be searched
    whole. A batch that is tried again replaces its own folder and sees the same earlier epochs.
    """
    run = run_of(df.sparkSession, checkpoint)
    stored = StructType([f for f in df.schema.fields if f.name == key or (within and f.name == within[0])])

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        first = first_seen(batch, [key], order)
        try:
            known = all_epochs(spark, path, stored).filter((F.col("run") < run) | ((F.col("run") == run) & (F.col("epoch") < epoch)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            known = spark.createDataFrame([], stored)  # the first batch of all
        if within is not None:
            earliest = batch.agg(F.min(within[0])).first()[0]
            known = known.filter(F.col(within[0]) >= F.lit(earliest) - F.expr(f"INTERVAL {within[1]}"))
        write_epoch(first.join(known.select(key), key, "left_anti").select(*df.columns), path, run, epoch)
    return df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)


def to_keyed(df: DataFrame, path: str, checkpoint: str, key: str, order: list[str], update: tuple[str, ...], buckets: int = 64) -> DataStreamWriter:
    """Merge each micro-batch into a keyed table: new keys come in, of known ones the ``update`` columns change.

    A batch that is tried again is known by its run and epoch and changes nothing. Several streams may bring different columns of
    one table, one after the other (a table has one writer at a time): rows of a key meet there, however far apart they come.
    """
    run = run_of(df.sparkSession, checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        keyed.merge(batch.sparkSession, path, batch, key, order, update, buckets, {run: epoch})
    return df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)


def to_combined(df: DataFrame, path: str, checkpoint: str, key: str, partial, combine, buckets: int = 64) -> DataStreamWriter:
    """Keep an aggregate by key: ``partial(batch)`` of each micro-batch is folded in by ``combine(stored, partial)``.

    The cost is that of the batch and the buckets it touches; nothing is kept in memory between batches, and no watermark drops
    late rows. A batch that is tried again is known by its run and epoch and not counted twice.
    """
    run = run_of(df.sparkSession, checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        keyed.combine(batch.sparkSession, path, partial(batch), key, combine, buckets, {run: epoch})
    return df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)


def all_epochs(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Every stored row version of one or more table folders, with its ``run`` and ``epoch``."""
    versioned = StructType([*schema.fields, StructField("run", StringType()), StructField("epoch", LongType())])
    frames = [spark.read.schema(versioned).parquet(p) for p in ([path] if isinstance(path, str) else path)]
    versions = frames[0]
    for frame in frames[1:]:
        versions = versions.unionByName(frame)
    return versions


def _table(path: str) -> str:
    """Place of the folded rows; readers of the epochs pass over names with an underscore."""
    return os.path.join(path, "_table")


def _covered(commits: dict[str, int]) -> Column:
    """Whether a row version belongs to an epoch that is folded already."""
    return reduce(lambda a, b: a | b, [(F.col("run") == run) & (F.col("epoch") <= epoch) for run, epoch in commits.items()], F.lit(False))


def current_rows(spark: SparkSession, path: str | list[str], schema: StructType, key: str = "comment_id",
                 order=("ingestion_time",), update=SCORE_COLUMNS) -> DataFrame:
    """The table as of now: first values of the fixed columns, last values of the others.

    Row versions are ordered by run, epoch, then by ``order`` within it. Of a folded table the stored
    rows are read and only later epochs are merged into them.
    """
    names = ["run", "epoch", *[f"_o{i}" for i in range(len(order))]]
    folded = keyed.version(spark, _table(path)) if isinstance(path, str) else keyed.Version()
    versions = all_epochs(spark, path, schema).filter(~_covered(folded.commits))
    versions = versions.select("*", *[F.col(c).alias(n) for c, n in zip(order, names[2:])])
    if folded.number < 0:
        return latest_wins(versions, key, names, update)
    return merged_once(keyed.read(spark, _table(path), schema, folded.number), versions, key, names, update)


def fold(spark: SparkSession, path: str, schema: StructType, key: str = "comment_id", order=("ingestion_time",),
         update=SCORE_COLUMNS, ended: bool = False, buckets: int = 64) -> int:
    """Merge finished epochs into the keyed table below ``path``; the number of its new version.

    Streams may go on writing. The newest epoch of each run may still be written and is left for the next
    time, unless the streams have ``ended``. Manifest and marks appear together, so a reader of ``path``
    sees each row version once, whether it comes before, during or after.
    """
    folded = keyed.version(spark, _table(path))
    versions = all_epochs(spark, path, schema).filter(~_covered(folded.commits))
    there = versions.groupBy("run").agg(F.sort_array(F.collect_set("epoch")).alias("epochs")).collect()
    marks = {r.run: r.epochs[-1 if ended else -2] for r in there if ended or len(r.epochs) > 1}
    if not marks:
        return folded.number
    names = ["run", "epoch", *[f"_o{i}" for i in range(len(order))]]
    batch = versions.filter(_covered(marks)).select("*", *[F.col(c).alias(n) for c, n in zip(order, names[2:])])
    return keyed.merge(spark, _table(path), batch, key, names, update, buckets, marks)


def drop_folded(spark: SparkSession, path: str, schema: StructType, keep: int = 2) -> int:
    """Remove epochs that were folded ``keep`` versions ago or earlier, and old versions; the number of epochs removed."""
    newest = keyed.version(spark, _table(path)).number
    if newest - keep < 0:
        return 0
    old = keyed.version(spark, _table(path), newest - keep)
    rows = all_epochs(spark, path, schema).filter(_covered(old.commits)).select("run", "epoch").distinct().collect()
    for r in rows:
        keyed.remove(spark, epoch_path(path, r.run, r.epoch))
    keyed.cleanup(spark, _table(path), keep + 1)
    return len(rows)


def compact(spark: SparkSession, path: str, target: str, schema: StructType, **options) -> None:
    """Fold the current rows into a table folder of their own, as the run before all others.

    Streams may go on writing to ``path``: its folders stay as they are, and reading ``[target, path]``
    gives every row whether it came before, during or after. Old runs whose streams have ended can
    then be removed from ``path`` by whoever keeps the storage.
    """
    write_epoch(current_rows(spark, path, schema, **options), target, "0", -1)
