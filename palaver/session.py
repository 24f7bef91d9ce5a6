"""Session-level helpers: shared work folder, written results, spreading of small inputs, skewed lookups."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

HEAD_RANKS = 32_768
LONGEST_HEAD_KEY = 256
#: So many files a task writes side by side; beyond that it sorts its rows by folder.
OPEN_FILES = 32
#: A join by shuffle hashes its smaller side if no partition of it is larger than this; otherwise it sorts both.
MOST_HASHED = "64m"
#: Stored rows with texts: two thirds or less of the bytes of Spark's usual form.
TEXT_CODEC = "zstd"
#: Rows go to Python in batches of about so many bytes: thousands of long texts at once would fill the memory of a worker
#: and of the JVM beside it.
BATCH_BYTES = "4m"


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``, else one below the warehouse.

    Both are paths of the cluster's file system; a temporary folder of one machine is never used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_palaver"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for one run of one job."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a computed result with no lineage.

    Unlike a cache it survives the loss of executors, and it is computed once for several readers.
    """
    path = run_folder(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the jobs started inside; afterwards it is as it was."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python, from now on in this session, unless its user has set a bound.

    The setting is read when a job runs, and a result may be computed long after it was described.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows to as many partitions as ``spark.palaver.inputPartitions`` says; without it leave them as read.

    For tables of a few files that hold less than a split for every core. Large ones need no such
    setting: the scan has its splits, and no text is shuffled.
    """
    partitions = df.sparkSession.conf.get("spark.palaver.inputPartitions", None)
    return df.repartition(int(partitions), key) if partitions else df


def ranked_lookup(big: DataFrame, table: DataFrame, key: str, rank: str, how: str = "inner") -> DataFrame:
    """Join a large frame with a lookup table ranked 1.. by falling frequency of its string key.

    The first ``HEAD_RANKS`` keys are broadcast, so the hot ones never meet in one task and never
    move; their number and the length of their keys bound that side. Rows of rarer keys are joined by
    shuffle. The same plan holds at every size; ``big`` is scanned by both parts, so it should be
    cheap to compute or written.
    """
    in_head = (F.col(rank) <= HEAD_RANKS) & (F.octet_length(key) <= LONGEST_HEAD_KEY)
    head, tail = table.filter(in_head), table.filter(~in_head)
    found = big.join(F.broadcast(head), key)
    rest = big.join(F.broadcast(head.select(key)), key, "left_anti").join(tail, key, how)
    return found.unionByName(rest)
