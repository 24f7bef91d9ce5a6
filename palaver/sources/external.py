"""Message broker and database connections. All settings are arguments; there are no defaults.

Both need a connector jar on the cluster (``spark-sql-kafka``, a JDBC driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def read_topic_stream(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None,
                      **options) -> DataFrame:
    """``(key, value, timestamp, ...)`` messages from the earliest offset on.

    ``max_per_trigger`` bounds a micro-batch, so the first run over a long backlog stays steady.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.options(**options).load()


def write_topic_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str,
                       every: str = "5 seconds", **options) -> DataStreamWriter:
    """Writer of ``(key, value)`` messages; call ``start()`` on it."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(processingTime=every)
    )


def read_database(spark: SparkSession, url: str, table: str, properties: dict, column: str | None = None,
                  bounds: tuple | None = None, partitions: int = 32) -> DataFrame:
    """Database table; with a column and its bounds it is read by many tasks."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, high = bounds
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high,
                           numPartitions=partitions, properties=properties)


def write_database(df: DataFrame, url: str, table: str, properties: dict, mode: str = "append") -> None:
    """Batched inserts from the executors. Resolve the latest rows before, see ``operators.merge``."""
    df.write.jdbc(url, table, mode=mode, properties=properties)
