"""Message hops and stream control."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from palaver import schemas
from palaver.operators.records import decode_envelope, encode_envelope
from palaver.plans import stages


def read_files_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None,
                      form: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(form)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def normaliser(messages: DataFrame) -> DataFrame:
    """Raw messages to cleaned messages."""
    return encode_envelope(stages.cleaned_record(decode_envelope(messages, schemas.RAW)))


def feature_builder(messages: DataFrame) -> DataFrame:
    """Cleaned messages to feature messages."""
    return encode_envelope(stages.feature_record(decode_envelope(messages, schemas.CLEANED)))


def scorer(messages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Feature messages to scored rows; shape them with ``prediction_record`` or ``result_record``."""
    return stages.score_stage(decode_envelope(messages, schemas.FEATURES), threshold)


def scored_in_one(messages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Raw messages to scored rows in one plan, without the two hops between."""
    raw = decode_envelope(messages, schemas.RAW).withColumn("original_message", F.col("message"))
    return stages.analyse(raw, "message", threshold).withColumnRenamed("user", "username")


def drained(writer: DataStreamWriter) -> StreamingQuery:
    """Process all that is there now, in bounded batches, then stop. Errors are raised, not kept."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def continuous(writer: DataStreamWriter, every: str = "5 seconds") -> StreamingQuery:
    return writer.trigger(processingTime=every).start()


class ProgressLog(StreamingQueryListener):
    """Counters of every trigger of the streams that run while it listens, one small record each.

    ``spark.streams.addListener(log)`` starts it. A stream's own report list keeps the last triggers only.
    """

    def __init__(self) -> None:
        self.rows: list[tuple[str, float, datetime]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        at = datetime.fromisoformat(report.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
        dropped = sum(state.numRowsDroppedByWatermark for state in report.stateOperators)
        self.rows += [("input_rows", float(report.numInputRows), at),
                      ("trigger_milliseconds", float(report.durationMs.get("triggerExecution", 0)), at),
                      ("late_rows_dropped", float(dropped), at)]

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.rows.append(("errors", 1.0, datetime.now(timezone.utc).replace(tzinfo=None)))

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``(metric_name, metric_value, recorded_at)`` rows, for example to append to a metrics table."""
        return spark.createDataFrame(list(self.rows), schemas.METRICS)


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)


def stop_all(spark: SparkSession) -> None:
    """Stop every running stream of the session."""
    for query in spark.streams.active:
        query.stop()
