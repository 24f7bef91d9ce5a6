"""One collecting run: fetched records to distinct ones in storage, counted while they pass."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from palaver import schemas
from palaver.operators.records import first_seen
from palaver.streaming.hops import append_metrics


def collect_run(fetched: DataFrame, message: str, key: str, order: list[str], path: str, metrics: str,
                recorded_at: datetime) -> None:
    """Write the first record with a message of each key, and five metrics of the run.

    ``total_fetched``, ``total_sent``, ``duplicates_skipped``, ``errors`` and ``runtime_seconds`` are appended to the metrics
    table. The counts are observed in the job that writes, without a second scan. A run that fails is recorded as an error with the counts
    it has, and raised again.
    """
    before, after, started = Observation(), Observation(), time.monotonic()
    usable = F.coalesce(F.col(message), F.lit("")) != ""
    seen = fetched.observe(before, F.count(F.lit(1)).alias("fetched"), F.count_if(usable).alias("usable"))
    sent = first_seen(seen.filter(usable), [key], order).observe(after, F.count(F.lit(1)).alias("sent"))

    def record(counts: dict[str, int], errors: int) -> None:
        values = {"total_fetched": counts.get("fetched", 0), "total_sent": counts.get("sent", 0),
                  "duplicates_skipped": counts.get("usable", 0) - counts.get("sent", 0) if not errors else 0,
                  "errors": errors, "runtime_seconds": time.monotonic() - started}
        rows = [(name, float(value), recorded_at) for name, value in values.items()]
        append_metrics(fetched.sparkSession.createDataFrame(rows, schemas.METRICS), metrics)

    try:
        sent.write.mode("overwrite").parquet(path)
    except Exception:
        record({}, 1)
        raise
    record({**before.get, **after.get}, 0)
