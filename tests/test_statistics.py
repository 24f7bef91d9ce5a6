"""Snapshots appended and retained, and the metrics of a collecting run."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.operators import collecting
from palaver.sources import statistics

T0 = datetime(2024, 1, 31, 12, 0)
ROW = "timestamp timestamp_ntz, total bigint, period_start timestamp_ntz, period_type string"


def snapshots(spark, rows):
    return spark.createDataFrame([(at, n, None if at is None else at - timedelta(minutes=5), kind) for at, n, kind in rows], ROW)


def totals(spark, path, **span):
    return sorted((r.total, r.period_type) for r in statistics.read(spark, path, **span).collect())


def test_an_appended_snapshot_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "s")
    statistics.append(snapshots(spark, [(T0, 1, "realtime"), (T0 + timedelta(minutes=5), 2, "realtime"), (T0, 3, "daily")]), path)
    statistics.append(snapshots(spark, [(T0, 9, "realtime"), (None, 4, "realtime")]), path)
    statistics.append(snapshots(spark, [(T0, 9, "realtime")]), path)
    assert totals(spark, path) == [(2, "realtime"), (3, "daily"), (4, "realtime"), (9, "realtime")]
    assert set(statistics.read(spark, path).columns) == {"timestamp", "total", "period_start", "period_type"}


def test_retention_drops_days_and_single_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    limit = T0 - timedelta(days=30)
    rows = [(limit - timedelta(days=k, minutes=5 * i), 10 * k + i, "realtime") for k in range(4) for i in range(3)]
    rows += [(limit + timedelta(minutes=5), 100, "realtime"), (limit - timedelta(days=2), 200, "daily"), (None, 300, "realtime"), (T0, 400, "realtime")]
    statistics.append(snapshots(spark, rows), path)
    dropped = [r for r in rows if r[0] is not None and r[0] < limit and r[2] == "realtime"]
    assert statistics.retain(spark, path, T0) == len(dropped) == 11
    assert totals(spark, path) == sorted((n, kind) for at, n, kind in rows if (at, n, kind) not in dropped)
    assert statistics.retain(spark, path, T0) == 0 and statistics.retain(spark, str(tmp_path / "none"), T0) == 0
    assert not (tmp_path / "s" / f"day={(limit - timedelta(days=1)).date()}" / "period_type=realtime").exists()
    assert totals(spark, path, since=T0.date()) == [(400, "realtime")]


def metrics(spark, path):
    return {r.metric_name: r.metric_value for r in spark.read.schema(schemas.METRICS).parquet(path).collect()}


def test_metrics_of_a_run(spark, tmp_path):
    rows = [("a", "x", 2), ("a", "y", 1), ("b", "", 3), ("c", None, 4), ("d", "z", 5), ("a", "x", 6)]
    df = spark.createDataFrame(rows, "k string, m string, n int").repartition(3)
    collecting.collect_run(df, "m", "k", ["n"], str(tmp_path / "out"), str(tmp_path / "metrics"), T0)
    found = metrics(spark, str(tmp_path / "metrics"))
    assert found.pop("runtime_seconds") > 0
    assert found == {"total_fetched": 6.0, "total_sent": 2.0, "duplicates_skipped": 2.0, "errors": 0.0}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("k", "m").collect()} == {("a", "y"), ("d", "z")}


def test_a_failed_run_is_recorded_and_raised(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1)], "k string, m string, n int").withColumn("m", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        collecting.collect_run(df, "m", "k", ["n"], str(tmp_path / "out"), str(tmp_path / "metrics"), T0)
    assert metrics(spark, str(tmp_path / "metrics"))["errors"] == 1.0
