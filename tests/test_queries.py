"""Every registered query against its check SQL, row by row."""

from __future__ import annotations

import math

import pandas as pd
import pytest

import __spark_entry__ as entry_points

QUERIES, CHECKS = entry_points.queries(), entry_points.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    value = value.item() if hasattr(value, "item") else value
    return value.isoformat() if hasattr(value, "isoformat") else value


def rows(frame: pd.DataFrame, columns) -> list[tuple]:
    out = [tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in CHECKS])
def test_query_equals_its_sql(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    answer = duck.execute(CHECKS[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    expected = answer.fetch_df()
    for column, kind in types.items():
        if kind == "DATE":
            expected[column] = expected[column].dt.date
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in result.schema.fields} == types
    columns = sorted(types)
    assert rows(result.toPandas(), columns) == rows(expected, columns)


@pytest.mark.parametrize("name", ["forest_predictions", "model_or_rule_score"])
def test_model_queries_cover_every_labelled_text(name, spark, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    found = result.select("doc_id").distinct().count()
    assert found == spark.read.parquet(f"{sf_dir}/labels.parquet").count()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["realtime_stats", "hourly_activity", "timeline_days", "timeline_hours", "daily_summary_recent"])
def test_range_reports_read_only_their_days_and_no_text(name, spark, sf_dir, capsys):
    result = QUERIES[name](spark, sf_dir)
    capsys.readouterr()
    result.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(ingestion_day" in plan
    assert "comment:string" not in plan and "documents.parquet" not in plan and "Join" not in plan
