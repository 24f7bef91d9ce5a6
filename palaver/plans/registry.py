"""All queries by name, gathered from the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    from palaver.plans import corpus_queries, report_queries, stream_queries, text_queries  # noqa: F401
    return dict(_QUERIES)
