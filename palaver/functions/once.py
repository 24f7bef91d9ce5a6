"""Columns that are evaluated once per row, whatever is filtered on them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a one-element ``explode``.

    A filter on a projected column is moved below the projection with a copy of its expression.
    For a chain of regular expressions that is the whole work twice; for an expression used inside
    an array function it is the whole work once per element. A filter is not moved below an
    ``explode`` whose output it reads, so what stands here is computed exactly once.
    """
    box = F.struct(*[c.alias(n) for n, c in columns.items()])
    boxed = df.select("*", F.explode(F.array(box)).alias("_once"))
    return boxed.select(*df.columns, *[F.col("_once")[n].alias(n) for n in columns])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
