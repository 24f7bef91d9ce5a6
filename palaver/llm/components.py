"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palaver.session import written

#: Rows of two numbers up to here are broadcast, checked by a count; more are joined by a shuffle.
FEW_ROWS = 100_000


def downward(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with ``a > b``, each once."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def lookup(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return both.filter("b > a").join(lookup(least, few), "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))


def small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    others = edges.join(lookup(least, few), "a").filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return others.unionByName(least.select("a", F.col("_m").alias("b")))


def are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no larger ones, or larger ones only."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.filter("up > 1 OR up = 1 AND down = 1").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every node of the edges ``(a, b)``; the root is the smallest id of its component.

    Each round is written to the shared folder; the last one leaves stars only. The driver sees counts. All
    groupings are minima or sums, which combine before the shuffle. The minima of few edges are broadcast.
    """
    edges = written(downward(edges), "edges")
    few = edges.count() <= FEW_ROWS
    while not are_stars(edges):
        # both steps give edges that point downward, at most one for each edge and node
        edges = written(small_star(large_star(edges, few), few).distinct(), "edges")
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("root", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)


def united(clusters: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(id, root)`` after further links ``(a, b)``: only the roots that these join are worked on."""
    if clusters is None:
        return written(components(links), "clusters")
    few = clusters.count() <= FEW_ROWS
    for end in ("a", "b"):
        own = clusters.select(F.col("id").alias(end), F.col("root").alias("_root"))
        links = links.join(lookup(own, few), end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    links = written(downward(links), "links")
    if links.isEmpty():
        return clusters
    joined = written(components(links), "joined")
    moved = joined.select(F.col("id").alias("root"), F.col("root").alias("_to"))
    known = clusters.join(lookup(moved, joined.count() <= FEW_ROWS), "root", "left").select("id", F.coalesce("_to", "root").alias("root"))
    return written(known.unionByName(joined.join(lookup(clusters.select("id"), few), "id", "left_anti")), "clusters")
