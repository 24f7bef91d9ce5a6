"""Exact top-k search by inner product over sharded postings, with MaxScore pruning.

A dimension of the integer vectors is a term, its column over a shard's candidates the posting list.
For a query, a term's bound is the largest product it can add within the shard. The score to beat begins as the
k-th best of a few candidates that are scored in full. The terms of the largest bounds are essential: so many that
the rest together cannot reach that score alone. Essential postings are traversed for all candidates; the others are
probed step by step for those that can still reach the score to beat, which only grows.
Nothing is approximated: what is cut off could not be among the k best, ties included.

Candidates are dealt to shards by hash and queries to blocks; a task holds one shard and one block.
Each gives its k best per query, and a ranked window merges the shards. Equal rows are counted first
and stand for several candidates.

Edge cases: null vectors and those with null or non-finite components take no part; vectors of
different lengths compare as if filled with zeros; a query never meets rows of its own number, and
equal query rows are asked once (different vectors of one number are ranked apart); a null number is
a candidate like any other, never a query, and comes after all others in ties; fewer candidates
than k give all of them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.session import written

K, EVERY, SCALE = 20, 20, 64
SHARD_ROWS, BLOCK_QUERIES = 2048, 1024
STEP = 8  # terms probed between two cuts
SEEDS = 8  # times k candidates are scored in full first
EXACT = float(1 << 53)


def integers(vector: Column) -> Column:
    """``floor(64 x)`` of each component; null if the vector takes no part."""
    usable = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))))


def matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def search(postings: np.ndarray, sums: np.ndarray, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (columns of ``postings``) that can be among the k best, with their exact scores.

    ``sums`` holds the smallest and largest component of every term in the shard.
    """
    bounds = np.maximum(query * sums[0], query * sums[1])
    order = np.argsort(-bounds, kind="stable")
    rest = np.concatenate((np.cumsum(bounds[order][::-1])[::-1], [0]))  # what terms from here on can add at most
    floor_ = np.minimum(query * sums[0], query * sums[1])[order]
    low_rest = np.concatenate((np.cumsum(floor_[::-1])[::-1], [0]))
    alive = np.flatnonzero(allowed)
    score = np.zeros(len(alive), postings.dtype)
    if len(alive) <= k:
        return alive, query @ postings[:, alive]
    seeds = query @ postings[:, alive[:SEEDS * k]]
    to_beat = np.partition(seeds, len(seeds) - k)[len(seeds) - k]
    essential = max(STEP, int(np.argmax(rest < to_beat)) if rest[-1] < to_beat else len(order))
    done = 0
    while done < len(order):
        size = essential if not done else STEP
        terms = order[done:done + size]
        score = score + query[terms] @ (postings[terms] if len(alive) == postings.shape[1] else postings[np.ix_(terms, alive)])
        done += len(terms)
        if len(alive) > k and done < len(order):
            to_beat = max(to_beat, np.partition(score, len(score) - k)[len(score) - k] + low_rest[done])
            keep = score + rest[done] >= to_beat
            if not keep.all():
                alive, score = alive[keep], score[keep]
    return alive, score


def search_group(k: int):
    """One shard and one block of queries: the k best of each query."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ask, have = rows[rows["is_query"]], rows[~rows["is_query"]].sort_values(["no_id", "vec_id"])
        out = {"row": [], "query_id": [], "vec_id": [], "score": [], "n": []}
        if len(ask) and len(have):
            width = int(max(map(len, rows["vector"])))
            queries, postings = matrix(ask["vector"].tolist(), width), matrix(have["vector"].tolist(), width).T.copy()
            largest = float(np.abs(queries).max(initial=0)) * float(np.abs(postings).max(initial=0)) * max(width, 1)
            if largest * 4 < EXACT:  # sums of products are exact in doubles, which multiply faster
                queries, postings = queries.astype(float), postings.astype(float)
            ends = np.stack([postings.min(axis=1), postings.max(axis=1)]) if width else np.zeros((2, 0))
            ids, n, null = have["vec_id"].to_numpy(), have["n"].to_numpy(), have["no_id"].to_numpy()
            for row, query_id, query in zip(ask["row"], ask["vec_id"], queries):
                found, score = search(postings, ends, query, k, null | (ids != query_id))
                best = np.lexsort((found, -score))[:k]  # candidates are in the order of their numbers
                found, score = found[best], score[best].astype(np.int64)
                out["row"] += [int(row)] * len(found)
                out["query_id"] += [int(query_id)] * len(found)
                out["vec_id"] += [None if null[i] else int(ids[i]) for i in found]
                out["score"] += score.tolist()
                out["n"] += n[found].tolist()
        return pd.DataFrame({c: pd.array(v, "Int64") for c, v in out.items()})

    return run


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows whose number is divisible by ``every``, against all others."""
    usable = df.select(F.col(key).cast("long").alias("vec_id"), integers(F.col(vector)).alias("vector")).filter("vector IS NOT NULL")
    rows = written(usable.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("n")), "vectors")
    rows = rows.withColumn("row", F.xxhash64("vec_id", "vector"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_rows, n_queries = rows.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    # a null among the numbers would turn a group's numbers into doubles, which lose digits
    rows = rows.withColumn("no_id", F.col("vec_id").isNull()).withColumn("vec_id", F.coalesce("vec_id", F.lit(0).cast("long")))
    queries = queries.withColumn("no_id", F.lit(False))
    columns = ["shard", "block", "is_query", "no_id", "vec_id", "vector", "n", "row"]

    def in_all(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = queries.withColumn("is_query", F.lit(True)).withColumn(
        "block", F.pmod("row", F.lit(blocks)).cast("int")).withColumn("shard", in_all(shards))
    held = rows.withColumn("is_query", F.lit(False)).withColumn(
        "shard", F.pmod("row", F.lit(shards)).cast("int")).withColumn("block", in_all(blocks))
    found = asked.select(columns).unionByName(held.select(columns)).groupBy("shard", "block").applyInPandas(
        search_group(k), "row long, query_id long, vec_id long, score long, n long")
    best = Window.partitionBy("query_id", "row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    # a candidate of n equal rows fills n ranks, of which k at most can count
    each = found.select("row", "query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k)))).alias("_i"))
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(f"rank <= {k}")
    return ranked.select("query_id", "rank", "vec_id", "score")
