"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source size`` times: whole copies plus a
fraction. The fractions are rounded in pairs: mass moves between two documents, in words, in the
random direction and by the amount that makes one of them integral, with odds that keep each
document's expected copies. The words of a pair stay the same, so a source as a whole misses its
target by half of its last document at most, which goes to the nearer whole number.

Documents are dealt to small blocks of their source; each block rounds all but one, and the ones
left over meet in the blocks of the next level, a reduction tree of ``BLOCK`` branches. All random
numbers are hashes of the documents, so a rerun or a repeated task gives the same mix.

Edge cases: a null text has no words and is taken 0 times; a null source is a source of its own,
after all others; equal rows are first counted and mixed as one, then share its copies; a source
without words has target 0; an empty table gives no rows; columns beyond the three named are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from palaver.llm.words import WORD_SQL
from palaver.session import written

BLOCK = 256
EPSILON = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.expr(f"'{WORD_SQL}'")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   ceiling: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` per source.

    Sources in code point order take the weights in turn. Filling by weight with ceilings: a source
    is full when the common level reaches ``ceiling * size / weight``, so the sources in the order
    of that level are full up to some source, and the others share the rest by weight. The windows
    hold one summed row per source, never documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_weight", weight).withColumn("_cap", ceiling * F.col("source_size"))
    level = F.col("_cap") / F.col("_weight")
    by_level = Window.orderBy(level, F.encode("source", "UTF-8"))
    until, rest = by_level.rowsBetween(Window.unboundedPreceding, 0), by_level.rowsBetween(0, Window.unboundedFollowing)
    filled = ranked.withColumn("_total", share * F.sum("source_size").over(Window.partitionBy()))
    filled = filled.withColumn("_used", F.sum("_cap").over(until) - F.col("_cap"))
    filled = filled.withColumn("_open_weight", F.sum("_weight").over(rest))
    # the level if the sources before this one are full and the others open; past the true one it only falls
    filled = filled.withColumn("_level", (F.col("_total") - F.col("_used")) / F.col("_open_weight"))
    open_level = F.max(F.when(F.col("_level") <= level, F.col("_level"))).over(Window.partitionBy())
    return filled.select("source", "source_size", F.least(
        F.col("_cap"), F.coalesce(open_level, level) * F.col("_weight")).alias("target"))


def uniform(*parts) -> Column:
    """Uniform in (0, 1), a function of the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def pivot(chances: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round all chances but one at most, whose index is returned (or -1). Keeps ``sum(chances * sizes)``.

    The partner of the largest open row is the pool of all other open rows, which give or take the
    words in proportion to their sizes. So a large row is settled by many small ones, and what is left
    over in the end is small.
    """
    out = np.where((chances > EPSILON) & (chances < 1 - EPSILON), chances, np.rint(chances))
    order = np.argsort(-sizes, kind="stable")
    left = order[(out[order] > 0) & (out[order] < 1)]
    step = 0
    while len(left) > 1:
        row, pool = left[0], left[1:]
        words, total = sizes[row], sizes[pool].sum()
        to = min((1 - out[row]) * words, out[pool].min() * total)  # words that can move to the row, and from it
        fro = min(out[row] * words, (1 - out[pool].max()) * total)
        moved = to if draws[step % len(draws)] * (to + fro) < fro else -fro
        out[row] += moved / words
        out[pool] -= moved / total
        near = left[(out[left] <= EPSILON) | (out[left] >= 1 - EPSILON)]
        out[near] = np.rint(out[near])
        left = left[(out[left] > 0) & (out[left] < 1)]
        step += 1
    return out, int(left[0]) if len(left) else -1


def round_block(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: ``extra`` 0 or 1 for the rounded rows, null for the one that is left."""
    rows = rows.sort_values("node").reset_index(drop=True)
    chances, held = pivot(*(rows[c].to_numpy(float) for c in ("chance", "size", "draw")))
    extra = pd.array(chances.round().astype("int64"), dtype="Int64")
    if held >= 0:
        extra[held] = pd.NA
    return rows.assign(node=rows["node"].astype(object), chance=chances, extra=extra)[["node", "source_no", "size", "chance", "extra"]]


def rounded(rows: DataFrame) -> DataFrame:
    """``(node, extra)``, extra 0 or 1, for all rows ``(node, source_no, size, chance)``."""
    done, level = [], 0
    while True:
        count = rows.groupBy("source_no").agg(F.count(F.lit(1)).alias("_n"))
        if (count.agg(F.max("_n")).first()[0] or 0) <= 1:
            last = (F.col("chance") >= 0.5).cast("long")
            return functools.reduce(DataFrame.unionByName, done, rows.select("node", last.alias("extra")))
        block = F.pmod(F.xxhash64("node", F.lit(level)), F.ceil(F.col("_n") / BLOCK))
        dealt = rows.join(count, "source_no").select(
            *rows.columns, block.alias("block"), uniform("node", F.lit(f"draw {level}")).alias("draw"))
        out = written(dealt.groupBy("source_no", "block").applyInPandas(
            round_block, "node string, source_no long, size long, chance double, extra long"), "mix")
        done.append(out.filter("extra IS NOT NULL").select("node", "extra"))
        rows = out.filter("extra IS NULL").drop("extra")
        level += 1


def node_id(doc_id: Column, source: Column, text: Column) -> Column:
    """One id for equal rows."""
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("null")) for c in
             (doc_id.cast("string"), source, F.md5(F.coalesce(text, F.lit(""))))]
    return F.md5(F.concat_ws("/", *parts))


def pivotal_mix(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **shares) -> DataFrame:
    """``(node, doc_id, source, size, source_size, target, n, copies)``: one row per distinct input row.

    ``n`` equal rows are to be taken ``copies`` times together; ``node`` is their ``node_id``.
    """
    alike = written(df.select(
        node_id(F.col(doc_id), F.col(source), F.col(text)).alias("node"), F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
    ).groupBy("node").agg(F.first("doc_id").alias("doc_id"), F.first("source").alias("source"),
                          F.first("size").alias("size"), F.count(F.lit(1)).alias("n")), "mix-rows")
    sizes = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = written(source_targets(sizes, **shares).withColumn("source_no", F.xxhash64("source", F.col("source").isNull())),
                      "mix-targets")
    same = alike["source"].eqNullSafe(targets["source"])
    wanted = alike.join(targets, same).drop(targets["source"])
    times = F.when(F.col("size") > 0, F.col("n") * F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = wanted.withColumn("_times", times).withColumn("_whole", F.floor(F.col("_times") + EPSILON))
    chance = F.greatest(F.col("_times") - F.col("_whole"), F.lit(0.0))
    extra = rounded(wanted.filter(F.col("size") > 0).select("node", "source_no", "size", chance.alias("chance")))
    return wanted.join(extra, "node", "left").select(
        "node", "doc_id", "source", "size", "source_size", "target", "n",
        (F.col("_whole") + F.coalesce("extra", F.lit(0))).cast("long").alias("copies"))


def taken_words(mix: DataFrame) -> DataFrame:
    """One row per input row: equal rows share their copies as evenly as whole copies allow."""
    each = mix.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    base, rest = F.floor(F.col("copies") / F.col("n")), F.col("copies") % F.col("n")
    share = base + F.when(F.col("_i") <= rest, 1).otherwise(0)
    return each.select("doc_id", "source", "size", "source_size", "target",
                       (share * F.col("size")).cast("long").alias("taken"))


def mixed_rows(df: DataFrame, mix: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them. Of equal rows one stands for all copies."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    named = df.select(own.alias("_row"), node_id(F.col(doc_id), F.col(source), F.col(text)).alias("node"))
    plan = mix.filter("copies > 0").select("node", "n", "copies")
    single = named.join(plan.filter("n = 1"), "node")
    several = named.join(plan.filter("n > 1"), "node").groupBy("node").agg(
        F.first("_row").alias("_row"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return single.unionByName(several).select("_row", repeats.alias("_copy")).select("_row.*")
