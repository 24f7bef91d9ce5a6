"""Quality rules: rule statistics per document, judged by an isolation forest.

The statistics are counts over the whole text. A forest of random splits is grown on the rows of
accepted labelled documents. The splits are drawn from a range somewhat wider than that of the rows
(there is an empty side beyond them), so a row unlike all accepted ones is isolated after few steps,
while an unusual accepted one still needs several. The verdict compares the mean path length with a threshold calibrated on all labelled rows, where an
accepted row lost weighs as much as ``LOST`` others kept. Documents with fewer than 50 words, or with more than half of their words in
repeated three-word windows, fail by rule.

The forest is the only part with a bound: each of ``TREES`` trees grows on ``SAMPLE`` rows, chosen by
the hash of the document's number, as the method prescribes. Without accepted labels the forest grows
on all rows; without any labels no document is rejected by it.

Edge cases: a null text is an empty one and fails by rule; a null number is allowed; equal rows get
equal verdicts; an empty table gives no rows; clashing names of other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palaver.llm.frames import free
from palaver.llm.words import WordHasher, covered, repeated, slices
from palaver.session import written

MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3
TREES, SAMPLE, LOST, STEPS = 100, 512, 10, 10_000
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
FEATURES = 8


def line_counts(part, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier one, per text."""
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate((part.at[:-1], breaks + 1)))
    starts = starts[starts < len(part.data)]
    ends = np.minimum(np.concatenate((starts[1:], [len(part.data)])), len(part.data))
    # a line ends before its line feed
    ends = ends - (part.data[ends - 1] == 10)
    words_before = np.concatenate(([0], np.cumsum(part.in_word)))
    full = words_before[ends] > words_before[starts]
    starts, ends = starts[full], ends[full]
    text = np.searchsorted(part.at, starts, side="right") - 1
    keys = hasher.spans(part.data, starts, ends)
    order = np.lexsort((keys, text))
    same = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text, minlength=part.n), np.bincount(text[order][1:][same], minlength=part.n)


def counts_of(part, hasher: WordHasher) -> dict[str, np.ndarray]:
    """The statistics of a slice, one value per text."""
    data, word = part.data, part.in_word
    at = part.windows(WINDOW)
    hashes = hasher.windows(hasher.words(part), at, WINDOW) if len(at) else np.zeros(0, np.uint64)
    inside = covered(len(part.starts), at[repeated(hashes, part.text[at])], WINDOW)
    lines, again = line_counts(part, hasher) if len(data) else (np.zeros(part.n, int),) * 2
    return {
        "n_words": part.n_words,
        "word_chars": part.count_bytes(word & ((data & 0xC0) != 0x80)),
        "n_symbols": part.count_bytes(np.isin(data, SYMBOLS)),
        "n_dup_lines": again,
        "n_repeat_words": np.bincount(part.text[inside], minlength=part.n),
        "n_lines": lines,
        "n_upper": part.count_bytes((data >= 65) & (data <= 90)),
        "n_marks": part.count_bytes((data == 33) | (data == 63)),
    }


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    words = np.maximum(counts["n_words"], 1)
    return np.stack([
        np.log1p(counts["n_words"]),
        counts["word_chars"] / words,
        np.log1p(100 * counts["n_symbols"] / words),
        counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1),
        counts["n_repeat_words"] / words,
        np.log1p(counts["n_lines"] / words * 100),
        counts["n_upper"] / np.maximum(counts["word_chars"], 1),
        counts["n_marks"] / words,
    ], axis=1)


def fails(counts) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * n)


def mean_depth(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows: what a leaf of n rows stands for."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, seed: int) -> list[tuple[int, float, int, float]]:
    """One tree as nodes ``(feature or -1, cut, right child, path length)``; the left child is the next node."""
    random = np.random.default_rng(seed)
    limit, nodes = 2 * math.ceil(math.log2(max(len(rows), 2))), []

    def add(own: np.ndarray, depth: int) -> None:
        low, high = (own.min(0), own.max(0)) if len(own) else (np.zeros(FEATURES),) * 2
        here = len(nodes)
        if depth >= limit or len(own) <= 1:
            nodes.append((-1, 0.0, -1, depth + mean_depth(len(own))))
            return
        f = int(random.integers(FEATURES))
        margin = high[f] - low[f] or 1.0
        cut = float(random.uniform(low[f] - margin, high[f] + margin))
        nodes.append((f, cut, -1, 0.0))
        add(own[own[:, f] < cut], depth + 1)
        nodes[here] = (f, cut, len(nodes), 0.0)
        add(own[own[:, f] >= cut], depth + 1)

    add(rows, 0)
    return nodes


def grow_group(key, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("draw").head(SAMPLE)
    nodes = grow(features({c: rows[c].to_numpy() for c in COUNTS}), int(key[0]))
    return pd.DataFrame(nodes, columns=["feature", "cut", "right", "length"]).assign(
        tree=key[0], node=range(len(nodes)), n=len(rows))


def score_rows(forest: list[tuple[np.ndarray, ...]], rows: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1): 2 to the minus mean path length over the usual one."""
    total = np.zeros(len(rows))
    for feature, cut, right, length, usual in forest:
        at = np.zeros(len(rows), np.int64)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                break
            i = np.flatnonzero(inner)
            node = at[i]
            at[i] = np.where(rows[i, feature[node]] < cut[node], node + 1, right[node])
        total += length[at] / max(usual, 1e-9)
    return np.exp2(-total / max(len(forest), 1)) if len(forest) else np.zeros(len(rows))


def statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default; names of statistics are replaced) and the statistics."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in COUNTS]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(incoming):
        hasher = WordHasher()
        for batch in incoming:
            *columns, texts = batch.columns
            parts = [counts_of(p, hasher) for p in slices(texts)]
            columns += [pa.array(np.concatenate([p[c] for p in parts] or [np.zeros(0)]).astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, names=keep + COUNTS)

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{c} long" for c in COUNTS])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(free(keep, "text"))).mapInArrow(run, schema)


def written_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """The statistics without the text, computed once and kept in the shared folder."""
    return written(statistics(df, text, [c for c in df.columns if c != text]), "statistics")


def fit_forest(rows: DataFrame, key: str) -> list[tuple[np.ndarray, ...]]:
    """Grow the trees as one grouped job over bounded samples; the driver gets the nodes."""
    draw = F.xxhash64(F.col(key), *COUNTS)
    chosen = rows.select(draw.alias("draw"), *COUNTS).orderBy("draw").limit(TREES * SAMPLE)
    # a tree takes its share of the chosen rows by their hash; with few rows the trees' shares overlap
    trees = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(TREES - 1).cast("long"))).alias("tree")
    n = chosen.count()
    if not n:
        return []
    share = min(1.0, 1.5 * SAMPLE / n)
    dealt = chosen.select("*", trees).withColumn("draw", F.xxhash64("draw", "tree"))
    dealt = dealt.filter(F.pmod("draw", F.lit(1 << 20)) < int(share * (1 << 20)))
    grown = dealt.groupBy("tree").applyInPandas(
        grow_group, "feature long, cut double, right long, length double, tree long, node long, n long")
    nodes = grown.toPandas().sort_values(["tree", "node"])
    return [(*(t[c].to_numpy() for c in ("feature", "cut", "right", "length")), mean_depth(t["n"].iloc[0]))
            for _, t in nodes.groupby("tree")]


def with_scores(stats: DataFrame, forest: list) -> DataFrame:
    """Add ``base_failed`` and ``anomaly`` to rows that have the statistics."""

    def run(incoming):
        for batch in incoming:
            counts = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS}
            columns = batch.columns + [pa.array(fails(counts)), pa.array(score_rows(forest, features(counts)))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names + ["base_failed", "anomaly"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(run, f"{kinds}, base_failed boolean, anomaly double")


def threshold(scored: DataFrame, quality: str) -> float:
    """The limit of least cost, where losing an accepted row costs as much as keeping ``LOST`` others.

    From a histogram over all labelled rows that pass the fixed rules; of equally good limits the
    middle one. Without rejected rows nothing is rejected.
    """
    step = F.least(F.floor(F.col("anomaly") * STEPS), F.lit(STEPS - 1))
    counts = scored.filter(~F.col("base_failed") & F.col(quality).isNotNull()).groupBy(step.alias("step")).agg(
        F.sum(F.when(F.col(quality) == 1, 1).otherwise(0)).alias("good"), F.count(F.lit(1)).alias("n")).toPandas()
    good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    good[counts["step"]], bad[counts["step"]] = counts["good"], counts["n"] - counts["good"]
    if not bad.sum():
        return 1.0
    lost = np.cumsum(good[::-1])[::-1]  # accepted rows at this step or above
    passed = np.concatenate(([0], np.cumsum(bad)[:-1]))
    cost = LOST * lost + passed
    best = np.flatnonzero(cost == cost.min())
    return float(best[len(best) // 2]) / STEPS


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> tuple[list, float]:
    """Forest and threshold from narrow statistics and the labels; labels are few beside the documents."""
    stats = stats.select(key, *COUNTS)
    marks = labels.groupBy(F.col(key).alias("_key")).agg(F.min(quality).alias("_quality"))
    labelled = stats.join(marks, F.col(key) == F.col("_key"))
    good = labelled.filter("_quality = 1")
    forest = fit_forest(good if good.limit(1).count() else stats, key)
    return forest, threshold(with_scores(labelled.select("_quality", *COUNTS), forest), "_quality")


def judged(stats: DataFrame, forest: list, limit: float) -> DataFrame:
    """Add ``base_failed, anomaly, kept``."""
    scored = with_scores(stats, forest)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))


def accepted_rows(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules and the forest accept.

    The fit reads narrow statistics; the rows then go through one mapper, which judges them from
    their text and passes on those it accepts.
    """
    narrow = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    forest, limit = fit(written_statistics(narrow), labels.select(F.col(key).alias("doc_id"), "quality"))
    place = df.columns.index(text)

    def run(incoming):
        hasher = WordHasher()
        for batch in incoming:
            for part in slices(batch.column(place)):
                counts = counts_of(part, hasher)
                kept = ~fails(counts) & (score_rows(forest, features(counts)) < limit)
                yield batch.slice(part.first, part.n).filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
