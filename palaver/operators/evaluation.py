"""Predictions against true labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.scalars import fixed


def join_truth(predictions: DataFrame, truth: DataFrame, key: str = "comment_id") -> DataFrame:
    """Predictions with their true labels."""
    return predictions.join(truth, key, "inner")


def _ratio(part: Column, whole: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(tp: Column, predicted: Column, actual: Column) -> Column:
    return _ratio(2 * tp, predicted + actual)


def label_report(df: DataFrame, labels: dict[str, tuple[str, str]]) -> DataFrame:
    """Precision, recall, F1 and support per label, then micro, macro, weighted and sample means.

    ``labels`` maps a label to its (true, predicted) 0/1 columns. The last row holds the share of
    rows with all labels right. One pass: a single aggregate row is turned into the report.
    """
    names = list(labels)
    hit = {k: F.col(t) * F.col(p) for k, (t, p) in labels.items()}
    row_hits = reduce(lambda a, b: a + b, hit.values())
    row_actual = reduce(lambda a, b: a + b, [F.col(t) for t, _ in labels.values()])
    row_predicted = reduce(lambda a, b: a + b, [F.col(p) for _, p in labels.values()])
    all_right = reduce(lambda a, b: a & b, [F.col(t) == F.col(p) for t, p in labels.values()])

    sums = []
    for i, (name, (true, predicted)) in enumerate(labels.items()):
        sums += [
            F.sum(hit[name]).cast("bigint").alias(f"tp{i}"),
            F.sum(predicted).cast("bigint").alias(f"pp{i}"),
            F.sum(true).cast("bigint").alias(f"ap{i}"),
        ]
    one = df.agg(
        *sums,
        F.avg(_ratio(row_hits, row_predicted)).alias("sp"),
        F.avg(_ratio(row_hits, row_actual)).alias("sr"),
        F.avg(_f1(row_hits, row_predicted, row_actual)).alias("sf"),
        F.avg(all_right.cast("double")).alias("exact"),
    )

    def total(prefix):
        return reduce(lambda a, b: a + b, [F.col(f"{prefix}{i}") for i in range(len(names))])

    def line(label, precision, recall, f1, support):
        return F.struct(
            F.lit(label).alias("label"), fixed(precision, 6).alias("precision"),
            fixed(recall, 6).alias("recall"), fixed(f1, 6).alias("f1"),
            support.cast("bigint").alias("support"),
        )

    per = []
    for i in range(len(names)):
        tp, pp, ap = F.col(f"tp{i}"), F.col(f"pp{i}"), F.col(f"ap{i}")
        per.append((_ratio(tp, pp), _ratio(tp, ap), _f1(tp, pp, ap), ap))
    tp, pp, ap = total("tp"), total("pp"), total("ap")

    def macro(j):
        return reduce(lambda a, b: a + b, [p[j] for p in per]) / len(per)

    def weighted(j):
        return _ratio(reduce(lambda a, b: a + b, [p[j] * p[3] for p in per]), ap)
    lines = [line(n, *p) for n, p in zip(names, per)]
    lines += [
        line("micro avg", _ratio(tp, pp), _ratio(tp, ap), _f1(tp, pp, ap), ap),
        line("macro avg", macro(0), macro(1), macro(2), ap),
        line("weighted avg", weighted(0), weighted(1), weighted(2), ap),
        line("samples avg", F.col("sp"), F.col("sr"), F.col("sf"), ap),
        line("subset accuracy", F.col("exact"), F.col("exact"), F.col("exact"), ap),
    ]
    return one.select(F.inline(F.array(*lines)))


def macro_f1(df: DataFrame, labels: dict[str, tuple[str, str]], epsilon: float = 1e-7) -> DataFrame:
    """Mean F1 over the labels from probabilities rounded half to even, with a small constant in
    every denominator. ``labels`` maps a label to its (true, probability) columns."""
    sums = []
    for i, (true, probability) in enumerate(labels.values()):
        p = F.bround(F.col(probability).cast("decimal(20,10)"), 0).cast("double")
        t = F.col(true).cast("double")
        sums += [F.sum(t * p).alias(f"tp{i}"), F.sum((1 - t) * p).alias(f"fp{i}"), F.sum(t * (1 - p)).alias(f"fn{i}")]
    scores = []
    for i in range(len(labels)):
        tp, fp, fn = F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}")
        precision, recall = tp / (tp + fp + epsilon), tp / (tp + fn + epsilon)
        scores.append(2 * precision * recall / (precision + recall + epsilon))
    mean = reduce(lambda a, b: a + b, scores) / len(scores)
    return df.agg(*sums).select(fixed(mean, 6).alias("macro_f1"))


def label_outcome(predicted_at: str, labelled_at: str, as_of: Column, within: str = "1 hour") -> Column:
    """What became of a prediction by ``as_of``: ``matched`` (a label within the limit before or after), ``late``, ``timed_out``, ``waiting``.

    A label without a prediction is ``unpredicted``.
    """
    span, at, labelled = F.expr(f"INTERVAL {within}"), F.col(predicted_at), F.col(labelled_at)
    return (
        F.when(at.isNull(), "unpredicted")
        .when(labelled.isNull(), F.when(as_of > at + span, "timed_out").otherwise("waiting"))
        .when((labelled >= at - span) & (labelled <= at + span), "matched").otherwise("late")
    )
