"""Row rules, key checks, defaults and write-time labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palaver import schemas, values


def in_unit_range(name: str) -> Column:
    return (F.col(name) >= 0) & (F.col(name) <= 1)


def result_rules(columns) -> dict[str, Column]:
    """The table constraints that apply to the given columns, by name."""
    rules = {}
    for name in ("toxicity_score", *values.SUB_SCORES, "sentiment_score"):
        if name in columns:
            rules[f"{name}_range"] = in_unit_range(name)
    if "label" in columns:
        rules["label_domain"] = F.col("label").isin(*values.LABELS)
    if "sentiment" in columns:
        rules["sentiment_domain"] = F.col("sentiment").isin(*values.SENTIMENTS)
    if "period_type" in columns:
        rules["period_type_domain"] = F.col("period_type").isin(*values.PERIOD_TYPES)
    if "keyword" in columns:
        rules["keyword_length"] = F.length("keyword") <= 100
    for name in ("post_id", "comment_id", "comment", "metric_name", "metric_value", "keyword"):
        if name in columns:
            rules[f"{name}_not_null"] = F.col(name).isNotNull()
    return rules


def check_rows(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``reasons``: the names of the broken rules. A rule that gives NULL is not broken."""
    rules = result_rules(df.columns) if rules is None else rules
    broken = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reasons", F.filter(F.array(*broken), lambda r: r.isNotNull()))


def split_rows(df: DataFrame, rules=None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reasons."""
    checked = check_rows(df, rules)
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys with more than one row. NULL keys are unique by definition and are left out."""
    known = df
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    counted = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def with_defaults(df: DataFrame, schema=schemas.RESULT_WIDE, defaults=None) -> DataFrame:
    """Bring a frame to the table's columns: an omitted column takes its default, else NULL.

    A column that is present keeps its NULLs, as an explicit NULL does in SQL.
    """
    defaults = schemas.RESULT_DEFAULTS if defaults is None else defaults
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            out.append(F.col(field.name))
        else:
            out.append(F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name))
    return df.select(*out)


def replace_nulls(df: DataFrame, defaults=None) -> DataFrame:
    """The same defaults for explicit NULLs, for sources that cannot omit a column."""
    defaults = schemas.RESULT_DEFAULTS if defaults is None else defaults
    return df.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns
    ])


def write_time_labels(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Label, flag and review mark by score; a missing or blank sentiment by its score.

    A NULL score counts as not toxic; the review mark is only ever set here, never cleared.
    """
    toxic = F.coalesce(F.col("toxicity_score") >= threshold, F.lit(False))
    by_score = (
        F.when(F.col("sentiment_score") >= 0.6, "positive")
        .when(F.col("sentiment_score") <= 0.4, "negative")
        .otherwise("neutral")
    )
    blank = F.coalesce(F.col("sentiment"), F.lit("")) == ""
    yes, no = values.LABELS
    changes = {
        "is_toxic": toxic,
        "label": F.when(toxic, yes).otherwise(no),
        "sentiment": F.when(blank, by_score).otherwise(F.col("sentiment")),
    }
    if "requires_review" in df.columns:
        changes["requires_review"] = F.when(toxic, F.lit(True)).otherwise(F.col("requires_review"))
    return df.withColumns(changes)
