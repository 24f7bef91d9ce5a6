"""Rounding, ratio and time helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fixed(value, digits: int) -> Column:
    """Round half away from zero on the decimal text of a double, as SQL ``ROUND(x::numeric, n)``."""
    return F.round(as_column(value).cast("decimal(38,10)"), digits).cast("double")


def clamp(value, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), as_column(value)))


def tally(condition) -> Column:
    """``SUM(CASE WHEN c THEN 1 ELSE 0 END)``: NULL conditions count as no, NULL over no rows."""
    return F.sum(F.when(as_column(condition), F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def percentage(part, whole) -> Column:
    """``part / whole * 100`` in doubles; NULL when the whole is 0."""
    return as_column(part).cast("double") / F.nullif(as_column(whole), F.lit(0)).cast("double") * 100


def safe_timestamp(value) -> Column:
    """ISO text to a zone-less UTC timestamp; NULL when it is not one."""
    text = as_column(value)
    # Text without a zone is read as it stands, text with one is moved to UTC.
    zone = r"(?:Z|(?<=:\d{2}(?:\.\d{1,9})?)[+-]\d{2}(?::?\d{2})?)$"
    zoned = F.regexp_extract(text, zone, 0)
    local = F.regexp_replace(text, zone, "")
    base = F.try_to_timestamp_ntz(local) if hasattr(F, "try_to_timestamp_ntz") else local.try_cast("timestamp_ntz")
    sign = F.when(F.substring(zoned, 1, 1) == "-", 1).otherwise(-1)
    digits = F.regexp_replace(zoned, r"[^0-9]", "")
    past_hour = F.when(F.length(digits) == 4, F.substring(digits, 3, 2).try_cast("int")).otherwise(0)
    shift = F.when(
        F.length(digits) >= 2, sign * (F.substring(digits, 1, 2).try_cast("int") * 60 + past_hour),
    ).otherwise(0)
    return base + F.make_dt_interval(F.lit(0), F.lit(0), shift)


def hour_of(ts) -> Column:
    """Truncate a zone-less timestamp to the hour without going through the session time zone."""
    ts = as_column(ts)
    return day_of(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def day_of(ts) -> Column:
    return F.to_date(as_column(ts))


def week_of(ts) -> Column:
    """Monday of the week."""
    day = day_of(ts)
    return F.date_sub(day, F.weekday(day))


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def days(n) -> Column:
    return F.make_dt_interval(F.lit(n))


def hours(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def minutes(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def within(ts, as_of: Column, span: Column) -> Column:
    """``as_of - span <= ts <= as_of``: two plain comparisons that reach the Parquet scan."""
    ts = as_column(ts)
    return (ts >= as_of - span) & (ts <= as_of)
