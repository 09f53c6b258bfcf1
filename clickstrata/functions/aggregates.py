"""Conditional aggregates, guarded ratios and the most-frequent-value aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column, value: Column | str) -> Column:
    """Sum of ``value`` where ``cond``; null when no row qualifies."""
    return F.sum(F.when(cond, as_col(value)))


def avg_where(cond: Column, value: Column | str) -> Column:
    return F.avg(F.when(cond, as_col(value)))


def ratio(num: Column, den: Column) -> Column:
    """Division as double; null when the divisor is null or zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def round_places(c: Column, places: int) -> Column:
    """Half-up rounding of a double at its nine-place decimal value, so that 0.225 held as 0.22499999999 rounds up."""
    return F.round(c.cast("decimal(30,9)"), places).cast("double")


def latest_value(value: Column | str, time: Column | str, where: Column | None = None) -> Column:
    """``value`` of the row with the greatest ``time``; equal times fall back to the greatest value, so reruns agree."""
    pair = F.struct(as_col(time).alias("t"), as_col(value).alias("v"))
    return F.max(F.when(where, pair) if where is not None else pair).getField("v")
