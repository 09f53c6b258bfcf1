"""Funnel assembly: many event logs → one row per key with one measure per log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import as_col

AGGS = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


@dataclass(frozen=True)
class FactSpec:
    """One log's share of a funnel.

    ``keys`` and ``measures`` map output names to per-row expressions.  A
    measure is what one row contributes: ``F.lit(1)`` counts rows,
    ``F.when(cond, 1)`` counts matching rows, a price column sums it.
    """

    df: DataFrame
    keys: Mapping[str, Column | str]
    measures: Mapping[str, Column | str]
    where: Column | None = None

    def rows(self) -> DataFrame:
        df = self.df if self.where is None else self.df.where(self.where)
        return df.select(
            *[as_col(c).alias(n) for n, c in self.keys.items()],
            *[as_col(c).alias(n) for n, c in self.measures.items()],
        )


def measure_names(facts: Sequence[FactSpec]) -> list[str]:
    return list(dict.fromkeys(m for f in facts for m in f.measures))


def merge_funnel(
    facts: Sequence[FactSpec],
    keys: Sequence[str],
    ops: Mapping[str, str] | None = None,
    fill: object | None = 0,
) -> DataFrame:
    """Union of all logs, then one aggregation per key.

    Rows are projected, not aggregated, before the union: Spark combines them
    map-side above the union, so every log crosses the network once, already
    reduced to one row per key and task.  Measures absent from a log are null
    there and do not contribute.  ``ops`` overrides ``sum`` per measure; ``fill``
    replaces a measure no log contributed to (``None`` keeps the null).
    """
    ops = ops or {}
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.rows() for f in facts])
    aggs = []
    for name in measure_names(facts):
        agg = AGGS[ops.get(name, "sum")](name)
        aggs.append((agg if fill is None else F.coalesce(agg, F.lit(fill))).alias(name))
    return rows.groupBy(*keys).agg(*aggs)


def rollup(df: DataFrame, keys: Sequence[str], measures: Sequence[str], op: str = "sum", ops: Mapping[str, str] | None = None) -> DataFrame:
    """Re-aggregate already aggregated measures to coarser keys."""
    ops = ops or {}
    return df.groupBy(*keys).agg(*[AGGS[ops.get(m, op)](m).alias(m) for m in measures])


@dataclass(frozen=True)
class Agg:
    """One pivoted aggregate: over rows of ``event`` (a code, or several), ``op`` of ``value``."""

    event: str | Sequence[str]
    op: str = "count"
    value: Column | str | None = None
    extra: Column | None = field(default=None)


def event_pivot(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Agg | Column], event: Column | str = "logtype"
) -> DataFrame:
    """Per key, one conditional aggregate per output column, in a single pass over a multi-event log."""
    event_col = as_col(event)
    cols = []
    for name, a in aggs.items():
        if isinstance(a, Column):
            cols.append(a.alias(name))
            continue
        codes = [a.event] if isinstance(a.event, str) else list(a.event)
        cond = event_col == codes[0] if len(codes) == 1 else event_col.isin(codes)
        if a.extra is not None:
            cond = cond & a.extra
        if a.op == "count":
            col = F.count_if(cond)
        else:
            func = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}[a.op]
            col = func(F.when(cond, as_col(a.value)))
        cols.append(col.alias(name))
    return df.groupBy(*keys).agg(*cols)


def segment_uv_pv(
    df: DataFrame,
    keys: Sequence[str],
    visitor: Mapping[str, tuple[Column, Column]],
    views: Mapping[str, Column],
) -> DataFrame:
    """Distinct visitors and row counts per segment.

    ``visitor`` maps an output to (segment condition, visitor id), ``views`` maps
    an output to a condition.  Instead of one distinct aggregate per output,
    which replicates every row, rows are first reduced to one per (key, ids,
    conditions); both the first and the second step combine map-side, so a hot
    key or a hot visitor cannot fill a task.
    """
    ids = {f"_id{i}": F.when(cond, vid) for i, (cond, vid) in enumerate(visitor.values())}
    flags = {f"_pv{i}": F.coalesce(cond, F.lit(False)).cast("bigint") for i, cond in enumerate(views.values())}
    rows = df.select(*keys, *[c.alias(n) for n, c in ids.items()], *[c.alias(n) for n, c in flags.items()])
    first = rows.groupBy(*keys, *ids).agg(*[F.sum(f).alias(f) for f in flags])
    return first.groupBy(*keys).agg(
        *[F.count_distinct(F.col(n)).alias(out) for n, out in zip(ids, visitor)] if len(ids) > 1
        else [F.count(F.col(n)).alias(out) for n, out in zip(ids, visitor)],
        *[F.sum(f).alias(out) for f, out in zip(flags, views)],
    )


def daily_uv(df: DataFrame, keys: Sequence[str], visitor: Column, out: str = "uv") -> DataFrame:
    """Distinct non-null visitors per key, as two combined aggregations."""
    pairs = df.select(*keys, visitor.alias("_v")).groupBy(*keys, "_v").agg(F.lit(1).alias("_one"))
    return pairs.groupBy(*keys).agg(F.count("_v").alias(out))


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def intersect_ids(a: DataFrame, b: DataFrame, normalise=None) -> DataFrame:
    """Distinct ids present in both single-column frames, after ``normalise`` (e.g. md5)."""
    def prep(df: DataFrame) -> DataFrame:
        c = F.col(df.columns[0])
        return df.select((normalise(c) if normalise else c).alias("id"))

    return prep(a).intersect(prep(b))


def split_list_rows(df: DataFrame, list_col: str, out: str, sep: str = ",") -> DataFrame:
    """One row per element of a separated list; a null list gives no row."""
    return df.withColumn(out, F.explode(F.split(F.col(list_col), sep, -1)))
