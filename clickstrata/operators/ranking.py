"""Row-number operators and top-N.

``row_number() <= n`` filters let Spark cut every group to ``n`` rows before the
shuffle (WindowGroupLimit), so a group holding a third of the table reaches its
final task as ``n`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import as_col


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Earliest row per key.  List a tie-breaker last so reruns keep the same row."""
    return _first_rows(df, keys, [as_col(c).asc() for c in order_by], 1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Latest row per key."""
    return _first_rows(df, keys, [as_col(c).desc() for c in order_by], 1)


def latest_flag(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], out: str = "is_latest") -> DataFrame:
    """Marks the latest row per key with 1, every other with 0, keeping all rows.

    The latest order values are aggregated and joined back, so no single task
    sorts a whole group; rows tied on every order column are all marked.
    """
    top = df.groupBy(*keys).agg(F.max(F.struct(*[as_col(c) for c in order_by])).alias("_top"))
    probe = df.withColumn("_ord", F.struct(*[as_col(c) for c in order_by]))
    cond = reduce(lambda a, b: a & b, [probe[k].eqNullSafe(top[k]) for k in keys])
    joined = probe.join(top, cond, "left")
    return joined.select(*[probe[c] for c in df.columns], (F.col("_ord") == F.col("_top")).cast("int").alias(out))


def topn_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group in the given order, optionally with their rank."""
    w = Window.partitionBy(*group).orderBy(*order_by)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def count_by_key(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def top_items(df: DataFrame, item: str, n: int = 1000) -> DataFrame:
    """The ``n`` most frequent items overall: count descending, item ascending."""
    counts = count_by_key(df.where(F.col(item).isNotNull()), [item])
    return counts.orderBy(F.desc("cnt"), F.asc(item)).limit(n)


def top_items_by(df: DataFrame, group: str, item: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent items per non-blank group."""
    known = df.where((F.col(group).isNotNull()) & (F.col(group).cast("string") != ""))
    counts = count_by_key(known, [group, item])
    return topn_per_group(counts, [group], [F.desc("cnt"), F.asc(item)], n, rank_col="rn")


def share_of_total(df: DataFrame, measure: str, partition: Sequence[str], out: str, wide: bool = False) -> DataFrame:
    """``measure`` over its total per partition, part / total; null keys form one partition.

    Meant for aggregated rows.  By default one window over ``partition``, which
    reads ``df`` once: right when a partition has few rows (one user's days).
    ``wide=True`` is for few partitions with very many rows (one day's users):
    totals are aggregated map-side and joined back, so no task sees a whole
    partition; ``df`` is then evaluated twice, so persist or store it first.  An
    empty ``partition`` (share of everything) is always computed that way.
    """
    part = F.col(measure).cast("double")
    if not partition:
        total = df.agg(F.sum(measure).alias("_t"))
        return df.withColumn(out, F.try_divide(part, total.scalar().cast("double")))
    if not wide:
        total = F.sum(measure).over(Window.partitionBy(*partition)).cast("double")
        return df.withColumn(out, F.try_divide(part, total))
    totals = df.groupBy(*partition).agg(F.sum(measure).cast("double").alias("_t"))
    totals = totals.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(partition)], "_t")
    cond = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_p{i}")) for i, p in enumerate(partition)])
    joined = df.join(totals, cond, "left")
    return joined.select(*df.columns, F.try_divide(part, F.col("_t")).alias(out))


def drop_duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest in all other columns (the source order is arbitrary, this one is not)."""
    rest = [c for c in df.columns if c not in keys]
    return _first_rows(df, keys, [F.col(c).asc() for c in rest] or [F.lit(1)], 1)


@dataclass(frozen=True)
class Selection:
    """Rows where ``where`` holds; the first ``limit`` by ``order_by`` when given."""

    label: object
    where: Column
    order_by: Sequence[Column] = ()
    limit: int | None = None


def labelled_selections(df: DataFrame, selections: Sequence[Selection], label_col: str = "summary_type") -> DataFrame:
    """UNION ALL of labelled selections from one frame; a row can appear under several labels.

    All selections share the aggregation below them: Spark plans it once and
    reuses the exchange.
    """
    parts = []
    for s in selections:
        part = df.where(s.where)
        if s.limit is not None:
            part = part.orderBy(*s.order_by).limit(s.limit)
        parts.append(part.withColumn(label_col, F.lit(s.label)))
    return reduce(lambda a, b: a.unionByName(b), parts)
