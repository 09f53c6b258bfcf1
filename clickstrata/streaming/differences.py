"""Rankings of sliding windows from differences: a pane counts once where it enters and once where it leaves.

Windows of two hours that slide by five seconds hold each pane 1,440 times.  Here a pane of one slide adds its
count at the first window that holds it and takes it away behind the last one; between two such changes all windows
have the same ranking, which is told once, with the number of windows that it is true for.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

_ROWS = 10_000


def micros(interval: str) -> Column:
    return F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {interval})")


def pane_changes(panes: DataFrame, keys: Sequence[str], size: str, slide: str, cut: str, out: str = "n") -> DataFrame:
    """``part, keys…, at, delta``: how a key's count changes from one window to the next, windows named by their start (microseconds).

    ``panes`` has one row per key and slide with ``pane_start`` and a count.  Windows are dealt into parts as
    long as ``cut``; what is in a window when its part begins is added there, so parts can be swept apart.  A pane gives
    its two differences and one more for each beginning of a part within its ``size``.
    """
    start, length, step, part = F.unix_micros("pane_start"), micros(size), micros(slide), micros(cut)
    enters, leaves = start - length + step, start + step
    floor = lambda x: ((x - F.pmod(x, part)) / part).cast("bigint")
    first, last = floor(enters), floor(leaves - 1)
    at = panes.select(*keys, F.col(out).alias("n"), enters.alias("enters"), leaves.alias("leaves"), F.explode(F.sequence(first, last)).alias("part"))
    begins, ends = F.greatest("enters", F.col("part") * part), F.least("leaves", (F.col("part") + 1) * part)
    rows = at.select("part", *keys, F.inline(F.array(
        F.struct(begins.alias("at"), F.col("n").alias("delta")),
        F.struct(ends.alias("at"), (-F.col("n")).alias("delta")),
    )))
    return rows.groupBy("part", *keys, "at").agg(F.sum("delta").alias("delta")).where("delta <> 0")


def sweep(changes: Iterable[tuple], n: int) -> Iterator[tuple]:
    """Group, window, next change, item, count and rank: the ``n`` first after every change; ``changes`` (group, window, item, delta) come in order.

    The counts of a group's items are kept in order, count descending and item ascending; a change moves its items only.
    """
    for group, of_group in groupby(changes, key=lambda c: c[0]):
        counts: dict = {}
        order: list[tuple] = []
        held: tuple | None = None
        for at, changed in groupby(of_group, key=lambda c: c[1]):
            if held is not None:
                yield from ((group, held[0], at, item, -less, rank) for rank, (less, item) in enumerate(held[1], 1))
            for _, _, item, delta in changed:
                before = counts.pop(item, 0)
                if before:
                    del order[bisect_left(order, (-before, item))]
                if before + delta:
                    counts[item] = before + delta
                    insort(order, (-before - delta, item))
            held = (at, order[:n])


def top_by_changes(panes: DataFrame, item: str, size: str, slide: str, n: int, group: Sequence[str] = (), cut: str | None = None, out: str = "n") -> DataFrame:
    """The ``n`` most frequent items of every sliding window: ``window_start, windows, group…, item, n, rn``.

    A row is true for the ``windows`` windows from ``window_start`` on, one slide apart; it ends where any count of the
    group changes, and where a part of length ``cut`` (by default ``size``) ends.  Equal counts go by item.  ``size`` is a
    multiple of ``slide``, ``cut`` of ``slide``; rows with a null item or group are left out.

    Changes are summed per item and window before the shuffle and sorted in their partition; a task holds the
    items of one part's current window, so memory follows the items of a window, not the windows.
    """
    cut = cut or size
    keys = [*group, item]
    known = panes.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    changes = pane_changes(known, keys, size, slide, cut, out)
    ordered = ["part", *group, "at", item]
    parts = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = changes.repartitionByRange(parts, "part", *group).sortWithinPartitions(*ordered).select(*ordered, "delta")
    names = [*group, "at", "until", item, "n", "rn"]
    types = [to_arrow_type(dealt.schema[c].dataType) for c in group] + [pa.int64(), pa.int64(), to_arrow_type(dealt.schema[item].dataType), pa.int64(), pa.int32()]
    width = len(group)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

        for of, at, until, what, count, rank in sweep(((r[: width + 1], *r[width + 1 :]) for r in rows), n):
            held.append((*of[1:], at, until, what, count, rank))
            if len(held) == _ROWS:
                yield batch()
                held = []
        if held:
            yield batch()

    schema = ", ".join(f"`{k}` {dealt.schema[k].dataType.simpleString()}" for k in group)
    swept = dealt.mapInArrow(per_partition, f"{schema}{', ' if group else ''}at bigint, until bigint, `{item}` {dealt.schema[item].dataType.simpleString()}, n bigint, rn int")
    windows = ((F.col("until") - F.col("at")) / micros(slide)).cast("bigint")
    return swept.select(F.timestamp_micros("at").alias("window_start"), windows.alias("windows"), *group, item, "n", "rn")
