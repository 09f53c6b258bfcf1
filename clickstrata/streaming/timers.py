"""Rows that wait in keyed state for their one match, each until it is certain or its time is over.

Unlike the log of :mod:`enrich` and the pairs of a stream join, the output has one row per waiting row and needs no
reduction on read; the state of a key is dropped when no further row can need it.  Timers run on event time, so a
replay gives the same rows whenever it runs.

Keys are dealt into groups, which share their state lists and timer, and lists hold blocks of rows: a call of the state, and each
entry that passes between Python and Spark, takes longer than the work on a row.  For the same reason rows of plain columns come and
go as text in whole frames; only rows with nested columns pass one by one.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from decimal import Decimal
from itertools import batched

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .enrich import _useful_clicks, _waiting

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A commit writes the changes of its batch; without it every partition of the state uploads its files.
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
SHUFFLE = "spark.sql.shuffle.partitions"
#: Groups of keys by default, and rows in one block of the state.
GROUPS = 8192
_ROWS = 10_000
#: Event times that fit a frame, in microseconds (1700 to 2262); the watermark goes no further, and there it stands for the end of time.
_FIRST, _LAST = -8_520_336_000_000_000, 9_214_646_400_000_000
#: Columns that pass as text and come back by a cast, and how texts of one compare.
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampNTZType)
_COMPARED = {T.IntegralType: int, T.FractionalType: float, T.DecimalType: Decimal}


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which timers and lists need.

    Each partition of the state opens and commits its files in every batch, rows or not, so a stream has as many as the shuffle
    setting says but at most ``partitions``: by default three a core, or 32 on a few cores.  A checkpoint keeps the number it began with.
    """
    most = partitions or max(32, 3 * spark.sparkContext.defaultParallelism)
    settings = {PROVIDER: ROCKSDB, CHANGES: "true", SHUFFLE: str(min(most, int(spark.conf.get(SHUFFLE))))}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _stored_type(f: T.StructField) -> T.StructField:
    """Times are kept as microseconds, so that no time zone of a Python process matters."""
    return T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType)


def _values(struct) -> tuple:
    """Fields of a struct column, which comes as a row or as a dictionary."""
    return tuple(struct.values() if isinstance(struct, dict) else struct)


class OrderClicks(StatefulProcessor):
    """The waiting orders and the recent clicks of a group of click ids.

    An order is certain once the watermark has passed it and a click before it is there, or has passed the first click after
    it; without a click it goes as it came when ``timeout`` is over.  With ``later=False`` only clicks before the order count, and
    all is certain when the watermark has passed it.  Each group has a timer at the earliest time at which something may be
    decided or dropped.
    """

    def __init__(self, order: T.StructType, fill: Sequence[str], timeout: int, later: bool = True):
        self.order, self.timeout, self.later = order, timeout, later
        self.fill = [order.fieldNames().index(f) for f in fill]
        self.row = Row(*order.fieldNames())
        self.compared = [lambda v: v for _ in fill]

    def init(self, handle: StatefulProcessorHandle) -> None:
        blocks = T.StructType([T.StructField("rows", T.BinaryType())])
        self.handle, self.looked_at = handle, set()
        self.orders, self.clicks = handle.getListState("orders", blocks), handle.getListState("clicks", blocks)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wake = []
        for orders, clicks in self._blocks(rows):
            for state, found in ((self.orders, orders), (self.clicks, clicks)):
                if found:
                    state.appendValue((pickle.dumps(found),))
            wake += [r[1] for r in (*orders, *clicks)]
            wake = [min(wake)] if wake else []
        if wake:
            self._wake(wake[0])
        return iter(())

    def _blocks(self, rows) -> Iterator[tuple[list[tuple], list[tuple]]]:
        """Orders and clicks of the input, each as its key, time and values."""
        for some in batched(rows, _ROWS):
            orders, clicks = [], []
            for r in some:
                if r["_order"] is not None:
                    orders.append((r["_key"], r["_at"], *_values(r["_order"])))
                elif r["_click"] is not None:
                    clicks.append((r["_key"], r["_at"], *_values(r["_click"])))
            yield orders, clicks

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # of a group's timers that expire in one batch the first has done it all
        if key in self.looked_at:
            return iter(())
        self.looked_at.add(key)
        now = self._now(timerValues)
        orders, clicks = self._rows(self.orders), self._rows(self.clicks)
        by_key: dict[str, tuple[list[tuple], list[tuple]]] = {}
        for order in orders:
            by_key.setdefault(order[0], ([], []))[0].append(order[1:])
        for click in clicks:
            if click[0] in by_key:
                by_key[click[0]][1].append(click[1:])
        settled, waiting, wake = [], [], []
        for k, (own, near) in by_key.items():
            done, still, again = self.settled(own, near, now)
            settled += done
            waiting += [(k, *order) for order in still]
            wake += again
        if settled:
            self._replace(self.orders, waiting)
        # an order still to come is later than the watermark, and takes no click further back than the timeout
        useful = [c for c in clicks if c[1] + self.timeout > now]
        if len(useful) < len(clicks):
            self._replace(self.clicks, useful)
        wake += [c[1] + self.timeout for c in useful]
        if wake:
            self._wake(min(wake))
        return iter(settled)

    def _rows(self, state) -> list[tuple]:
        return [row for (block,) in state.get() for row in pickle.loads(block)]

    def _replace(self, state, rows: list[tuple]) -> None:
        if rows:
            state.put([(pickle.dumps(some),) for some in batched(rows, _ROWS)])
        else:
            state.clear()

    def _now(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs() * 1000

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def settled(self, orders: list[tuple], clicks: list[tuple], now: int) -> tuple[list[Row], list[tuple], list[int]]:
        """Of one click id: orders decided at watermark ``now``, those that wait, and when to look at these again."""
        clicks = sorted((tuple(c) for c in clicks), key=lambda c: (c[0], [(v is not None, v if v is None else f(v)) for f, v in zip(self.compared, c[1:], strict=True)]))
        times = [c[0] for c in clicks]
        done, waiting, wake = [], [], []
        for order in orders:
            at, after = order[0], bisect_right(times, order[0])
            if now < at:
                again, chosen = at, None
            elif after and times[after - 1] >= at - self.timeout:
                again, chosen = None, clicks[bisect_left(times, times[after - 1])]
            elif not self.later:
                again, chosen = None, None
            elif after < len(times) and times[after] <= at + self.timeout:
                again, chosen = (times[after] if now < times[after] else None), clicks[after]
            else:
                again, chosen = (at + self.timeout if now < at + self.timeout else None), None
            if again is not None:
                waiting.append(tuple(order))
                wake.append(again)
                continue
            row = list(order[1:])
            for i, place in enumerate(self.fill):
                if chosen is not None and chosen[1 + i] is not None:
                    row[place] = chosen[1 + i]
            done.append(self.row(*row))
        return done, waiting, wake

    def close(self) -> None:
        pass


class OrderClickFrames(OrderClicks):
    """The same for frames of ``_group, _ts, _kind`` (0: order, 1: click), ``_key, _at`` and an order's columns, a click's among them, as text."""

    def __init__(self, order: T.StructType, fill: Sequence[str], timeout: int, later: bool, delay: int):
        super().__init__(order, fill, timeout, later)
        self.last = (_LAST - delay) // 1000
        self.row = lambda *values: values
        kinds = [order[f].dataType for f in fill]
        self.compared = [next((f for t, f in reversed(_COMPARED.items()) if isinstance(kind, t)), lambda v: v) for kind in kinds]

    def _blocks(self, rows) -> Iterator[tuple[list[tuple], list[tuple]]]:
        for frame in rows:
            kinds, keys, at, *values = (frame.iloc[:, i].tolist() for i in range(2, frame.shape[1]))
            at = [int(a) for a in at]
            found = {0: zip(keys, at, *values, strict=True), 1: zip(keys, at, *[values[i] for i in self.fill], strict=True)}
            yield tuple([r for k, r in zip(kinds, found[kind], strict=True) if k == kind] for kind in found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for some in batched(super().handleExpiredTimer(key, timerValues, expiredTimerInfo), _ROWS):
            yield pd.DataFrame(list(some), columns=[f"_{i}" for i in range(len(self.order))], dtype=object)

    def _now(self, timerValues) -> int:
        now = timerValues.getCurrentWatermarkInMs()
        return now * 1000 if now < self.last else 1 << 62

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(min(-(-at // 1000), self.last))


def timeout_micros(spark: SparkSession, timeout: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {timeout})")).first()[0]


def _packed(df: DataFrame) -> tuple[T.StructType, Column]:
    """All columns as one struct for the state, and its type."""
    cols = [(F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name) for f in df.schema.fields]
    return T.StructType([_stored_type(f) for f in df.schema.fields]), F.struct(*cols)


def _matched(waiting: DataFrame, key: Column, ts: str, found: DataFrame, fill: Sequence[str], timeout: str, delay: str, ticks: DataFrame | None, later: bool, groups: int | None) -> DataFrame:
    """Each row of ``waiting`` once, its columns ``fill`` from one of ``found`` (``_k, _cts, _f_…``), by :class:`OrderClicks`."""
    payload, packed = _packed(waiting)
    span, group = timeout_micros(waiting.sparkSession, timeout), lambda k: k if groups is None else F.pmod(F.xxhash64(k), F.lit(groups))
    if all(isinstance(f.dataType, _PLAIN) for f in payload.fields):
        out = _in_frames(waiting, payload, key, ts, found, fill, span, delay, ticks, later, group)
    else:
        found_type = T.StructType([payload[f] for f in fill])
        none = lambda t: F.lit(None).cast(t)
        rows = waiting.select(key.cast("string").alias("_key"), F.col(ts).alias("_ts"), packed.alias("_order"), none(found_type).alias("_click"))
        rows = rows.union(found.select(F.col("_k").cast("string"), "_cts", none(payload), F.struct(*[F.col(f"_f_{f}").cast(payload[f].dataType).alias(f) for f in fill])))
        if ticks is not None:
            rows = rows.union(ticks.select(F.lit(""), "ts", none(payload), none(found_type)))
        rows = rows.withWatermark("_ts", delay).withColumns({"_at": F.unix_micros("_ts"), "_group": group(F.col("_key"))})
        out = rows.groupBy("_group").transformWithState(OrderClicks(payload, list(fill), span, later), payload, "append", "eventTime")
    return out.select(*[(F.timestamp_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name) for f in waiting.schema.fields])


def _text(c: Column, kind: T.DataType) -> Column:
    """A value that frames carry unchanged, null or not."""
    return c if isinstance(kind, T.BinaryType) else c.cast("string")


def _in_frames(waiting: DataFrame, payload: T.StructType, key: Column, ts: str, found: DataFrame, fill: Sequence[str], span: int, delay: str, ticks: DataFrame | None, later: bool, group) -> DataFrame:
    """``waiting`` with its columns stored as ``payload``, by :class:`OrderClickFrames`."""
    _, packed = _packed(waiting)
    kinds, micros = {f.name: f.dataType for f in payload.fields}, lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    named = lambda made: [made(f).alias(f"_{i}") for i, f in enumerate(kinds)]
    row = lambda kind, k, at, made: [F.lit(kind).alias("_kind"), k.cast("string").alias("_key"), at.alias("_at"), *named(made)]
    none = lambda f: F.lit(None).cast("binary" if isinstance(kinds[f], T.BinaryType) else "string")
    rows = waiting.select(*row(0, key, micros(ts), lambda f: _text(packed.getField(f), kinds[f])))
    rows = rows.union(found.select(*row(1, F.col("_k"), micros("_cts"), lambda f: _text(F.col(f"_f_{f}").cast(kinds[f]), kinds[f]) if f in fill else none(f))))
    if ticks is not None:
        rows = rows.union(ticks.select(*row(2, F.lit(""), micros("ts"), none)))
    time = F.when(F.col("_at").isNotNull(), F.timestamp_micros(F.greatest(F.lit(_FIRST), F.least(F.lit(_LAST), "_at"))))
    rows = rows.select(group(F.col("_key")).alias("_group"), time.alias("_ts"), "_kind", "_key", F.col("_at").cast("string").alias("_at"), *named(lambda f: F.col(f"_{list(kinds).index(f)}")))
    rows = rows.withWatermark("_ts", delay)
    carried = T.StructType([T.StructField(f"_{i}", T.BinaryType() if isinstance(k, T.BinaryType) else T.StringType()) for i, k in enumerate(kinds.values())])
    processor = OrderClickFrames(payload, list(fill), span, later, timeout_micros(waiting.sparkSession, delay))
    out = rows.groupBy("_group").transformWithStateInPandas(processor, carried, "append", "eventTime")
    return out.select(*[F.col(f"_{i}").cast(k).alias(f) for i, (f, k) in enumerate(kinds.items())])


def orders_on_time(
    orders: DataFrame, clicks: DataFrame, key: str = "click_id", order_ts: str = "ts", click_ts: str = "ts",
    fill: Sequence[str] = ("plan_id", "creative_id"), timeout: str = "20 minutes", delay: str | None = None, ticks: DataFrame | None = None,
    groups: int | None = GROUPS,
) -> DataFrame:
    """Every order once: with the latest click of its id before it, else the first after it, within ``timeout``; or as it came.

    Orders that need no click pass at once.  The others come out when the watermark, ``delay`` (by default the
    timeout) behind the newest row, has passed what decides them; rows further out of order are dropped by Spark, as in
    any stream with a watermark.  ``ticks``, a stream with a column ``ts``, moves the watermark on when orders and clicks pause.
    Start the query within :func:`rocksdb_state`, in append mode.

    ``groups``, fixed for the life of a checkpoint, is how many groups the click ids are dealt into (``None``: each id is its own).
    A timer reads the rows of its group that are within ``delay`` and timeout, in one task: many short batches, or very many
    rows at once, want more groups; fewer groups make fewer calls.
    """
    waiting, passing = _waiting(orders, key, fill)
    useful = _useful_clicks(clicks, key, click_ts, fill)
    return passing.unionByName(_matched(waiting, F.col(key), order_ts, useful, fill, timeout, delay or timeout, ticks, True, groups))


def latest_before(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, carry: Sequence[str], within: str,
    delay: str | None = None, ticks: DataFrame | None = None, groups: int | None = GROUPS,
) -> DataFrame:
    """Every left row once, with ``carry`` of the latest right row of its key at or before it, at most ``within`` back; null if there is none.

    Rows meet on the key and a time cell as long as ``within``, a right row also in the cell after its own, so the state of
    a busy key is dealt over its cells.  Of right rows of one time the smallest values count, nulls first.  A null key has no
    match, and such rows pass at once.  ``delay``, ``ticks``, ``groups`` and how to start the query: as for :func:`orders_on_time`.
    """
    length = F.lit(timeout_micros(left.sparkSession, within))
    cell = lambda ts: F.floor(F.unix_micros(ts) / length)
    named = lambda k, c: F.concat_ws("|", c.cast("string"), F.col(k).cast("string"))
    types = {f.name: f.dataType for f in right.schema.fields}
    wide = left.withColumns({c: F.lit(None).cast(types[c]) for c in carry})
    there = right.where(F.col(key).isNotNull()).withColumn("_cell", F.explode(F.array(cell(right_ts), cell(right_ts) + 1)))
    found = there.select(named(key, F.col("_cell")).alias("_k"), F.col(right_ts).alias("_cts"), *[F.col(c).alias(f"_f_{c}") for c in carry])
    matched = _matched(wide.where(F.col(key).isNotNull()), named(key, cell(left_ts)), left_ts, found, carry, within, delay or within, ticks, False, groups)
    return matched.unionByName(wide.where(F.col(key).isNull()))
