"""Orders waiting for their click."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import is_blank


def _lacks_all(cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        cond = is_blank(c) if cond is None else cond & is_blank(c)
    return cond


def _waiting(orders: DataFrame, key: str, fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(orders that need a click, orders that pass through)."""
    needs = ~is_blank(key) & _lacks_all(fill)
    return orders.where(needs), orders.where(~needs)


def _useful_clicks(clicks: DataFrame, key: str, ts: str, fill: Sequence[str]) -> DataFrame:
    kept = clicks.where(~is_blank(key) & ~_lacks_all(fill))
    return kept.select(F.col(key).alias("_k"), F.col(ts).alias("_cts"), *[F.col(c).alias(f"_f_{c}") for c in fill])


def _near_pairs(waiting: DataFrame, clicks: DataFrame, key: str, order_ts: str, timeout: str) -> DataFrame:
    span = F.expr(f"interval {timeout}")
    return waiting.join(clicks, (F.col(key) == F.col("_k")) & F.col("_cts").between(F.col(order_ts) - span, F.col(order_ts) + span))


def click_order_enrich(
    orders: DataFrame, clicks: DataFrame, key: str = "click_id", order_ts: str = "ts", click_ts: str = "ts",
    fill: Sequence[str] = ("plan_id", "creative_id"), timeout: str = "20 minutes", delay: str | None = None,
) -> DataFrame:
    """Streaming: a log of every order as it came, with a null ``click_time``, and of every click it may take.

    Orders without plan and creative may take those of a click with the same id, at most ``timeout`` of
    event time before or after.  Nothing waits for a timer: an order is in the log at once, and each
    match when its second half arrives, so :func:`settled_orders` of the log has every order at any time.
    The matches are an inner stream-stream join bounded in time: Spark keeps its state and drops it behind
    the watermark, and with it what arrives more than ``delay`` of event time behind the newest rows of the
    slower side.  Up to that lateness, ``timeout`` by default, the log does not depend on how the stream is
    cut into batches; sources that are further out of order need a larger ``delay``.
    """
    delay = timeout if delay is None else delay
    waiting, _ = _waiting(orders, key, fill)
    c = _useful_clicks(clicks, key, click_ts, fill).withWatermark("_cts", delay)
    pairs = _near_pairs(waiting.withWatermark(order_ts, delay), c, key, order_ts, timeout)
    taken = pairs.select(*[F.col(f"_f_{c}").alias(c) if c in fill else F.col(c) for c in orders.columns], F.col("_cts").alias("click_time"))
    return orders.withColumn("click_time", F.lit(None).cast("timestamp")).unionByName(taken)


def _choice(order_ts: Column, click_ts: Column) -> list[Column]:
    """Sorts the clicks of an order: the latest before it, else the first one after it."""
    gap = F.abs(click_ts.cast("double") - order_ts.cast("double"))
    return [(click_ts > order_ts).alias("after"), gap.alias("gap")]


def settled_orders(log: DataFrame, order_id: str = "order_id", order_ts: str = "ts", fill: Sequence[str] = ("plan_id", "creative_id")) -> DataFrame:
    """One row per order of a log of :func:`click_order_enrich`: with its best click, or as it came."""
    cols = [c for c in log.columns if c not in (order_id, "click_time", "batch")]
    entry = F.struct(F.col("click_time").isNull().alias("bare"), *_choice(F.col(order_ts), F.col("click_time")), *fill, F.struct(*cols).alias("row"))
    return log.groupBy(order_id).agg(F.min(entry).alias("_o")).select(order_id, "_o.row.*")


def _filled(joined: DataFrame, cols: Sequence[str], fill: Sequence[str]) -> DataFrame:
    return joined.select(*[F.coalesce(F.col(f"_f_{c}"), F.col(c)).alias(c) if c in fill else F.col(c) for c in cols])


def enrich_orders(
    orders: DataFrame, clicks: DataFrame, order_id: str = "order_id", key: str = "click_id", order_ts: str = "ts",
    click_ts: str = "ts", fill: Sequence[str] = ("plan_id", "creative_id"), timeout: str = "20 minutes",
) -> DataFrame:
    """Batch twin: the latest click of the same id before the order, else the first one after it, within ``timeout``.

    Clicks of one time are taken by their values.  Only (order id, click id, time) meet the clicks; whole
    orders are joined to their one chosen click afterwards.
    """
    waiting, passing = _waiting(orders, key, fill)
    pairs = _near_pairs(waiting.select(order_id, key, order_ts), _useful_clicks(clicks, key, click_ts, fill), key, order_ts, timeout)
    best = F.min(F.struct(*_choice(F.col(order_ts), F.col("_cts")), *[f"_f_{f}" for f in fill]))
    first = pairs.groupBy(order_id).agg(best.alias("_c")).select(order_id, *[F.col(f"_c._f_{f}").alias(f"_f_{f}") for f in fill])
    return passing.unionByName(_filled(waiting.join(first, order_id, "left"), orders.columns, fill))
