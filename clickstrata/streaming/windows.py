"""Windowed counts, rankings and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import topn_per_group

# Event codes counted by the delivery report.
DELIVERY_EVENTS = {"req_num": "0", "success_num": "1", "fail_num": "2", "imp_cnt": "3"}


def _flat(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, out)


def tumbling_counts(df: DataFrame, ts: str, keys: Sequence[str], size: str = "1 hour", delay: str | None = None, out: str = "n") -> DataFrame:
    """Rows per key and tumbling event-time window.

    For a stream give ``delay`` (out-of-orderness plus allowed lateness, e.g.
    ``2 minutes 5 seconds``) and write in update mode into a replacing sink:
    every late row re-emits its window's total.
    """
    if delay is not None:
        df = df.withWatermark(ts, delay)
    counted = df.groupBy(F.window(ts, size).alias("window"), *keys).agg(F.count(F.lit(1)).alias(out))
    return _flat(counted, keys, out)


def tumbling_pv(df: DataFrame, ts: str, keys: Sequence[str] = ("template_id", "code", "msg", "carrier"), size: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Page views per hour window and key, with the hour as a label."""
    counts = tumbling_counts(df, ts, keys, size, delay, "pv")
    return counts.withColumn("hour", F.date_format("window_start", "yyyy-MM-dd HH"))


def pane_counts(df: DataFrame, ts: str, keys: Sequence[str], slide: str, delay: str | None = None, out: str = "n") -> DataFrame:
    """Rows per key and pane of one slide.

    The streaming half of sliding windows: written in update mode to a replacing sink, the panes are complete
    up to the newest row at any time, and :func:`slide_panes` on read gives every window, the open ones too.
    """
    if delay is not None:
        df = df.withWatermark(ts, delay)
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias(out))
    return panes.select(F.col("pane.start").alias("pane_start"), *keys, out)


def slide_panes(panes: DataFrame, keys: Sequence[str], size: str, slide: str, out: str = "n") -> DataFrame:
    """Window totals from the counts of :func:`pane_counts`; ``size`` is a multiple of ``slide``."""
    slid = panes.groupBy(F.window("pane_start", size, slide).alias("window"), *keys).agg(F.sum(out).alias(out))
    return _flat(slid, keys, out)


def sliding_counts(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str, delay: str | None = None, out: str = "n"
) -> DataFrame:
    """Rows per key and sliding event-time window.

    Rows are first counted per pane of one slide; only those counts are
    repeated for the ``size / slide`` windows a pane belongs to (1440 of them for
    2 hours by 5 seconds), never the rows.  ``size`` must be a multiple of
    ``slide``.  As a stream this is two chained aggregations: append mode.
    """
    if delay is not None:
        df = df.withWatermark(ts, delay)
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    slid = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window"), *keys).agg(F.sum("_n").alias(out))
    return _flat(slid, keys, out)


def sliding_blacklist(
    df: DataFrame, ts: str, key: str, size: str = "7 days", slide: str = "1 day", threshold: int = 4,
    delay: str | None = None, prefix: str = "bl:ip",
) -> DataFrame:
    """Keys seen at least ``threshold`` times in a window, with the list key to publish."""
    return blacklisted(sliding_counts(df, ts, [key], size, slide, delay), key, threshold, prefix)


def blacklisted(counts: DataFrame, key: str, threshold: int = 4, prefix: str = "bl:ip") -> DataFrame:
    """The window counts of at least ``threshold``, with the list key to publish."""
    return counts.where(F.col("n") >= threshold).withColumn("list_key", F.concat_ws(":", F.lit(prefix), F.col(key).cast("string")))


def rank_windows(counts: DataFrame, item: str, n: int, group: Sequence[str] = (), count: str = "n") -> DataFrame:
    """Top ``n`` items per window (and group): count descending, item ascending.

    For the batches of an append-mode windowed stream, where a window's rows all
    arrive in the batch that closes it.
    """
    return topn_per_group(counts, ["window_start", "window_end", *group], [F.desc(count), F.asc(item)], n, rank_col="rn")


def sliding_topn(df: DataFrame, ts: str, item: str, size: str = "2 hours", slide: str = "5 seconds", n: int = 10) -> DataFrame:
    """Static form: the ``n`` most frequent items of every sliding window."""
    return rank_windows(sliding_counts(df, ts, [item], size, slide), item, n)


def trending(counts: DataFrame, channel: str, item: str, n_channel: int = 100, n_all: int = 1000) -> tuple[DataFrame, DataFrame]:
    """From counts per (window, channel, item): the top items per channel, and over all channels."""
    per_channel = rank_windows(counts, item, n_channel, [channel])
    overall = counts.groupBy("window_start", "window_end", item).agg(F.sum("n").alias("n"))
    return per_channel, rank_windows(overall, item, n_all)


def trending_counts(df: DataFrame, ts: str, channel: str, item: str, size: str = "120 minutes", slide: str = "1 minute", delay: str | None = None) -> DataFrame:
    return sliding_counts(df, ts, [channel, item], size, slide, delay)


def event_counters(df: DataFrame, keys: Sequence[str], event: str = "event", codes: Mapping[str, str] = DELIVERY_EVENTS) -> DataFrame:
    """One count column per event code.  Apply per micro-batch and add up in the store."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(event) == code).alias(name) for name, code in codes.items()])


def running_count(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    """Counts since the start of the stream (complete or update mode); the state holds one counter per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def words(df: DataFrame, value: str = "value", out: str = "word") -> DataFrame:
    """Non-empty words of text lines."""
    return df.select(F.explode(F.split(F.trim(value), r"\s+")).alias(out)).where(F.col(out) != "")


def join_streams(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, delay: str = "0 seconds") -> DataFrame:
    """Inner join on ``key`` of rows at most ``within`` apart; the bound lets Spark drop old state.

    Rows meet on the key and a time cell as long as the bound, the right side being repeated for the cells on
    either side, so the rows of a busy key are dealt over its cells.
    """
    l = left.withWatermark(left_ts, delay) if left.isStreaming else left
    r = right.withWatermark(right_ts, delay) if right.isStreaming else right
    r = r.withColumnsRenamed({key: f"_r_{key}", right_ts: f"_r_{right_ts}"})
    span = F.expr(f"interval {within}")
    length = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {within})")
    cell = lambda ts: F.floor(F.unix_micros(ts) / length)
    l = l.withColumn("_cell", cell(F.col(left_ts)))
    there = cell(F.col(f"_r_{right_ts}"))
    r = r.withColumn("_r_cell", F.explode(F.array(there - 1, there, there + 1)))
    cond = (F.col(key) == F.col(f"_r_{key}")) & (F.col("_cell") == F.col("_r_cell")) & F.col(f"_r_{right_ts}").between(F.col(left_ts) - span, F.col(left_ts) + span)
    return l.join(r, cond).drop(f"_r_{key}", "_cell", "_r_cell").withColumnRenamed(f"_r_{right_ts}", f"right_{right_ts}")
