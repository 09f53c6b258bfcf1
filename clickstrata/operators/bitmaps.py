"""Distinct counts over any days from daily bitmaps, without reading the logs again.

Every id gets a number once; a day's ids of a kind are then bitmaps of 32,768 numbers each, built where the rows are.
Any set of days is the union of its bitmaps, so a further question costs as many small rows as days and buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Numbers in one bitmap of Spark's bitmap functions.
BITS = 32_768


def number_ids(df: DataFrame, kind: str, id_: str, known: DataFrame | None = None) -> DataFrame:
    """``kind, id, number``: a number for every non-null id of a kind; those ``known`` keep theirs.

    Numbers follow each other within a task, so that bitmaps are dense.  The driver sees the largest number so far.
    """
    ids = df.select(F.col(kind).alias("kind"), F.col(id_).alias("id")).where("id IS NOT NULL").distinct()
    base = 0
    if known is not None:
        ids = ids.join(known.select(F.col("kind").alias("_k"), F.col("id").alias("_i")), F.col("kind").eqNullSafe(F.col("_k")) & (F.col("id") == F.col("_i")), "left_anti")
        base = ((known.agg(F.max("number")).first()[0] or 0) // BITS + 1) * BITS
    fresh = written(ids.withColumn("number", F.monotonically_increasing_id() + F.lit(base)), "id-numbers")
    return fresh if known is None else known.union(fresh)


def daily_bitmaps(df: DataFrame, day: str, kind: str, id_: str, numbers: DataFrame) -> DataFrame:
    """``day, kind, bucket, bits``: the ids of each day and kind.

    Rows are first reduced to one per (day, kind, id), so a day on which one id has most rows costs no more than another.
    """
    seen = df.select(F.col(day).cast("string").alias("day"), F.col(kind).alias("_k"), F.col(id_).alias("_i")).where("_i IS NOT NULL").distinct()
    at = seen.join(numbers, F.col("_k").eqNullSafe(F.col("kind")) & (F.col("_i") == F.col("id")))
    return at.groupBy("day", "kind", F.expr(f"number div {BITS}").alias("bucket")).agg(F.bitmap_construct_agg(F.expr(f"number % {BITS}")).alias("bits"))


def _counted(unions: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return unions.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))


def distinct_ids(bitmaps: DataFrame, days: Sequence[str] | None = None, out: str = "cnt") -> DataFrame:
    """``kind, out``: different ids over all days or the given ones."""
    if days is not None:
        bitmaps = bitmaps.where(F.col("day").isin(list(days)))
    return _counted(bitmaps.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")), ["kind"], out)


def rolling_distinct(bitmaps: DataFrame, length: int, out: str = "cnt") -> DataFrame:
    """``kind, day, out``: different ids of the ``length`` days up to each day on which the kind was seen.

    A day's bitmaps are repeated for the ``length`` windows that hold it, not its ids.
    """
    ends = bitmaps.select("kind", "day").distinct()
    spread = bitmaps.withColumn("_end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.date_add(F.col("day").cast("date"), i).cast("string"))))
    unions = spread.groupBy("kind", F.col("_end").alias("_d"), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = _counted(unions, ["kind", "_d"], out).withColumnRenamed("kind", "_k")
    return ends.join(counts, F.col("kind").eqNullSafe(F.col("_k")) & (F.col("day") == F.col("_d"))).select("kind", "day", out)


def seen_on_both(bitmaps: DataFrame, day: str, other: str, out: str = "both") -> DataFrame:
    """``kind, out``: ids of a kind seen on each of two days; what the two days have together less their union."""
    a, b, union = (distinct_ids(bitmaps, days, "n") for days in ([day], [other], [day, other]))
    parts = a.select("kind", F.col("n").alias("s")).union(b).union(union.select("kind", -F.col("n")))
    return parts.groupBy("kind").agg(F.sum("s").alias(out))
