"""Item lists per visitor and frequent item sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def cookie_items(
    df: DataFrame, user: str, item: str, group: str | None = None, lo: int = 2, hi: int | None = 200, as_text: bool = True
) -> DataFrame:
    """Distinct items of every visitor who has ``lo``..``hi`` of them, overall or within each non-blank ``group``.

    Visitors above ``hi`` are left out by definition, so each is followed only
    up to ``hi + 1`` distinct items: that many prove the excess and bound every
    list, however many rows a visitor has.  ``hi=None`` sets no upper limit: every visitor is
    listed in full.
    """
    keys = [user] if group is None else [group, user]
    if group is not None:
        df = df.where(F.col(group).isNotNull() & (F.col(group).cast("string") != ""))
    pairs = df.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(*keys, item).distinct()
    if hi is not None:
        w = Window.partitionBy(*keys).orderBy(item)
        pairs = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= hi + 1)
    lists = pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("items"))
    n = F.size("items")
    kept = lists.where(n >= lo if hi is None else n.between(lo, hi)).withColumn("n_items", n)
    return kept.withColumn("items", F.concat_ws(",", F.col("items").cast("array<string>"))) if as_text else kept


def users_per_item_stats(df: DataFrame, item: str, user: str) -> DataFrame:
    """Largest, smallest, mean and median number of distinct visitors per item.

    Items are first counted per number of visitors, so the exact median is taken
    over that short frequency table.
    """
    per_item = df.select(item, user).distinct().groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    freq = per_item.groupBy("n").agg(F.count(F.lit(1)).alias("f"))
    return freq.agg(
        F.max("n").alias("max_cnt"),
        F.min("n").alias("min_cnt"),
        F.try_divide(F.sum(F.col("n") * F.col("f")).cast("double"), F.sum("f").cast("double")).alias("avg_cnt"),
        F.percentile("n", F.lit(0.5), F.col("f")).alias("mid_cnt"),
    )


def extreme_items(df: DataFrame, item: str) -> DataFrame:
    """The most and the least frequent item with their counts; the smallest id wins a tie."""
    counts = df.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min(F.struct((-F.col("n")).alias("o"), F.col(item).alias("i"))).alias("_max"),
        F.min(F.struct(F.col("n").alias("o"), F.col(item).alias("i"))).alias("_min"),
    ).select(
        F.col("_max.i").alias("max_item"),
        (-F.col("_max.o")).alias("max_cnt"),
        F.col("_min.i").alias("min_item"),
        F.col("_min.o").alias("min_cnt"),
    )


def freq_itemsets(baskets: DataFrame, items: str, support: float, confidence: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """FP-Growth over an array column: (item sets with frequency, association rules).

    Runs the distributed mining job of the ML library.
    """
    from pyspark.ml.fpm import FPGrowth

    model = FPGrowth(itemsCol=items, minSupport=support, minConfidence=confidence).fit(baskets)
    return model.freqItemsets, model.associationRules


def candidate_sets(frequent: DataFrame, k: int) -> DataFrame:
    """``items, last``: sets of ``k`` items all of whose subsets of ``k - 1`` are among the ``items`` of ``frequent``.

    Two frequent sets that differ in their last item only make a candidate, whose beginning and last item are told apart;
    the other subsets, each without one of the items before these two, are looked up one after the other.
    """
    sets = frequent.select("items", F.slice("items", 1, k - 2).alias("head"), F.element_at("items", -1).alias("last"))
    other = sets.select("head", F.col("last").alias("next"))
    pairs = sets.join(other, "head").where("last < next").select("items", F.col("next").alias("last"))
    for i in range(k - 2):
        without = F.concat(F.slice("items", 1, i), F.slice("items", i + 2, k), F.array("last"))
        pairs = pairs.withColumn("_sub", without).join(frequent.select(F.col("items").alias("_sub")), "_sub", "left_semi").drop("_sub")
    return pairs


def apriori(baskets: DataFrame, items: str, support: float, longest: int = 8) -> DataFrame:
    """``items, freq``: the sets of up to ``longest`` items found in at least ``support`` of all baskets, level by level.

    Equal baskets are one row with a weight.  A level keeps which of its frequent sets a basket holds; the next one
    extends these by the last items of the candidates that begin with them, and keeps what a semi-join finds in the
    basket.  Pairs are counted from the frequent items of a basket, so only pairs that occur are
    looked at; lists are expected to be bounded, as those of :func:`cookie_items` are.  Every level is a written
    table; the driver learns the number of baskets and whether a level is empty.  Null items and baskets are left out, repeated items count once.
    """
    lists = F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))
    rows = baskets.where(F.col(items).isNotNull()).groupBy(lists.alias("all")).agg(F.count(F.lit(1)).alias("w"))
    rows = written(rows.withColumn("basket", F.monotonically_increasing_id()), "baskets")
    least = math.ceil((rows.agg(F.sum("w")).first()[0] or 0) * support)

    def frequent(held: DataFrame, k: int) -> DataFrame:
        counts = held.groupBy("items").agg(F.sum("w").alias("freq"))
        return written(counts.where((F.col("freq") >= max(1, least)) & (F.size("items") == k)), f"frequent-{k}")

    single = rows.select("basket", "w", F.explode("all").alias("item"))
    level = frequent(single.select("w", F.array("item").alias("items")), 1)
    single = written(single.join(level.select(F.col("items")[0].alias("item")), "item", "left_semi").select("basket", "item", "w"), "frequent-items")
    found, held = [level], single.select("basket", "w", F.array("item").alias("items"))
    for k in range(2, longest + 1):
        if level.isEmpty():
            break
        if k == 2:
            pair = single.select("basket", "w", F.col("item").alias("first")).join(single.select("basket", "item"), "basket").where("first < item")
            grown = pair.select("basket", "w", F.array("first", "item").alias("items"))
        else:
            more = held.join(candidate_sets(level, k), "items").withColumnRenamed("last", "item")
            more = more.join(single.select("basket", "item"), ["basket", "item"], "left_semi")
            grown = more.select("basket", "w", F.concat("items", F.array("item")).alias("items"))
        grown = written(grown, f"grown-{k}")
        level = frequent(grown, k)
        held = written(grown.join(level.select("items"), "items", "left_semi").select("basket", "w", "items"), f"held-{k}") if k < longest else grown
        found.append(level)
    whole = found[0]
    for f in found[1:]:
        whole = whole.union(f)
    return whole.select("items", "freq")


def top_overlap(df: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """Hits and distinct visitors per key."""
    pairs = df.groupBy(*keys, user).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(*keys).agg(F.sum("_n").alias("hits"), F.count(user).alias("users"))
