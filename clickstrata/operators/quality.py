"""Retention, geography coverage, sampled distributions, score reports, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import is_blank
from ..session import written
from .features import join_null_safe
from .ranking import topn_per_group


def retention_overlap(df: DataFrame, day: str, kind: str, id_: str, days: Sequence[str] | None = None) -> DataFrame:
    """Ids seen on one (``days_seen`` = 1) or both (2) of each pair of neighbouring days of their kind.

    ``rn`` is the rank of the later day among the days of the kind; the last value,
    one past the end, holds the final day alone.  ``days`` restricts the rows to those days.
    Days are ranked in a table of one row per kind and day.
    """
    rows = df.select(F.col(kind), F.col(id_), F.col(day).cast("string").alias("_d")).where(F.col("_d").isNotNull())
    if days is not None:
        rows = rows.where(F.col("_d").isin(list(days)))
    rank = F.dense_rank().over(Window.partitionBy(kind).orderBy("_d"))
    ranked = rows.select(kind, "_d").distinct().withColumn("_p", rank)
    seen = join_null_safe(rows.distinct(), ranked, [kind, "_d"])
    pairs = seen.withColumn("rn", F.explode(F.array(F.col("_p"), F.col("_p") + 1)))
    per_id = pairs.groupBy(kind, id_, "rn").agg(F.count(F.lit(1)).alias("days_seen"))
    return per_id.groupBy(kind, "rn", "days_seen").agg(F.count(F.lit(1)).alias("ids"))


def day_counts(df: DataFrame, day: str, kind: str) -> DataFrame:
    return df.groupBy(day, kind).agg(F.count(F.lit(1)).alias("cnt"))


def distinct_over_days(df: DataFrame, day: str, kind: str, id_: str, days: Sequence[str] | None = None) -> DataFrame:
    """Distinct ids per kind over all days or the given ones."""
    if days is not None:
        df = df.where(F.col(day).cast("string").isin(list(days)))
    return df.select(kind, id_).distinct().groupBy(kind).agg(F.count(id_).alias("cnt"))


def geo_precision(df: DataFrame, levels: Sequence[str], key: str | None = None) -> DataFrame:
    """How many rows (or distinct keys) are known down to each level; a level counts only if those above are known."""
    if key is not None:
        df = df.select(key, *levels).distinct()
    known = None
    cols = [F.count(F.lit(1)).alias("total")]
    for level in levels:
        ok = ~(is_blank(level) | (F.upper(F.col(level)) == "NULL"))
        known = ok if known is None else known & ok
        cols.append(F.count_if(known).alias(f"{level}_known"))
    return df.agg(*cols)


def frequency_label(n: Column) -> Column:
    """Count → range label: 1..5 as is, then '6,7,8', '9,10', '>10'."""
    return F.when(n <= 5, n.cast("string")).when(n <= 8, "6,7,8").when(n <= 10, "9,10").otherwise(">10")


def bucket_with_sample(df: DataFrame, keys: Sequence[str], id_: str, n: int = 10) -> DataFrame:
    """Ids per (keys, frequency range): how many, and the ``n`` smallest as a sample.

    Samples come from a ranked cut before the shuffle; the count is a separate
    aggregation over the same per-id counts.
    """
    per_id = df.groupBy(*keys, id_).agg(F.count(F.lit(1)).alias("_n"))
    labelled = per_id.select(*keys, id_, frequency_label(F.col("_n")).alias("range"))
    group = [*keys, "range"]
    counts = labelled.groupBy(*group).agg(F.count(F.lit(1)).alias("cnt"))
    kept = topn_per_group(labelled, group, [F.col(id_).asc()], n)
    samples = kept.groupBy(*group).agg(F.concat_ws(",", F.sort_array(F.collect_list(id_)).cast("array<string>")).alias("sample"))
    return join_null_safe(counts, samples, group)


def confusion_report(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = (0.5, 0.4)) -> DataFrame:
    """Confusion counts and rates per threshold, all thresholds in one pass over the rows."""
    truth = F.col(label) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(score) >= t
        aggs += [
            F.count_if(truth & pred).alias(f"tp{i}"), F.count_if(~truth & pred).alias(f"fp{i}"),
            F.count_if(~truth & ~pred).alias(f"tn{i}"), F.count_if(truth & ~pred).alias(f"fn{i}"),
        ]
    one = df.agg(*aggs)
    rows = one.select(F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{m}{i}").alias(m) for m in ("tp", "fp", "tn", "fn")])
        for i, t in enumerate(thresholds)
    ])))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return rows.select(
        "*", F.try_divide(tp, tp + fn).alias("tpr"), F.try_divide(fp, fp + tn).alias("fpr"),
        F.try_divide(tn, tn + fp).alias("tnr"), F.try_divide(fn, fn + tp).alias("fnr"),
    )


def score_histogram(df: DataFrame, score: str, buckets_per_unit: int = 10) -> DataFrame:
    """Rows per score bucket (0.1 wide by default), their share, and the share at or above 0.5 of all rows."""
    # Decimal arithmetic: 0.3 must fall into bucket 0.3, not 0.2.
    index = F.floor(F.col(score).cast("decimal(20,10)") * buckets_per_unit)
    counts = df.where(F.col(score).isNotNull()).groupBy(index.cast("int").alias("_b")).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.agg(
        F.sum("cnt").cast("double").alias("n"),
        F.sum(F.when(F.col("_b") * 2 >= buckets_per_unit, F.col("cnt")).otherwise(0)).cast("double").alias("high"),
    )
    return counts.select(
        (F.col("_b") / buckets_per_unit).alias("bucket"), "cnt",
        F.try_divide(F.col("cnt").cast("double"), totals.select("n").scalar()).alias("rate"),
        F.try_divide(totals.select("high").scalar(), totals.select("n").scalar()).alias("share_high"),
    )


def exact_percentile(df: DataFrame, value: str, q: float, accuracy: int = 1_000_000, cells: int = 1024, rows_at_once: int = 1_000_000) -> DataFrame:
    """Exact interpolated percentile of a whole column without sorting it in one place.

    A quantile sketch brackets the answer; one aggregation counts the values below the bracket and in each of ``cells``
    equal parts of it.  While the parts that hold the two ranks asked for have more than ``rows_at_once`` rows, they
    become the next bracket; then their values are counted and ranked.
    The driver sees brackets and the counts of their parts.
    """
    v = F.col(value).cast("double")
    rows = df.select(v.alias("v")).where(F.col("v").isNotNull())
    slack = 2.0 / accuracy
    lo, hi = rows.agg(F.percentile_approx("v", max(0.0, q - slack), accuracy), F.percentile_approx("v", min(1.0, q + slack), accuracy)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([(None,)], "percentile double")
    position = before = None
    while True:
        width = (hi - lo) / cells
        inner = F.least(F.floor((F.col("v") - lo) / width), F.lit(cells - 1)) if width > 0 else F.lit(0)
        cell = F.when(F.col("v") < lo, -1).when(F.col("v") > hi, cells).otherwise(inner).cast("int")
        counts = sorted((r["cell"], r["n"], r["lo"], r["hi"]) for r in rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        if position is None:
            position = (sum(c[1] for c in counts) - 1) * q
        ranks, upto, wanted, skipped = {int(position), math.ceil(position)}, 0, [], 0
        for c in counts:
            if any(upto <= k < upto + c[1] for k in ranks):
                wanted.append(c)
                skipped = upto if len(wanted) == 1 else skipped
            upto += c[1]
        before = skipped
        inside = rows.where(cell.isin([c[0] for c in wanted]))
        bracket = (min(c[2] for c in wanted), max(c[3] for c in wanted))
        if sum(c[1] for c in wanted) <= rows_at_once or bracket == (lo, hi) or bracket[0] == bracket[1]:
            break
        lo, hi = bracket
    # A short frequency table, cumulated in value order; the parts wanted are neighbours.
    cum = inside.groupBy("v").agg(F.count(F.lit(1)).alias("f")).withColumn("upto", F.sum("f").over(Window.orderBy("v")) + before)
    a, b = (F.min(F.when(F.col("upto") > k, F.col("v"))) for k in (int(position), math.ceil(position)))
    return cum.agg(a.alias("_a"), b.alias("_b")).select((F.col("_a") + (F.col("_b") - F.col("_a")) * (position - int(position))).alias("percentile"))


def order_statistics(
    df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], out: str = "percentile", rows_per_range: int = 1_000_000, most_ranges: int = 4096,
) -> DataFrame:
    """``keys…, q, out``: exact interpolated percentiles of every key, all ``qs`` at once.

    Values are counted per key, so equal ones are one row, and dealt into ranges of (key, value) by sampled splitters: a key of
    any size is spread over as many ranges as it needs.  The counts of the ranges tell which of them hold a rank that is
    wanted; only these go on, split again until none has more than ``rows_per_range`` values, and are cumulated, each range for
    itself.  The driver sees the number of values and the size of the largest range.  Null keys are a key, null values are left out.
    """
    groups = [f"_k{i}" for i in range(len(keys))]
    named = df.select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    # one column to join on, in which null is a value
    rows = named.groupBy(F.struct(F.lit(0).alias("_"), *groups).alias("_key"), "_v").agg(F.count(F.lit(1)).alias("_f")).withColumns({"_range": F.lit(0), "_before": F.lit(0).cast("bigint")})
    rows = written(rows, "frequencies")
    last = (F.sum("_f").cast("bigint") - 1).alias("_last")
    spots = rows.groupBy("_key").agg(last).select("_key", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"), (F.col("_last") * F.col("q")).alias("_at"))
    ranks = written(spots.select("_key", "q", "_at", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank")), "ranks")
    left = rows.count()
    while True:
        parts = min(most_ranges, max(1, math.ceil(left / rows_per_range)))
        rows = written(rows.drop("_range").repartitionByRange(parts, "_key", "_v").withColumn("_range", F.spark_partition_id()), "ranges")
        sizes = rows.groupBy("_key", "_range", "_before").agg(F.sum("_f").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"))
        # what was split further has its own count of smaller values; its pieces follow each other in value
        upto = F.sum("_n").over(Window.partitionBy("_key", "_before").orderBy("_lo"))
        placed = sizes.withColumn("_start", F.col("_before") + upto - F.col("_n"))
        held = placed.join(ranks.select("_key", "_rank").distinct(), "_key").where("_start <= _rank AND _rank < _start + _n")
        wanted = written(held.groupBy("_key", "_range", "_before").agg(F.first("_start").alias("_start"), F.first("_rows").alias("_rows")), "wanted-ranges")
        rows = rows.join(wanted, ["_key", "_range", "_before"]).select("_key", "_v", "_f", "_range", F.col("_start").alias("_before"))
        left, largest = wanted.agg(F.sum("_rows"), F.max("_rows")).first()
        if left is None or largest <= rows_per_range or parts == 1:
            break
        rows = written(rows, "kept-ranges")
    upto = F.sum("_f").over(Window.partitionBy("_key", "_range", "_before").orderBy("_v")) + F.col("_before")
    cum = rows.withColumn("_upto", upto)
    found = cum.join(ranks, "_key").where("_upto - _f <= _rank AND _rank < _upto")
    a, b = F.min("_v"), F.max("_v")
    done = found.groupBy("_key", "q", "_at").agg(a.alias("_a"), b.alias("_b"))
    return done.select(
        *[F.col(f"_key.{g}").alias(k) for k, g in zip(keys, groups)], "q",
        (F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))).alias(out),
    )


def grouped_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """Exact interpolated percentile per key, keys of any size."""
    return order_statistics(df, keys, value, [q], out).drop("q")
