"""Dimension look-ups, membership tests and the IP range join.

Join strategy is Spark's: no side is force-broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import as_col, blank_to
from ..functions.identity import ip_to_long
from ..session import written


@dataclass(frozen=True)
class DimSpec:
    """Look up ``values`` (``{output: dimension column}``) by ``fact_key = dim_key``.

    A miss or a blank gives ``default``; ``default=None`` leaves it null.  With
    ``fallback_to_key`` a miss keeps the fact's own key value instead.
    """

    df: DataFrame
    fact_key: str
    dim_key: str
    values: Mapping[str, str]
    default: object = "-1"
    fallback_to_key: bool = False


def one_row_per_key(dim: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Dimension reduced to one row per non-null key, so a look-up never multiplies facts."""
    dim = dim.where(F.col(key).isNotNull())
    carried = [v for v in dict.fromkeys(values) if v != key]
    return dim.groupBy(key).agg(*[F.max(v).alias(v) for v in carried]) if carried else dim.select(key).distinct()


def lookup_dims(fact: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """Chain of equi LEFT joins name → id.  All fact columns are kept; outputs replace same-named ones at the end."""
    fact_cols = fact.columns
    outputs: dict[str, Column] = {}
    for i, spec in enumerate(specs):
        key = f"_k{i}"
        dim = one_row_per_key(spec.df, spec.dim_key, list(spec.values.values()))
        dim = dim.select(
            F.col(spec.dim_key).alias(key),
            *[F.col(src).alias(f"_v{i}_{out}") for out, src in spec.values.items()],
        )
        fact = fact.join(dim, F.col(spec.fact_key) == F.col(key), "left")
        for out in spec.values:
            found = F.col(f"_v{i}_{out}")
            if spec.fallback_to_key:
                found = F.coalesce(found.cast("string"), F.col(spec.fact_key).cast("string"))
            elif spec.default is not None:
                found = blank_to(found.cast("string"), spec.default) if isinstance(spec.default, str) else F.coalesce(found, F.lit(spec.default))
            outputs[out] = found.alias(out)
    kept = [F.col(c) for c in fact_cols if c not in outputs]
    return fact.select(*kept, *outputs.values())


def keep_known(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, extra: Sequence[object] = ("-1",)) -> DataFrame:
    """Facts whose key is in the dimension or among ``extra`` literals (drops garbled keys)."""
    known = dim.select(F.col(dim_key).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    marked = fact.join(known, F.col(fact_key) == F.col("_known"), "left")
    keep = F.col("_known").isNotNull()
    if extra:
        keep = keep | F.col(fact_key).isin(list(extra))
    return marked.where(keep).select(*fact.columns)


def conditional_lookup(
    fact: DataFrame, cases: Sequence[tuple[Column, str, DataFrame, str, str]], out: str, default: str = ""
) -> DataFrame:
    """Name from a different dimension per condition: ``(when, fact_key, dim, dim_key, value)``.

    The condition nulls the join key of rows it does not concern, so each case
    is a plain equi join.
    """
    cols = fact.columns
    result = None
    for i, (when, fact_key, dim, dim_key, value) in enumerate(cases):
        lookup = one_row_per_key(dim, dim_key, [value]).select(
            F.col(dim_key).cast("string").alias(f"_k{i}"), F.col(value).alias(f"_n{i}")
        )
        fact = fact.withColumn(f"_f{i}", F.when(when, F.col(fact_key).cast("string")))
        fact = fact.join(lookup, F.col(f"_f{i}") == F.col(f"_k{i}"), "left")
        name = F.coalesce(F.col(f"_n{i}"), F.lit(default))
        result = F.when(when, name) if result is None else result.when(when, name)
    return fact.select(*cols, result.otherwise(F.lit(default)).alias(out))


def left_join_blocks(base: DataFrame, blocks: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """LEFT joins of aggregated blocks, each on its own key list."""
    for block, keys in blocks:
        base = base.join(block, list(keys), "left")
    return base


def backfill_measure(base: DataFrame, block: DataFrame, keys: Sequence[str], measure: str, default: object = 0) -> DataFrame:
    """LEFT join of one measure on many keys; a miss becomes ``default``."""
    block = block.select(*keys, F.col(measure).alias("_m"))
    joined = base.join(block, list(keys), "left")
    return joined.select(*[c for c in base.columns if c != measure], F.coalesce("_m", F.lit(default)).alias(measure))


def is_blacklisted(df: DataFrame, blacklist: DataFrame, keys: Sequence[str], flag: str = "listed") -> DataFrame:
    """Adds a boolean: whether the row's (kind, value) keys are in ``blacklist``."""
    listed = blacklist.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(listed, list(keys), "left")
    return joined.select(*df.columns, F.coalesce("_hit", F.lit(False)).alias(flag))


def blacklist_counts(df: DataFrame, blacklist: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group: rows whose keys are / are not listed.

    Rows are counted per (group, key) before the join, so a value that fills a
    large share of the log crosses the network once per task, not once per row.
    """
    dims = list(dict.fromkeys([*group, *keys]))
    counted = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))
    marked = is_blacklisted(counted, blacklist, keys)
    return marked.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(F.col("listed"), F.col("_n"))), F.lit(0)).alias("exists_cnt"),
        F.coalesce(F.sum(F.when(~F.col("listed"), F.col("_n"))), F.lit(0)).alias("not_exists_cnt"),
    )


def in_set(df: DataFrame, members: DataFrame, col: str, member_col: str) -> DataFrame:
    """Rows whose ``col`` is among the values of ``members``."""
    wanted = members.select(F.col(member_col).alias("_w")).where(F.col("_w").isNotNull())
    return df.join(wanted, F.col(col) == F.col("_w"), "left_semi")


def request_id_join(responses: DataFrame, requests: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Distinct columns of requests that got a response.

    Only membership matters, so the response side is reduced to a semi join
    instead of producing one row per pair.
    """
    return requests.join(responses.select(key), key, "left_semi").select(*columns).distinct()


def ip_geo_join(
    df: DataFrame,
    ranges: DataFrame,
    ip: str,
    values: Sequence[str],
    start: str = "ip_start",
    end: str = "ip_end",
    prefix_bits: int = 16,
) -> DataFrame:
    """IP → range attributes, nulls when no range holds it.

    ``ranges`` has non-overlapping inclusive numeric bounds.  Both sides are
    keyed by the leading ``prefix_bits`` of the address (a range is repeated for
    each prefix it touches, at most ``2**prefix_bits`` times), which turns the
    range test into an equi join whose residual condition leaves at most one
    range per row.  Rows are read and moved once, or not at all when the ranges
    are small enough for Spark to broadcast; a busy prefix is split by the skew
    join handling.
    """
    width = 1 << (32 - prefix_bits)
    r = ranges.select(F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_e"), *values)
    r = r.withColumn("_rp", F.explode(F.sequence(F.floor(F.col("_s") / width), F.floor(F.col("_e") / width))))
    rows = df.select(*[c for c in df.columns if c not in values], ip_to_long(ip).alias("_n"))
    rows = rows.withColumn("_p", F.floor(F.col("_n") / width))
    cond = (F.col("_p") == F.col("_rp")) & F.col("_n").between(F.col("_s"), F.col("_e"))
    return rows.join(r, cond, "left").drop("_n", "_p", "_rp", "_s", "_e")


def last_start(points: DataFrame, ranges: DataFrame, point: str, start: str, values: Sequence[str]) -> DataFrame:
    """``point`` and ``values``: every different point with the values of the greatest ``start`` at or below it; nulls when there is none.

    Points and starts are sorted together in ranges of their common order, and the last start is carried along.  What a range of
    the order begins with is the last start of those before it: one row per range of the order is put in front.
    """
    held = F.struct(F.col(start).cast("bigint").alias("_s"), *values)
    starts = ranges.where(F.col(start).isNotNull()).select(held.alias("_h")).select(F.col("_h._s").alias("_at"), F.lit(0).alias("_point"), "_h")
    asked = points.select(F.col(point).cast("bigint").alias("_at")).where("_at IS NOT NULL").distinct()
    both = starts.union(asked.select("_at", F.lit(1), F.lit(None).cast(starts.schema["_h"].dataType)))
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(both.repartitionByRange(parts, "_at").withColumn("_part", F.spark_partition_id()), "points-and-starts")
    ends = dealt.groupBy("_part").agg(F.max(F.when(F.col("_point") == 0, F.struct("_at", "_h"))).alias("_end"))
    # one row per range of the order, of which there are as many as shuffle partitions
    before = ends.select("_part", F.max("_end").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_b"))
    front = before.where("_b IS NOT NULL").select(F.col("_b._at").alias("_at"), F.lit(0).alias("_point"), F.col("_b._h").alias("_h"), "_part")
    # within a range of the order a window cannot be split, so it is a partition of its own
    along = Window.partitionBy("_part").orderBy("_at", "_point").rowsBetween(Window.unboundedPreceding, 0)
    carried = dealt.unionByName(front).withColumn("_l", F.last("_h", ignorenulls=True).over(along))
    return carried.where("_point = 1").select(F.col("_at").alias(point), F.col("_l._s").alias(start), *[F.col(f"_l.{v}").alias(v) for v in values])


def ip_as_of_join(df: DataFrame, ranges: DataFrame, ip: str, values: Sequence[str], start: str = "ip_start", end: str = "ip_end") -> DataFrame:
    """:func:`ip_geo_join` for ranges of any width: each address takes the last range that starts at or below it, if it also holds it.

    No range is repeated, and an address is looked up once however many rows have it.  ``ranges`` don't overlap.
    """
    rows = df.select(*[c for c in df.columns if c not in values], ip_to_long(ip).alias("_n"))
    found = last_start(rows, ranges, "_n", start, [end, *values]).where(F.col("_n") <= F.col(end)).select(F.col("_n").alias("_f"), *values)
    return rows.join(found, F.col("_n") == F.col("_f"), "left").drop("_n", "_f")


def build_link_dim(tags: DataFrame, links: DataFrame, on: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Tag map LEFT JOIN link → one look-up table; ``on`` maps tag columns to link columns."""
    cond = None
    for left, right in on.items():
        c = tags[left] == links[right]
        cond = c if cond is None else cond & c
    return tags.join(links, cond, "left").select(*keep)


def max_per_key_lookup(base: DataFrame, mapping: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """LEFT join of the greatest value per key, e.g. a plan's media and slot."""
    best = mapping.groupBy(key).agg(*[F.max(v).alias(v) for v in values])
    return base.join(best, key, "left")


def discover_dimension(df: DataFrame, name: Column | str, known: DataFrame, known_col: str, max_len: int | None = None) -> DataFrame:
    """Names seen in a log that the dimension does not have yet (column ``name``)."""
    seen = df.select(as_col(name).cast("string").alias("name")).where((F.col("name") != ""))
    if max_len is not None:
        seen = seen.where(F.length("name") < max_len)
    return seen.distinct().join(known.select(F.col(known_col).alias("name")), "name", "left_anti")
