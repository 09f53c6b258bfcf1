"""Behaviour features of several grains and day ranges from one table of mergeable partial results.

The table has a row per (kind, day, keys, attribute, value) with counts, sums and extremes, from one pass over the logs.
Any grain and any days are sums over it; a daily job adds its own day and reads those before.  Greatest and most frequent texts are
ranked, never aggregated, so all aggregations of rows are hash aggregations of numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .features import BehaviourSpec, click_timing, join_null_safe

KINDS = ("req", "imp", "clk")
#: Attributes besides the columns of the logs: the whole row, the click's second.
TOTAL, SECOND = "", "_second"


def behaviour_partials(log: DataFrame, kind: str, day: str, keys: Sequence[str], spec: BehaviourSpec = BehaviourSpec()) -> DataFrame:
    """``kind, day, keys…, attr, val, n, ps, pn, px, pm`` of a log whose ``kind`` column says req, imp or clk.

    Requests have the attributes of ``mode_cols`` and ``max_cols``, the others the creative, clicks their second too, and all ``apps`` if
    it is given.  Rows are first compacted to one per (keys, attributes), since a device repeats them on almost every line.
    """
    is_kind = {k: F.col(kind) == k for k in KINDS}
    of = {a: ["req"] for a in [*spec.mode_cols, *spec.max_cols]} | {spec.creative: ["imp", "clk"]} | ({spec.apps: list(KINDS)} if spec.apps else {})
    cols = {a: F.when(reduce(lambda x, y: x | y, [is_kind[k] for k in kinds]), F.col(a).cast("string")) for a, kinds in of.items()}
    cols[SECOND] = F.when(is_kind["clk"], F.col(spec.time).try_cast("bigint")).cast("string")
    of[SECOND] = ["clk"]
    price = F.when(is_kind["req"], F.col(spec.req_price).try_cast("double")).when(is_kind["imp"], F.col(spec.price).try_cast("double"))
    names = {a: f"_a{i}" for i, a in enumerate(cols)}
    rows = log.where(F.col(kind).isin(list(KINDS))).select(F.col(kind).alias("kind"), F.col(day).alias("day"), *keys, *[c.alias(names[a]) for a, c in cols.items()], price.alias("_p"))
    compact = rows.groupBy("kind", "day", *keys, *names.values()).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_p").alias("ps"), F.count("_p").alias("pn"), F.max("_p").alias("px"), F.min("_p").alias("pm"),
    )
    sums = {"ps": "double", "pn": "bigint", "px": "double", "pm": "double"}

    def entry(attr: str, value: Column, whole: bool) -> Column:
        return F.struct(F.lit(attr).alias("attr"), value.alias("val"), *[(F.col(c) if whole else F.lit(None).cast(t)).alias(c) for c, t in sums.items()])

    entries = [entry(TOTAL, F.lit(None).cast("string"), True)]
    entries += [F.when(F.col("kind").isin(of[a]), entry(a, F.col(names[a]), False)) for a in cols]
    present = F.filter(F.array(*entries), lambda x: x.isNotNull())
    long = compact.select("kind", "day", *keys, "n", F.inline(present))
    return _summed(long, ["kind", "day", *keys, "attr", "val"])


def _summed(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("ps").alias("ps"), F.sum("pn").alias("pn"), F.max("px").alias("px"), F.min("pm").alias("pm"))


@dataclass(frozen=True)
class Grain:
    """One report over partials: its name, its keys, the condition on the days, and which features it has."""

    name: str
    keys: Sequence[str]
    days: str
    modes: Sequence[str] = ()
    maxima: Sequence[str] = ()
    timing: bool = False
    apps: bool = False

    def attributes(self, spec: BehaviourSpec) -> list[str]:
        return [TOTAL, spec.creative, *self.modes, *self.maxima, *([SECOND] if self.timing else []), *([spec.apps] if self.apps else [])]


def _at_grains(partials: DataFrame, grains: Sequence[Grain], keys: Sequence[str], spec: BehaviourSpec) -> DataFrame:
    """``grain, keys…, kind, attr, val`` with their sums: each partial row goes to the grains that want it, keys that these lack being null."""
    types = dict(partials.dtypes)

    def row(g: Grain) -> Column:
        wanted = F.expr(g.days) & F.col("attr").isin(g.attributes(spec))
        return F.when(wanted, F.struct(F.lit(g.name).alias("grain"), *[(F.col(k) if k in g.keys else F.lit(None).cast(types[k])).alias(k) for k in keys]))

    rows = partials.select(F.inline(F.filter(F.array(*[row(g) for g in grains]), lambda x: x.isNotNull())), "kind", "attr", "val", "n", "ps", "pn", "px", "pm")
    return _summed(rows, ["grain", *keys, "kind", "attr", "val"])


def _best(counts: DataFrame, on: Sequence[str], grains: Sequence[Grain], spec: BehaviourSpec, types: Mapping[str, str]) -> DataFrame:
    """``on…, best``: per row a map from "kind:attribute" to the most frequent, or greatest, value.

    Ranks are cut to the first before the shuffle; what is gathered is one value per attribute.
    """
    maxima = sorted({m for g in grains for m in g.maxima})
    mode, most = F.col("attr").isin([spec.creative, *sorted({m for g in grains for m in g.modes})]), F.col("attr").isin(maxima)
    usable = counts.where((mode & (F.col("val") != "")) | (most & F.col("val").isNotNull()))
    number = F.when(F.col("attr").isin([m for m in maxima if m in types]), F.col("val").try_cast("double"))
    order = [F.when(mode, -F.col("n")), number.desc(), F.when(mode, F.col("val")), F.col("val").desc()]
    first = usable.withColumn("_rn", F.row_number().over(Window.partitionBy(*on, "kind", "attr").orderBy(*order))).where("_rn = 1")
    named = F.struct(F.concat_ws(":", "kind", "attr").alias("k"), F.col("val").alias("v"))
    return first.groupBy(*on).agg(F.map_from_entries(F.collect_list(named)).alias("best"))


def behaviour_of_partials(
    partials: DataFrame, grains: Sequence[Grain], spec: BehaviourSpec, types: Mapping[str, str] | None = None, day_start: Column | int = 0,
) -> dict[str, DataFrame]:
    """By grain the columns of :func:`behaviour_features`, all grains from the same passes over the partials.

    ``types`` gives the types of maxima that aren't text.  As there, impressions and clicks belong to a request's
    keys only if none of these is null, and shares are taken of all rows of the id.
    """
    types = types or {}
    keys = list(dict.fromkeys(k for g in grains for k in g.keys))
    on = ["grain", *keys]
    counts = written(_at_grains(partials, grains, keys, spec), "behaviour-counts")
    whole = lambda k: (F.col("kind") == k) & (F.col("attr") == TOTAL)
    different = lambda k, a: F.count_if((F.col("kind") == k) & (F.col("attr") == a) & F.col("val").isNotNull())
    share = Window.partitionBy("grain", spec.id_col)
    numbers = counts.groupBy(*on).agg(
        *[F.sum(F.when(whole(k), F.col("n"))).alias(f"{k}_n") for k in KINDS],
        *[F.sum(F.when(whole(k), F.col(c))).alias(f"{k}_{c}") for k in ("req", "imp") for c in ("ps", "pn")],
        *[f(F.when(whole(k), F.col(c))).alias(f"{k}_{c}") for k in ("req", "imp") for c, f in (("px", F.max), ("pm", F.min))],
        *[different(k, spec.creative).alias(f"{k}_creatives") for k in ("imp", "clk")],
        *([different(k, spec.apps).alias(f"{k}_apps") for k in KINDS] if spec.apps else []),
    ).withColumns({f"{k}_all": F.sum(f"{k}_n").over(share).cast("double") for k in KINDS}).where("req_n IS NOT NULL")
    wide = join_null_safe(numbers, _best(counts, on, grains, spec, types), on)
    timing: list[str] = []
    if any(g.timing for g in grains):
        times = click_timing(counts.where((F.col("kind") == "clk") & (F.col("attr") == SECOND)), on, "val", day_start, "clk_", weight="n")
        timing = [c for c in times.columns if c not in on]
        wide = join_null_safe(wide, times, on)
    wide = written(wide, "behaviour-features")
    best = lambda name: F.element_at("best", F.lit(name))

    def block(g: Grain, k: str, count: str, priced: bool) -> dict[str, Column]:
        n = f"{k}_n"
        cols = {f"{k}_{count}": F.col(n), f"{k}_rate": F.try_divide(F.col(n).cast("double"), F.col(f"{k}_all"))}
        if priced:
            cols |= {f"{k}_avg_real_price": F.try_divide(F.col(f"{k}_ps"), F.col(f"{k}_pn").cast("double")), f"{k}_max_real_price": F.col(f"{k}_px"), f"{k}_min_real_price": F.col(f"{k}_pm")}
        if g.apps:
            cols[f"{k}_app_count"] = F.col(f"{k}_apps")
        if k != "req":
            known = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in g.keys]) & F.col(n).isNotNull()
            cols |= {f"{k}_creative_count": F.col(f"{k}_creatives"), f"{k}_max_count_creative": F.coalesce(best(f"{k}:{spec.creative}"), F.lit(""))}
            cols |= {c: F.col(c) for c in timing if k == "clk" and g.timing}
            cols = {name: F.when(known, c) for name, c in cols.items()}
        return cols

    def of(g: Grain) -> DataFrame:
        out = block(g, "req", "count", True) | block(g, "imp", "cnt", True) | block(g, "clk", "cnt", False)
        out |= {m: F.coalesce(best(f"req:{m}"), F.lit("")) for m in g.modes} | {m: best(f"req:{m}").cast(types.get(m, "string")) for m in g.maxima}
        return wide.where(F.col("grain") == g.name).select(*g.keys, *[c.alias(name) for name, c in out.items()])

    return {g.name: of(g) for g in grains}


def column_types(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Types of the columns that aren't text, for the maxima of :func:`behaviour_of_partials`."""
    schema = df.schema
    return {c: schema[c].dataType.simpleString() for c in cols if not isinstance(schema[c].dataType, T.StringType)}
