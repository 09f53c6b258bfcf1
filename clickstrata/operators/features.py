"""Device-behaviour features, conversion links and per-device profiles.

Nothing here gathers an open-ended group: attributes are first counted per
(key, value), click times are first reduced per (key, hour).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import as_col
from ..functions.identity import plain_and_md5
from .ranking import share_of_total

# Conversion tags and the label each one sets.
CONVERSION_TAGS = {"alp_1": "if_new_enter", "alp_2": "if_live_awaken", "alp_3": "if_pay", "alp_4": "if_mau"}


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where null equals null; key columns come from the left."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def modes(df: DataFrame, keys: Sequence[str], cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Most frequent non-blank value of each column per key; smallest on a tie, '' when there is none.

    Long form counts per (key, column, value), so neither the number of rows nor
    the number of distinct values of a key has to fit one aggregation buffer.
    ``weight`` names a count column of pre-aggregated input.
    """
    w = F.col(weight) if weight else F.lit(1)
    long = df.select(*keys, w.cast("bigint").alias("_w"), *[F.col(c).cast("string").alias(c) for c in cols])
    long = long.unpivot([*keys, "_w"], list(cols), "_attr", "_val")
    counts = long.groupBy(*keys, "_attr", "_val").agg(F.sum("_w").alias("_n"))
    usable = F.col("_val").isNotNull() & (F.col("_val") != "")
    best = [
        F.min(F.when((F.col("_attr") == c) & usable, F.struct((-F.col("_n")).alias("n"), F.col("_val").alias("v"))))
        .getField("v").alias(c)
        for c in cols
    ]
    out = counts.groupBy(*keys).agg(*best)
    return out.select(*keys, *[F.coalesce(c, F.lit("")).alias(c) for c in cols])


def click_timing(df: DataFrame, keys: Sequence[str], time: str, start: Column | int, prefix: str = "", weight: str | None = None) -> DataFrame:
    """First and last second after ``start``, then smallest, largest and mean gap between consecutive times.

    ``time`` is epoch seconds.  One time gives gaps of -1; none gives zeros.
    Times are sorted per (key, hour), at most 3600 distinct seconds each, and
    hours are then chained per key, so a key of any size stays in small pieces.
    The mean gap is (last - first) / (n - 1) in whole seconds.  ``weight`` names
    a count column of pre-aggregated input.
    """
    start = F.lit(start) if isinstance(start, int) else start
    t = F.col(time).try_cast("bigint")
    w = F.col(weight) if weight else F.lit(1)
    rows = df.select(*keys, t.alias("_t"), start.cast("bigint").alias("_start"), F.when(t.isNotNull(), w).otherwise(0).cast("bigint").alias("_w"))
    hourly = rows.groupBy(*keys, F.floor(F.col("_t") / 3600).alias("_h")).agg(
        F.sort_array(F.collect_set("_t")).alias("s"), F.sum("_w").alias("n"), F.min("_start").alias("_start")
    )
    gaps = F.zip_with(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), F.slice("s", 1, F.greatest(F.size("s") - 1, F.lit(0))), lambda b, a: b - a)
    hourly = hourly.select(
        *keys, "n", "_start", F.get("s", F.lit(0)).alias("lo"), F.get("s", F.size("s") - 1).alias("hi"), gaps.alias("g"),
        (F.col("n") > F.size("s")).alias("repeat"),
    )
    hourly = hourly.select(
        *keys, "n", "_start", "lo", "hi",
        F.when(F.col("repeat"), F.lit(0).cast("bigint")).otherwise(F.array_min("g")).alias("gmin"),
        F.coalesce(F.array_max("g"), F.when(F.col("repeat"), F.lit(0).cast("bigint"))).alias("gmax"),
    )
    daily = hourly.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("_start").alias("_start"),
        F.min("gmin").alias("gmin"), F.max("gmax").alias("gmax"),
        # One entry per active hour of the key.
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("lo", "hi")))).alias("h"),
    )
    between = F.zip_with(
        F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))), F.slice("h", 1, F.greatest(F.size("h") - 1, F.lit(0))),
        lambda b, a: b["lo"] - a["hi"],
    )
    daily = daily.withColumn("b", between)
    zero, minus = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")

    def gap(value: Column) -> Column:
        return F.when(F.col("n") == 0, zero).when(F.col("n") == 1, minus).otherwise(value)

    return daily.select(
        *keys,
        F.when(F.col("n") == 0, zero).otherwise(F.col("lo") - F.col("_start")).alias(f"{prefix}first_seconds"),
        F.when(F.col("n") == 0, zero).otherwise(F.col("hi") - F.col("_start")).alias(f"{prefix}last_seconds"),
        gap(F.least("gmin", F.array_min("b"))).alias(f"{prefix}min_interval"),
        gap(F.greatest("gmax", F.array_max("b"))).alias(f"{prefix}max_interval"),
        gap(F.floor(F.try_divide((F.col("hi") - F.col("lo")).cast("double"), (F.col("n") - 1).cast("double"))).cast("bigint")).alias(f"{prefix}avg_interval"),
    )


def attribute_profile(
    df: DataFrame, keys: Sequence[str], modes: Mapping[str, str], distincts: Mapping[str, str], price: str | None,
    maxima: Sequence[str], prefix: str, count: str,
) -> DataFrame:
    """Per key: row count, price range, maxima, top value and distinct count of attributes, in one pass over ``df``.

    ``modes`` and ``distincts`` map outputs to columns.  Rows are first compacted
    to one per (key, attributes), because a device repeats its attributes on
    almost every line.  Compact rows are then laid out long, one row for the
    totals and one per attribute, so that counts per (key, attribute, value) and
    totals come from the same two aggregations: no self join, no second scan and
    no per-key set of values in memory.
    """
    attrs = list(dict.fromkeys([*modes.values(), *distincts.values()]))
    p = F.col(price).try_cast("double") if price else F.lit(None).cast("double")
    rows = df.select(*keys, *[F.col(a).cast("string").alias(f"_a_{a}") for a in attrs], *[F.col(m).alias(f"_m_{m}") for m in maxima], p.alias("_p"))
    compact = rows.groupBy(*keys, *[f"_a_{a}" for a in attrs]).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_p").alias("_ps"), F.count("_p").alias("_pn"), F.max("_p").alias("_px"), F.min("_p").alias("_pm"),
        *[F.max(f"_m_{m}").alias(f"_m_{m}") for m in maxima],
    )
    carried = ["_ps", "_pn", "_px", "_pm", *[f"_m_{m}" for m in maxima]]
    types = dict(compact.dtypes)

    def layout(tag: str, value: Column) -> Column:
        only_total = [F.col(c) if tag == "" else F.lit(None).cast(types[c]) for c in carried]
        return F.struct(F.lit(tag).alias("_attr"), value.alias("_val"), *[c.alias(n) for c, n in zip(only_total, carried)])

    layouts = [layout("", F.lit(None).cast("string")), *[layout(a, F.col(f"_a_{a}")) for a in attrs]]
    long = compact.select(*keys, "_n", F.inline(F.array(*layouts)))
    counts = long.groupBy(*keys, "_attr", "_val").agg(
        F.sum("_n").alias("_n"), F.sum("_ps").alias("_ps"), F.sum("_pn").alias("_pn"), F.max("_px").alias("_px"), F.min("_pm").alias("_pm"),
        *[F.max(f"_m_{m}").alias(f"_m_{m}") for m in maxima],
    )
    usable = F.col("_val").isNotNull() & (F.col("_val") != "")

    def top(a: str) -> Column:
        ranked = F.when((F.col("_attr") == a) & usable, F.struct((-F.col("_n")).alias("n"), F.col("_val").alias("v")))
        return F.coalesce(F.min(ranked).getField("v"), F.lit(""))

    return counts.groupBy(*keys).agg(
        F.sum(F.when(F.col("_attr") == "", F.col("_n"))).alias(f"{prefix}_{count}"),
        *([
            F.try_divide(F.sum("_ps"), F.sum("_pn").cast("double")).alias(f"{prefix}_avg_real_price"),
            F.max("_px").alias(f"{prefix}_max_real_price"), F.min("_pm").alias(f"{prefix}_min_real_price"),
        ] if price else []),
        *[F.max(f"_m_{m}").alias(m) for m in maxima],
        *[top(a).alias(out) for out, a in modes.items()],
        *[F.count(F.when(F.col("_attr") == a, F.col("_val"))).alias(out) for out, a in distincts.items()],
    )


def creative_block(
    df: DataFrame, keys: Sequence[str], id_col: str, prefix: str, creative: str, price: str | None, apps: str | None = None
) -> DataFrame:
    """Impression or click block: count, share of the id's total, distinct and top creative, price range."""
    distincts = {f"{prefix}_creative_count": creative} | ({f"{prefix}_app_count": apps} if apps else {})
    block = attribute_profile(df, keys, {f"{prefix}_max_count_creative": creative}, distincts, price, (), prefix, "cnt")
    return share_of_total(block, f"{prefix}_cnt", [id_col], f"{prefix}_rate")


def request_block(
    df: DataFrame, keys: Sequence[str], id_col: str, mode_cols: Sequence[str], max_cols: Sequence[str], price: str,
    prefix: str = "req", apps: str | None = None,
) -> DataFrame:
    """Request block: top values and maxima of attributes, count, share and price range."""
    distincts = {f"{prefix}_app_count": apps} if apps else {}
    block = attribute_profile(df, keys, {c: c for c in mode_cols}, distincts, price, max_cols, prefix, "count")
    return share_of_total(block, f"{prefix}_count", [id_col], f"{prefix}_rate")


@dataclass(frozen=True)
class BehaviourSpec:
    """Column roles of the three logs."""

    id_col: str = "id"
    mode_cols: Sequence[str] = ("producer", "carrier", "network", "city_id")
    max_cols: Sequence[str] = ()
    req_price: str = "floor_price"
    price: str = "real_price"
    creative: str = "creative_id"
    time: str = "time"
    apps: str | None = None


def behaviour_features(
    req: DataFrame, imp: DataFrame, clk: DataFrame, keys: Sequence[str], spec: BehaviourSpec = BehaviourSpec(),
    day_start: Column | int | None = None,
) -> DataFrame:
    """Request block LEFT JOIN impression block LEFT JOIN click block on ``keys``.

    ``keys`` decides the grain (app, id, slot / id) and the caller's scan decides
    the days.  With ``day_start`` the click timing columns are added.  Shares
    are part over total.  Each log is read once (clicks once more for the timing).
    """
    out = request_block(req, keys, spec.id_col, spec.mode_cols, spec.max_cols, spec.req_price, apps=spec.apps)
    imps = creative_block(imp, keys, spec.id_col, "imp", spec.creative, spec.price, spec.apps)
    clks = creative_block(clk, keys, spec.id_col, "clk", spec.creative, None, spec.apps)
    if day_start is not None:
        clks = join_null_safe(clks, click_timing(clk, keys, spec.time, day_start, "clk_"), keys)
    return out.join(imps, list(keys), "left").join(clks, list(keys), "left")


def link_conversions(
    devices: DataFrame, conversions: DataFrame, keys: Sequence[str], tag: str = "ocpx_tag",
    carry: Sequence[str] = ("plan_id", "creative_id", "admaster_id"), tags: Mapping[str, str] = CONVERSION_TAGS,
) -> DataFrame:
    """Conversions of known devices, one row per key with a 0/1 column per tag.

    Both sides are reduced to one row per key before they meet, so neither
    multiplies the other and repeated requests are combined map-side.
    """
    per_key = conversions.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in carry],
        F.max(tag).alias(tag),
        *[F.max(F.when(F.col(tag) == code, 1).otherwise(0)).alias(name) for code, name in tags.items()],
    )
    return per_key.join(devices.select(*keys).distinct(), list(keys), "left_semi")


def behaviour_daily(
    by_slot: DataFrame, by_id: DataFrame, by_days: DataFrame, conversions: DataFrame, keys: Sequence[str], id_col: str = "id"
) -> DataFrame:
    """The daily feature table: slot-level, id-level (``_2``), multi-day (``_3``) features and conversion tags."""
    def suffixed(df: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
        cols = [c for c in df.columns if c.startswith(("req_", "imp_", "clk_"))]
        return df.select(*on, *[F.col(c).alias(c + suffix) for c in cols])

    labelled = by_slot.withColumns({
        "if_imp": F.when(F.col("imp_cnt") >= 1, 1).otherwise(0),
        "if_clk": F.when(F.col("clk_cnt") >= 1, 1).otherwise(0),
    })
    return (
        labelled.join(suffixed(by_id, [id_col], "_2"), [id_col], "left")
        .join(suffixed(by_days, keys, "_3"), list(keys), "left")
        .join(conversions, list(keys), "left")
    )


def crowd_profile(
    conv: DataFrame, clk: DataFrame, imp: DataFrame, model: Column, imei: str = "imei", idfa: str = "idfa",
    oaid: str = "oaid", time: str = "time", tag: str = "ocpx_tag",
) -> DataFrame:
    """Per (id kind, id, model): latest conversion, impression and click counts, last click time.

    Each log becomes one row per known id (md5 of imei and idfa, oaid as is);
    the three logs are then aggregated together in one pass.
    """
    def rows(df: DataFrame, log: str) -> DataFrame:
        imei_plain, imei_md5 = plain_and_md5(imei)
        idfa_plain, idfa_md5 = plain_and_md5(idfa)
        ids = F.array(*[
            F.struct(F.lit(kind).alias("device_type"), v.alias("device_value"))
            for kind, v in (("imei_md5", imei_md5), ("idfa_md5", idfa_md5), ("oaid", F.col(oaid)))
        ])
        tag_col = F.substr(F.col(tag), F.lit(5)) if log == "conv" else F.lit(None).cast("string")
        flat = df.select(
            F.inline(ids), model.alias("model_type"), imei_plain.alias("imei"), idfa_plain.alias("idfa"),
            F.col(time).try_cast("bigint").alias("t"), tag_col.alias("tag"), F.lit(log).alias("log"),
        )
        return flat.where(F.col("device_value").isNotNull() & (F.col("device_value") != ""))

    logs = rows(conv, "conv").unionByName(rows(clk, "clk")).unionByName(rows(imp, "imp"))
    is_conv = F.col("log") == "conv"
    latest = F.max(F.when(is_conv, F.struct("t", "tag", "imei", "idfa")))
    agg = logs.groupBy("device_type", "device_value", "model_type").agg(
        latest.alias("c"),
        F.max(F.when(~is_conv, F.col("imei"))).alias("imei"),
        F.max(F.when(~is_conv, F.col("idfa"))).alias("idfa"),
        F.count_if(F.col("log") == "imp").alias("imp_count"),
        F.max(F.when(F.col("log") == "clk", F.col("t"))).alias("clk_time"),
        F.count_if(F.col("log") == "clk").alias("clk_count"),
    )
    return agg.select(
        "device_type", "device_value", "model_type",
        F.greatest("c.imei", "imei").alias("imei"), F.greatest("c.idfa", "idfa").alias("idfa"),
        F.col("c.tag").alias("ocpx_tag"), F.coalesce("c.t", F.lit(0)).alias("ocpx_time"),
        "imp_count", F.coalesce("clk_time", F.lit(0)).alias("clk_time"), "clk_count",
    )


def latest_result(df: DataFrame, keys: Sequence[str], device: str, time: str, value: str) -> DataFrame:
    """Per md5 device and keys: latest (time, value) and any plain id seen."""
    plain, hashed = plain_and_md5(device)
    known = df.where(F.col(device).isNotNull() & (F.col(device) != ""))
    rows = known.select(*keys, plain.alias("device_id"), hashed.alias("device_id_md5"), F.struct(as_col(time).alias("t"), as_col(value).alias("v")).alias("_tv"))
    return rows.groupBy(*keys, "device_id_md5").agg(F.max("device_id").alias("device_id"), F.max("_tv").alias("_tv")).select(
        *keys, "device_id_md5", "device_id", F.col("_tv.t").alias("time"), F.col("_tv.v").alias("result")
    )
