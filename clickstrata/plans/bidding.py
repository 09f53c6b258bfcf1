"""Reports over the bidding log: one table, one row per event, told apart by ``logtype``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import latest_value, ratio, ratio_or_zero, round_places
from ..operators.dims import DimSpec, lookup_dims
from ..operators.funnel import Agg, event_pivot
from ..operators.ranking import Selection, dedup_first, labelled_selections
from ..sources.scans import read_partition

# Event codes of the bidding log.
EVENTS = {
    "request": "10",
    "bid": "11",
    "fill": "12",
    "win": "13",
    "imp": "14",
    "click": "15",
    "loss": "16",
    "conversion": "17",
}
FLOOR_EDGES = [10, 15, 20, 25, 30, 35, 40, 45, 50]
DEDUP_KEYS = ["logtype", "trace_id", "request_id", "adsolt_id"]
CUBE_KEYS = {
    "channel_id": "downstream_id", "country": "country_code", "ad_type": "adsolt_type", "ad_size": "adsolt_shape",
    "os": "os", "bundle": "pkg_name", "adv_id": "admaster_id", "plan_id": "plan_id", "creative_id": "creative_id",
    "stuff_id": "stuff_id", "stuff_size": "stuff_shape", "conversion_task": "conversion_task_id",
}


def _is(event: str, codes: Mapping[str, str]) -> Column:
    return F.col("logtype") == codes[event]


def _present(*cols: str) -> Column:
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.col(c) != "")
        cond = ok if cond is None else cond & ok
    return cond


def dedup_bid_log(df: DataFrame, date: str | None = None, hour: str | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Earliest row per (logtype, trace, request, slot) of one hour or one whole day."""
    if date is not None:
        df = read_partition(df, date, hour)
    for c in ("advlocation_id", "log_hour"):
        if c in df.columns:
            df = df.where(F.col(c).isNotNull())
    return dedup_first(df, DEDUP_KEYS, ["time", *tie_break])


def plan_hourly(df: DataFrame, codes: Mapping[str, str] = EVENTS) -> DataFrame:
    """Per advertiser and plan: latest bid and real price, event counts, real cost.  Requests and blank ids are skipped."""
    df = df.where((F.col("logtype") != codes["request"]) & _present("admaster_id", "plan_id"))
    bid = _is("bid", codes)
    zero = F.lit(0.0)
    return event_pivot(df, ["admaster_id", "plan_id"], {
        "plan_price": F.coalesce(latest_value("plan_price", "time", bid), zero),
        "real_price": F.coalesce(latest_value("real_price", "time", bid), zero),
        "plan_bid_count": Agg(codes["bid"]),
        "inner_win_count": Agg(codes["fill"]),
        "outer_bid_succ_count": Agg(codes["win"]),
        "outer_bid_fail_count": Agg(codes["loss"]),
        "imp_count": Agg(codes["imp"]),
        "real_cost": F.coalesce(F.sum(F.when(_is("imp", codes), F.col("win_price"))), zero),
        "clk_count": Agg(codes["click"]),
        "trans_count": Agg(codes["conversion"]),
    })


def creative_hourly(df: DataFrame, codes: Mapping[str, str] = EVENTS) -> DataFrame:
    """Per advertiser, plan, creative and type: counts, step rates, costs in thousands, earning and profit."""
    df = df.where(F.col("logtype") != codes["request"]).withColumnRenamed("adsolt_type", "creative_type")
    base = event_pivot(df, ["admaster_id", "plan_id", "creative_id", "creative_type"], {
        "plan_price": F.coalesce(latest_value("plan_price", "time", _is("bid", codes)), F.lit(0.0)),
        "bid_count": Agg(codes["bid"]),
        "inner_win_count": Agg(codes["fill"]),
        "outer_bid_succ_count": Agg(codes["win"]),
        "outer_bid_fail_count": Agg(codes["loss"]),
        "imp_count": Agg(codes["imp"]),
        "_cost": Agg(codes["imp"], "sum", "win_price"),
        "clk_count": Agg(codes["click"]),
        "trans_count": Agg(codes["conversion"]),
        "total_earning": Agg(codes["conversion"], "sum", "conversion_unit_price"),
    })
    c = F.col
    total_cost = c("_cost") / 1000
    rates = {
        "inner_bid_succ_rate": ratio(c("inner_win_count"), c("bid_count")),
        "outer_bid_succ_rate": ratio(c("outer_bid_succ_count"), c("inner_win_count")),
        "imp_rate": ratio(c("imp_count"), c("outer_bid_succ_count")),
        "clk_rate": ratio(c("clk_count"), c("imp_count")),
        "trans_rate": ratio(c("trans_count"), c("clk_count")),
    }
    amounts = {
        "plan_price": c("plan_price"),
        "avg_win_price": ratio(c("_cost"), c("imp_count")),
        "total_cost": total_cost,
        "trans_cost": ratio(total_cost, c("trans_count")),
        "total_earning": c("total_earning"),
        "profit": c("total_earning") - total_cost,
    }
    # Sums of doubles differ in their last bits from run to run; halves are told from the nine-place value.
    exact = lambda v, places: round_places(v, places).cast(f"decimal(18,{places})")
    base = base.withColumns({k: exact(v, 4) for k, v in rates.items()} | {k: exact(v, 3) for k, v in amounts.items()})
    return base.select(
        "admaster_id", "plan_id", "creative_id", "creative_type", "plan_price", "bid_count", "inner_win_count",
        "inner_bid_succ_rate", "outer_bid_succ_count", "outer_bid_succ_rate", "outer_bid_fail_count", "imp_count",
        "imp_rate", "avg_win_price", "clk_count", "clk_rate", "trans_count", "trans_rate", "total_cost", "trans_cost",
        "total_earning", "profit",
    )


def channel_quality(df: DataFrame, codes: Mapping[str, str] = EVENTS, seconds: int = 3600) -> DataFrame:
    """Per downstream channel and slot type: traffic, floor, abnormal requests, step rates, costs."""
    base = event_pivot(df, ["downstream_id", "adsolt_type"], {
        "req_count": Agg(codes["request"]),
        "_floor": Agg(codes["request"], "sum", "floor_price"),
        "abnormal_req_count": Agg(codes["request"], extra=F.col("res_code") == "400"),
        "fill_resp_count": Agg(codes["fill"]),
        "avg_bid_price": Agg(codes["fill"], "avg", "plan_price"),
        "plan_bid_count": Agg(codes["bid"]),
        "outer_bid_succ_count": Agg(codes["win"]),
        "outer_bid_fail_count": Agg(codes["loss"]),
        "imp_count": Agg(codes["imp"]),
        "_cost": Agg(codes["imp"], "sum", "win_price"),
        "clk_count": Agg(codes["click"]),
    })
    c = F.col
    return base.select(
        "downstream_id", "adsolt_type", "req_count", F.floor(c("req_count") / seconds).cast("int").alias("qps"),
        ratio(c("_floor"), c("req_count")).alias("avg_floor_price"), "abnormal_req_count", "fill_resp_count",
        "avg_bid_price", ratio(c("fill_resp_count"), c("req_count")).alias("fill_rate"), "plan_bid_count",
        "outer_bid_succ_count", ratio(c("outer_bid_succ_count"), c("fill_resp_count")).alias("bid_win_rate"),
        "outer_bid_fail_count", "imp_count", ratio(c("_cost"), c("imp_count")).alias("avg_win_price"),
        ratio(c("imp_count"), c("outer_bid_succ_count")).alias("imp_rate"), "clk_count",
        ratio(c("clk_count"), c("imp_count")).alias("clk_rate"), (c("_cost") / 1000).alias("total_cost"),
        ratio(c("_cost") / 1000, c("clk_count")).alias("clk_cost"),
    )


def conversion_daily(df: DataFrame, codes: Mapping[str, str] = EVENTS) -> DataFrame:
    """Per plan, creative, material and conversion task: the full funnel with rates, cost, revenue and margin."""
    df = df.withColumnRenamed("conversion_task_id", "conv_id")
    base = event_pivot(df, ["plan_id", "creative_id", "stuff_id", "conv_id"], {
        "offer_req": Agg(codes["bid"]),
        "fill_req": Agg(codes["fill"]),
        "bid_price_avg": Agg(codes["fill"], "avg", "plan_price"),
        "ssp_win": Agg(codes["win"]),
        "imp": Agg(codes["imp"]),
        "clear_price_avg": Agg(codes["imp"], "avg", "win_price"),
        "clk": Agg(codes["click"]),
        "conversion": Agg(codes["conversion"]),
        "_cost": Agg(codes["imp"], "sum", "win_price"),
        "revenue": Agg(codes["conversion"], "sum", "conversion_unit_price"),
    })
    c = F.col
    return base.select(
        "plan_id", "creative_id", "stuff_id", "conv_id", "offer_req", "fill_req", "bid_price_avg", "ssp_win",
        ratio(c("ssp_win"), c("fill_req")).alias("win_rate"), "imp", ratio(c("imp"), c("ssp_win")).alias("imp_rate"),
        "clear_price_avg", "clk", ratio(c("clk"), c("imp")).alias("ctr"), "conversion",
        ratio(c("conversion"), c("clk")).alias("cvr"), (c("_cost") / 1000).alias("cost"), "revenue",
        (c("revenue") - c("_cost") / 1000).alias("margin"),
    )


def target_features(df: DataFrame, target: str, out: str, codes: Mapping[str, str] = EVENTS) -> DataFrame:
    """Per target (device or bundle), channel, plan and task: floor, bid and clear prices, funnel counts, ctr, cvr."""
    keys = {out: target, "channel_id": "downstream_id", "plan_id": "plan_id", "conv_task": "conversion_task_id"}
    df = df.withColumns({f"_k_{k}": F.col(v) for k, v in keys.items()})
    base = event_pivot(df, [f"_k_{k}" for k in keys], {
        "floor_avg": Agg(codes["bid"], "avg", "floor_price"),
        "fill_req": Agg(codes["fill"]),
        "bid_price_avg": Agg(codes["bid"], "avg", "plan_price"),
        "ssp_win": Agg(codes["win"]),
        "imp": Agg(codes["imp"]),
        "clear_price_avg": Agg(codes["imp"], "avg", "win_price"),
        "clk": Agg(codes["click"]),
        "conversion": Agg(codes["conversion"]),
    })
    c = F.col
    return base.select(
        *[c(f"_k_{k}").alias(k) for k in keys], "floor_avg", "fill_req", "bid_price_avg", "ssp_win", "imp",
        "clear_price_avg", "clk", ratio(c("clk"), c("imp")).alias("ctr"), "conversion",
        ratio(c("conversion"), c("clk")).alias("cvr"),
    )


def _few_impressions_per_win(min_win: int, percent: float) -> Column:
    return (F.col("ssp_win") >= min_win) & (ratio(F.col("imp"), F.col("ssp_win")) * 100 < percent)


def device_conversion(
    df: DataFrame, min_imp: int = 100, low_ctr: float = 0.0005, min_win: int = 100, imp_per_win: float = 0.1,
    limit: int = 100, codes: Mapping[str, str] = EVENTS,
) -> DataFrame:
    """Device features under three labels: 1 converted, 2 shown but hardly clicked, 3 won but hardly shown."""
    base = target_features(df, "device_id", "device_id", codes)
    tie = [F.asc(c) for c in ("device_id", "channel_id", "plan_id", "conv_task")]
    return labelled_selections(base, [
        Selection(1, F.col("conversion") > 0),
        Selection(2, (F.col("imp") >= min_imp) & (F.col("ctr") <= low_ctr), [F.desc("imp"), F.asc("ctr"), *tie], limit),
        Selection(3, _few_impressions_per_win(min_win, imp_per_win),
                  [F.desc("ssp_win"), ratio(F.col("imp"), F.col("ssp_win")).asc(), *tie], limit),
    ])


def bundle_conversion(
    df: DataFrame, min_imp: int = 100, high_ctr: float = 0.02, low_ctr: float = 0.0005, min_win: int = 100,
    imp_per_win: float = 0.1, limit: int = 100, codes: Mapping[str, str] = EVENTS,
) -> DataFrame:
    """Bundle features under three labels: 1 well clicked, 2 hardly clicked, 3 won but hardly shown."""
    base = target_features(df, "pkg_name", "bundle", codes)
    tie = [F.asc(c) for c in ("bundle", "channel_id", "plan_id", "conv_task")]
    return labelled_selections(base, [
        Selection(1, (F.col("imp") >= min_imp) & (F.col("ctr") >= high_ctr), [F.desc("imp"), F.desc("ctr"), *tie], limit),
        Selection(2, (F.col("imp") >= min_imp) & (F.col("ctr") <= low_ctr), [F.desc("imp"), F.asc("ctr"), *tie], limit),
        Selection(3, _few_impressions_per_win(min_win, imp_per_win),
                  [F.desc("ssp_win"), ratio(F.col("imp"), F.col("ssp_win")).asc(), *tie], limit),
    ])


def floor_price_histogram(
    df: DataFrame, keys: Mapping[str, str] | None = None, price: str = "floor_price",
    edges: Sequence[int] = tuple(FLOOR_EDGES), min_req: int = 1000, codes: Mapping[str, str] = EVENTS,
) -> DataFrame:
    """Requests, fills and wins per floor-price band; bands are open below and closed above.

    Only groups with more than ``min_req`` requests are kept.
    """
    keys = keys or {"bundle": "pkg_name", "ad_size": "adsolt_shape"}
    p = F.col(price)
    bands = {f"less_{edges[0]}": p <= edges[0]}
    bands |= {f"less_{hi}": (p > lo) & (p <= hi) for lo, hi in zip(edges, edges[1:])}
    bands[f"great_{edges[-1]}"] = p > edges[-1]
    aggs = {
        f"{name}_{band}": Agg(codes[event], extra=cond)
        for band, cond in bands.items() for name, event in (("req", "request"), ("fill", "fill"), ("win", "win"))
    }
    df = df.withColumns({k: F.col(v) for k, v in keys.items()})
    counted = event_pivot(df, list(keys), {**aggs, "_reqs": Agg(codes["request"])})
    return counted.where(F.col("_reqs") > min_req).drop("_reqs")


def dimension_cube_base(df: DataFrame, keys: Mapping[str, str] | None = None, codes: Mapping[str, str] = EVENTS) -> DataFrame:
    """Twelve-dimension pre-aggregate with fifteen measures, the base of every ad-hoc roll-up."""
    keys = keys or CUBE_KEYS
    df = df.withColumns({f"_k_{k}": F.col(v) for k, v in keys.items()})
    base = event_pivot(df, [f"_k_{k}" for k in keys], {
        "total_req": Agg(codes["request"]),
        "bid_floor_sum": Agg(codes["request"], "sum", "floor_price"),
        "offer_bid": Agg(codes["bid"]),
        "offer_price": Agg(codes["bid"], "sum", "plan_price"),
        "fill_req": Agg(codes["fill"]),
        "bid_price": Agg(codes["fill"], "sum", "plan_price"),
        "ssp_win": Agg(codes["win"]),
        "ssp_loss": Agg(codes["loss"]),
        "imp": Agg(codes["imp"]),
        "clear_price": Agg(codes["imp"], "sum", "win_price"),
        "clk": Agg(codes["click"]),
        "conversion": Agg(codes["conversion"]),
        "revenue": Agg(codes["conversion"], "sum", "conversion_unit_price"),
        "fill_bid_floor_sum": Agg(codes["fill"], "sum", "floor_price"),
    })
    money = ("bid_floor_sum", "offer_price", "bid_price", "clear_price", "cost", "revenue", "fill_bid_floor_sum")
    base = base.withColumn("cost", F.col("clear_price"))
    return base.select(
        *[F.col(f"_k_{k}").alias(k) for k in keys],
        *[F.col(c).cast("decimal(18,10)").alias(c) if c in money else F.col(c) for c in base.columns if not c.startswith("_k_")],
    )


def named_cube(base: DataFrame, plans: DataFrame, creatives: DataFrame, advertisers: DataFrame) -> DataFrame:
    """The cube with plan, creative and advertiser names (null when unknown)."""
    return lookup_dims(base, [
        DimSpec(plans, "plan_id", "plan_num", {"plan_name": "name"}, default=None),
        DimSpec(creatives, "creative_id", "creative_num", {"creative_name": "name"}, default=None),
        DimSpec(advertisers, "adv_id", "organ_id", {"adv_name": "name"}, default=None),
    ])


def win_rate_report(
    base: DataFrame, keys: Sequence[str] = ("plan_id", "country", "ad_type", "bundle", "ad_size"),
    min_bids: int = 1000, hi: float = 0.5, lo: float = 0.3,
) -> DataFrame:
    """Cube re-aggregated; groups with more than ``min_bids`` fills and a win rate above ``hi`` or below ``lo``, tagged by the limit."""
    sums = base.groupBy(*keys).agg(*[
        F.sum(c).alias(c) for c in ("total_req", "bid_floor_sum", "fill_req", "bid_price", "ssp_win", "conversion", "cost")
    ])
    c = F.col
    report = sums.select(
        *keys, c("total_req"), ratio_or_zero(c("bid_floor_sum"), c("total_req")).alias("bid_floor_avg"),
        c("fill_req").alias("bid_req"), ratio_or_zero(c("bid_price"), c("fill_req")).alias("bid_price_avg"), "ssp_win",
        ratio_or_zero(c("ssp_win"), c("fill_req")).alias("win_rate"), "conversion",
        ratio_or_zero(c("cost"), c("conversion")).alias("cpa"),
    ).where(c("bid_req") > min_bids)
    return labelled_selections(report, [
        Selection(hi, c("win_rate") > hi), Selection(lo, c("win_rate") < lo),
    ], "query_condition")
