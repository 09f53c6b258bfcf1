"""Plan KPIs and settlement reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import ratio, round_places
from ..operators.dims import max_per_key_lookup
from ..operators.ranking import latest_per_key

# Stored cost divided by this is currency (cost / 1000 / 100); rates are per cent.
COST_UNIT = 100_000
# Rebate tiers (count column, unit price column or constant, factor column).
REBATE_TIERS = [
    ("new_cnt", 0.3, "new_factor"),
    ("wake_cnt", "wake_price", "wake_factor"),
    ("pay_cnt", "pay_price", "pay_factor"),
    ("mau_cnt", "mau_price", "mau_factor"),
]


def plan_media_lookup(plans: DataFrame, plan_slots: DataFrame, slots: DataFrame) -> DataFrame:
    """Plans with the greatest slot and media they are placed on (null when on none)."""
    placed = plan_slots.join(slots.select(F.col("id").alias("adslocation_id"), "media_id"), "adslocation_id")
    return max_per_key_lookup(plans, placed, "plan_id", ["adslocation_id", "media_id"])


def plan_kpis(df: DataFrame, keys: Sequence[str] = ("time", "plan_id"), cost_unit: float = COST_UNIT) -> DataFrame:
    """Per key: summed counts, cost in currency, ctr, ecpm, cpc, bid and win rate (per cent), two decimals."""
    sums = df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("req", "bid", "show", "click")], (F.sum("cost").cast("double") / cost_unit).alias("_cost")
    )
    c = F.col

    def pct(num: str, den: str) -> Column:
        return round_places(ratio(c(num), c(den)) * 100, 2)

    return sums.select(
        *keys, "req", "bid", "show", "click", round_places(c("_cost"), 2).alias("cost"), pct("click", "show").alias("ctr"),
        round_places(ratio(c("_cost"), c("show")) * 1000, 2).alias("ecpm"), round_places(ratio(c("_cost"), c("click")), 2).alias("cpc"),
        pct("bid", "req").alias("bid_rate"), pct("show", "bid").alias("bid_success_rate"),
    )


def slot_ecpm(df: DataFrame, keys: Sequence[str], income: str = "media_income") -> DataFrame:
    """Income per thousand shows; groups without shows are left out."""
    sums = df.groupBy(*keys).agg(F.sum(income).alias("_i"), F.sum("show").alias("show"))
    return sums.where(F.col("show") != 0).select(*keys, "show", round_places(ratio(F.col("_i"), F.col("show")) * 1000, 2).alias("ecpm"))


def join_report_blocks(upload: DataFrame, blocks: Sequence[DataFrame], keys: Sequence[str] = ("time", "plan_id")) -> DataFrame:
    """Uploaded rows LEFT JOIN every KPI block on (day, plan)."""
    for block in blocks:
        upload = upload.join(block, list(keys), "left")
    return upload


def dedupe_upload(
    df: DataFrame, keys: Sequence[str], largest: str | None = None, sum_cols: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the largest ``largest``, or the first one with ``sum_cols`` added up."""
    if largest is not None:
        rest = [c for c in df.columns if c not in (*keys, largest)]
        return latest_per_key(df, keys, [largest, *rest])
    sum_cols = list(sum_cols or [])
    rest = [c for c in df.columns if c not in (*keys, *sum_cols)]
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest], *[F.sum(c).alias(c) for c in sum_cols])


def tiered_rebate(tiers: Sequence[tuple[str, str | float, str]] = tuple(REBATE_TIERS)) -> Column:
    """Sum over tiers of count × unit price × factor; a missing part counts as 0."""
    total = F.lit(0.0)
    for count, price, factor in tiers:
        unit = F.lit(float(price)) if isinstance(price, (int, float)) else F.coalesce(F.col(price).cast("double"), F.lit(0.0))
        total = total + F.coalesce(F.col(count).cast("double"), F.lit(0.0)) * unit * F.coalesce(F.col(factor).cast("double"), F.lit(0.0))
    return total


def settlement_report(
    df: DataFrame, ecpm: str = "ecpm", show: str = "show", click: str = "click", rebate: str = "rebate",
    first_wake: str = "first_wake", total: str = "total_active", target: str = "target_active",
) -> DataFrame:
    """Settlement of a plan-day: spend, profit, return, unit costs and conversion ratios.

    Each figure is null when one of its operands is null or its divisor is null or 0.
    """
    c = {n: F.col(v).cast("double") for n, v in dict(e=ecpm, s=show, k=click, r=rebate, w=first_wake, t=total, g=target).items()}
    df = df.withColumn("real_cost", F.when(c["s"] != 0, c["e"] * c["s"] / 1000))
    cost = F.col("real_cost")
    out: Mapping[str, Column] = {
        "breakeven_ctr": F.try_divide(c["e"], F.try_divide(c["r"], c["k"])) / 1000,
        "profit": F.when(cost != 0, c["r"] - cost),
        "roi": F.try_divide(c["r"], cost),
        "profit_share": F.try_divide(c["r"] - cost, cost),
        "rebate_ecpm": F.try_divide(c["r"] * 1000, c["s"]),
        "rebate_cpc": F.try_divide(c["r"], c["k"]),
        "cost_cpc": F.try_divide(cost, c["k"]),
        "wake_rate": F.try_divide(c["w"], c["k"]),
        "total_per_wake": F.try_divide(c["t"], c["w"]),
        "target_per_wake": F.try_divide(c["g"], c["w"]),
        "total_cvr": F.try_divide(c["t"], c["k"]),
        "target_cvr": F.try_divide(c["g"], c["k"]),
        "target_share": F.try_divide(c["g"], c["t"]),
        "uv_price": F.try_divide(c["r"], c["g"]),
        "uv_cost": F.try_divide(cost, c["g"]),
    }
    return df.withColumns(dict(out))


def class_of(name: str, prefix: str = "m", yes: str = "mau", no: str = "dau") -> Column:
    """Plan category by the first letter of its channel name."""
    return F.when(F.col(name).startswith(prefix), F.lit(yes)).otherwise(F.lit(no))


def system_of(name: str, token: str = "ios", yes: str = "ios", no: str = "and") -> Column:
    """Operating system by a token in the plan name."""
    return F.when(F.lower(F.col(name)).contains(token), F.lit(yes)).otherwise(F.lit(no))
