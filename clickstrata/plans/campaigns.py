"""Plan-level funnels where one log line can name several plans, slot-hour publication, affiliate summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import concat_ids
from ..operators.dims import DimSpec, lookup_dims
from ..operators.funnel import FactSpec, merge_funnel, split_list_rows

# The channel of all plan traffic and the tags of conversion logs.
PLAN_CHANNEL = 79
TAGS = ["alp_1", "alp_2", "alp_3", "alp_4"]
PLAN_KEYS = ["plan_id", "creative_id", "adslot_id", "geo", "adsolt_group_name"]
MIN_SLOT = 10_000


def _one(cond: Column | None = None) -> Column:
    one = F.lit(1).cast("bigint")
    return one if cond is None else F.when(cond, one)


def split_plan_funnel(logs: Mapping[str, DataFrame], keys: Sequence[str] = tuple(PLAN_KEYS), tags: Sequence[str] = tuple(TAGS)) -> DataFrame:
    """Requests, bids, impressions, clicks and conversions per plan of a comma-separated plan list.

    ``logs`` has any of ``req, bid, imp, clk, conv``.  Requests carry no creative
    and count under ``-1``.  Rows without a request id are not counted but their
    amounts are.
    """
    counted = F.col("request_id").isNotNull()
    measures = {
        "req": {"req": _one(counted)},
        "bid": {"bid": _one(counted), "bid_real_cost": F.col("real_bid_price").try_cast("double")},
        "imp": {"imp": _one(counted), "imp_real_cost": F.col("real_pay_price").try_cast("double")},
        "clk": {"clk": _one(counted)},
        "conv": {"ocpx": _one(counted), **{t: _one(F.col("ocpx_tag") == t) for t in tags}},
    }
    facts = []
    for name, m in measures.items():
        if name not in logs:
            continue
        rows = split_list_rows(logs[name], "plan_id", "_plan")
        key_cols: dict[str, Column | str] = {k: k for k in keys}
        key_cols["plan_id"] = "_plan"
        if name == "req" and "creative_id" in key_cols:
            key_cols["creative_id"] = F.lit("-1")
        facts.append(FactSpec(rows, key_cols, m))
    return merge_funnel(facts, list(keys)).withColumn("channel_id", F.lit(PLAN_CHANNEL))


def plan_publish(funnel: DataFrame, plans: DataFrame, creatives: DataFrame, slots: DataFrame, users: DataFrame, cities: DataFrame) -> DataFrame:
    """The plan funnel with advertiser, developer, media, joint, creative group, agent and city name."""
    money = {c: F.col(c).cast("decimal(18,10)") for c in ("bid_real_cost", "imp_real_cost") if c in funnel.columns}
    return lookup_dims(funnel.withColumns(money), [
        DimSpec(plans, "plan_id", "id", {"admaster_id": "aduser_id"}, default=None),
        DimSpec(creatives, "creative_id", "id", {"creative_group_id": "creative_group_id"}),
        DimSpec(slots, "adslot_id", "id", {"dev_id": "user_id", "media_id": "media_id", "joint_id": "joint_id"}, default=None),
        DimSpec(users, "plan_id", "id", {"agent_id": "user_oem_id"}),
        DimSpec(cities, "geo", "id", {"geo_name": "name"}, default=None),
    ])


def split_plan_cost(logs: Mapping[str, DataFrame]) -> DataFrame:
    """The narrower plan funnel: request, bid, show and click counts, cost of shows plus clicks."""
    counted = F.col("request_id").isNotNull()
    pay = F.col("pay_price").try_cast("double")
    spec = {"req": {"req": _one(counted)}, "bid": {"bid": _one(counted)},
            "imp": {"show": _one(counted), "cost": pay}, "clk": {"click": _one(counted), "cost": pay}}
    keys = ["plan_id", "creative_id", "adslot_id"]
    facts = [
        FactSpec(split_list_rows(logs[n], "plan_id", "_plan"),
                 {"plan_id": "_plan", "creative_id": F.lit("-1") if n == "req" else "creative_id", "adslot_id": "adslot_id"}, m)
        for n, m in spec.items() if n in logs
    ]
    return merge_funnel(facts, keys).withColumn("channel_id", F.lit(PLAN_CHANNEL))


def slot_hour(logs: Mapping[str, DataFrame], media: DataFrame, min_slot: int = MIN_SLOT) -> DataFrame:
    """Six logs per (app, slot, source) for slots numbered ``min_slot`` and up, with the developer id.

    All six logs are restricted alike; rows with a null key are dropped.
    """
    source = F.when(F.col("is_default") == "1", F.lit("-1")).otherwise(F.col("dsp_id"))
    real = F.col("is_default") == "0"
    in_range = F.col("adsolt_id").try_cast("bigint") >= min_slot

    def keys(dsp: Column | str) -> dict[str, Column | str]:
        return {"media_id": "app_id", "adslocation_id": "adsolt_id", "channel_id": dsp}

    facts = [
        FactSpec(logs["imp"], keys(source), {"show": _one(real)}, in_range),
        FactSpec(logs["clk"], keys(source), {"click": _one(real)}, in_range),
        FactSpec(logs["media_req"], keys(F.lit("-1")), {"valid_pv": _one((F.col("is_sdk") == "0") & concat_ids("imei", "idfa").isNotNull())}, in_range),
        FactSpec(logs["media_req_filter"], keys(F.lit("-1")), {"filter_req": _one()}, in_range),
        FactSpec(logs["media_resp"], keys("dsp_id"), {"adv_back": _one()}, in_range & (F.col("status_code") == "0")),
        FactSpec(logs["dsp_resp"], keys("dsp_id"), {"channel_uv": _one()}, in_range),
    ]
    merged = merge_funnel(facts, ["media_id", "adslocation_id", "channel_id"])
    merged = merged.where(F.col("media_id").isNotNull() & F.col("adslocation_id").isNotNull() & F.col("channel_id").isNotNull())
    merged = merged.withColumn("channel_id", F.when(F.col("channel_id") == "", F.lit("-1")).otherwise(F.col("channel_id")))
    return lookup_dims(merged, [DimSpec(media, "media_id", "id", {"dev_id": "dev_id"}, default=None)])


def affiliate_summary(clicks: DataFrame, callbacks: DataFrame) -> DataFrame:
    """Clicks, activations and shaved activations per channel, offer, source and sub-channel."""
    keys = {"channel_id": "media_id", "adv_id": "offer_id", "aduser_id": "source_id", "subchannel": "sub_channel"}
    return merge_funnel([
        FactSpec(clicks, keys, {"click_count": _one()}),
        FactSpec(callbacks, keys, {"activate_count": _one(), "shave_activates": _one(F.col("referrer") == "true")}),
    ], list(keys))
