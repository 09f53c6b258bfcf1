"""Supply-side reports: the hourly slot funnel, its publication, daily actives, creatives, dimension report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import UNSIGNED_ID, blank_to, null_if_blank
from ..functions.devices import brand_of
from ..functions.identity import concat_ids
from ..functions.requests import creative_image_url
from ..operators.dims import DimSpec, lookup_dims
from ..operators.funnel import FactSpec, merge_funnel, rollup, segment_uv_pv

# Measures of the slot funnel, and the event logs that only count rows.
EVENT_MEASURES = {
    "down_start": "down_start", "down_complate": "down_complate", "install_start": "install_start",
    "install_complate": "install_complate", "app_start": "app_start", "v_cache_done": "v_cache_done",
    "v_play_start": "v_play_start", "v_play_done": "v_play_done",
}
FUNNEL_KEYS = ["app_id", "dsp_id", "adsolt_id"]
FUNNEL_MEASURES = [
    "valid_uv", "valid_pv", "sdk_uv", "sdk_pv", "filter_req", "adv_back", "def_show", "def_click", "show", "click", "dpnum",
    "clkdpnum", "channel_uv", "channel_pv", "send_dsp_res", *EVENT_MEASURES, "rjcost",
]


def _keys(dsp: Column | str) -> dict[str, Column | str]:
    return {"app_id": "app_id", "dsp_id": dsp, "adsolt_id": "adsolt_id"}


def _source_or_default() -> Column:
    return F.when(F.col("is_default") == "1", F.lit("-1")).otherwise(F.col("dsp_id"))


def _one(cond: Column | None = None) -> Column:
    one = F.lit(1).cast("bigint")
    return one if cond is None else F.when(cond, one)


def slot_hour_funnel(logs: Mapping[str, DataFrame]) -> DataFrame:
    """Seventeen logs → one row per (app, demand source, slot) with every count of the hour.

    ``logs`` may hold any of: imp, clk, media_req, media_resp, media_req_filter,
    dsp_resp, dp, send_dsp_res, win and the eight app-event logs of
    :data:`EVENT_MEASURES`.  Default creatives belong to source ``-1``; slots
    with a non-numeric id are dropped.
    """
    is_default, no_default = F.col("is_default") == "1", F.col("is_default") == "0"
    facts: list[FactSpec] = []

    def add(name: str, dsp: Column | str, measures: Mapping[str, Column], where: Column | None = None) -> None:
        if name in logs:
            facts.append(FactSpec(logs[name], _keys(dsp), measures, where))

    add("imp", _source_or_default(), {"def_show": _one(is_default), "show": _one(no_default)})
    add("clk", _source_or_default(), {"def_click": _one(is_default), "click": _one(no_default), "clkdpnum": _one(F.col("deeplink") == "1")})
    if "media_req" in logs:
        uv = segment_uv_pv(
            logs["media_req"], ["app_id", "adsolt_id"],
            {"valid_uv": (F.col("is_sdk") == "0", concat_ids("imei", "idfa")), "sdk_uv": (F.col("is_sdk") == "1", concat_ids("imei", "idfa"))},
            {"valid_pv": F.col("is_sdk") == "0", "sdk_pv": F.col("is_sdk") == "1"},
        )
        facts.append(FactSpec(uv, _keys(F.lit("-1")), {m: m for m in ("valid_uv", "valid_pv", "sdk_uv", "sdk_pv")}))
    add("media_req_filter", F.lit("-1"), {"filter_req": _one()})
    add("media_resp", "dsp_id", {"adv_back": _one()}, F.col("status_code") == "0")
    add("dsp_resp", "dsp_id", {"channel_uv": _one(), "channel_pv": _one()})
    add("dp", "dsp_id", {"dpnum": _one()})
    add("send_dsp_res", "dsp_id", {"send_dsp_res": _one()})
    for log, measure in EVENT_MEASURES.items():
        add(log, _source_or_default(), {measure: _one()})
    add("win", "dsp_id", {"rjcost": null_if_blank("dsp_price").try_cast("double")})
    numeric = [FactSpec(f.df, f.keys, f.measures, F.col("adsolt_id").cast("string").rlike(UNSIGNED_ID) if f.where is None
                        else f.where & F.col("adsolt_id").cast("string").rlike(UNSIGNED_ID)) for f in facts]
    return merge_funnel(numeric, FUNNEL_KEYS)


def slot_hour_publish(funnel: DataFrame, media: DataFrame, slots: DataFrame, managers: DataFrame) -> DataFrame:
    """The funnel with developer, joint, deduction and account manager ids, one row per published key (measures by ``max``)."""
    out = funnel.select(
        null_if_blank("app_id").alias("media_id"), blank_to("dsp_id", "-1").alias("channel_id"),
        F.col("adsolt_id").alias("adslocation_id"), *[c for c in FUNNEL_MEASURES if c in funnel.columns],
    )
    out = lookup_dims(out, [
        DimSpec(media, "media_id", "id", {"dev_id": "user_id"}, default=None),
        DimSpec(slots, "adslocation_id", "id", {"joint_id": "joint_id", "deduct": "deduct"}, default=None),
        DimSpec(managers, "media_id", "id", {"am_id": "user_id"}, default="-1"),
    ]).withColumn("deduct", F.coalesce("deduct", F.lit(0)))
    measures = ["deduct", *[c for c in FUNNEL_MEASURES if c in funnel.columns]]
    return rollup(out, ["media_id", "channel_id", "adslocation_id", "dev_id", "joint_id", "am_id"], measures, op="max")


def daily_actives(media_req: DataFrame) -> DataFrame:
    """Per app and slot: distinct and plain request counts, web versus SDK by operating system."""
    web, sdk = F.col("is_sdk") == "0", F.col("is_sdk") == "1"
    android, ios = sdk & (F.col("os") == "1"), sdk & (F.col("os") == "2")
    return segment_uv_pv(
        media_req, ["app_id", "adsolt_id"],
        {
            "valid_uv": (web, concat_ids("imei", "idfa")),
            "android_sdk_uv": (android, concat_ids("android_id")),
            "ios_sdk_uv": (ios, concat_ids("imei", "idfa")),
        },
        {"valid_pv": web, "android_sdk_pv": android, "ios_sdk_pv": ios},
    )


def creative_passthrough(df: DataFrame) -> DataFrame:
    """Creative log projection for numeric creative types."""
    return df.where(F.col("creative_type").rlike(r"^\d+$")).select(
        F.col("creative_type").alias("adslocation_type_id"), "creative_json", "channel_url", F.col("dsp_id").alias("channel_id")
    )


def creative_summary(df: DataFrame, key: str = "unique") -> DataFrame:
    """Per unique creative: greatest attribute values and number of rows."""
    attrs = {"adslocation_type_id": "creative_type", "creative_json": "creative_json", "channel_url": "channel_url",
             "channel_id": "dsp_id", "res_type": "res_type", "media_id": "media_id"}
    return df.where(F.col("creative_type").rlike(r"^\d+$")).groupBy(key).agg(
        *[F.max(src).alias(n) for n, src in attrs.items()], F.count(F.lit(1)).alias("count")
    )


def creative_image_counts(df: DataFrame) -> DataFrame:
    """Rows per creative image, channel and slot."""
    rows = df.select(
        creative_image_url("creative_json", "creative_type").alias("img_url"),
        F.col("dsp_id").alias("channel_id"), F.col("adsolt_id").alias("adslocation_id"),
    )
    counts = rows.groupBy("img_url", "channel_id", "adslocation_id").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("img_url_md5", F.md5("img_url"))


def media_package_counts(imp: DataFrame, app: str = "app_id", pkg: str = "http_haad") -> DataFrame:
    return imp.groupBy(F.col(app).alias("media_id"), F.col(pkg).alias("pkg")).agg(F.count(F.lit(1)).alias("count"))


REPORT_KEYS = ["app_id", "adsolt_id", "dsp_id", "os", "carrier", "network", "producer", "city_id"]
REPORT_MEASURES = ["req_cnt", "resp_cnt", "imp_cnt", "clk_cnt", "cpm_sum", "cpm_cnt", "floor_price_sum", "floor_price_cnt"]


def dimension_report(logs: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Eight-dimension funnel with (sum, count) pairs for averages and ids for os, carrier, network and brand.

    Counts are taken per raw producer; brand rules then run on the groups, not
    on the log lines.
    """
    keys = {k: k for k in REPORT_KEYS}
    price, floor = F.col("real_price").try_cast("double"), F.col("floor_price").try_cast("double")
    facts = [
        FactSpec(logs["media_req"], {**keys, "dsp_id": F.lit(None).cast("string")}, {"req_cnt": _one()}),
        FactSpec(logs["media_resp"], keys, {"resp_cnt": _one()}, F.col("status_code") == "0"),
        FactSpec(logs["imp"], keys, {
            "imp_cnt": _one(), "cpm_sum": price, "cpm_cnt": _one(price.isNotNull()),
            "floor_price_sum": floor, "floor_price_cnt": _one(floor.isNotNull()),
        }),
        FactSpec(logs["clk"], keys, {"clk_cnt": _one()}),
    ]
    raw = merge_funnel(facts, REPORT_KEYS)
    branded = rollup(raw.withColumn("producer", brand_of("producer")), REPORT_KEYS, REPORT_MEASURES)
    return lookup_dims(branded, [
        DimSpec(dims["os"], "os", "jsonkey", {"os": "id"}, default=None),
        DimSpec(dims["carrier"], "carrier", "jsonkey", {"carrier": "id"}, default=None),
        DimSpec(dims["network"], "network", "jsonkey", {"network": "id"}, default=None),
        DimSpec(dims["brand"], "producer", "jsonkey", {"producer": "id"}, default=None),
    ])


def daily_spend(df: DataFrame, keys: Sequence[Column | str], price: str) -> DataFrame:
    """Rows and spend in thousands per key; a price that is not a number counts as 0."""
    value = F.coalesce(F.col(price).try_cast("double"), F.lit(0.0))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), (F.sum(value) / 1000).alias("spend"))


def owner_daily_spend(df: DataFrame, owners: DataFrame, day: str, app: str, price: str) -> DataFrame:
    """Spend per day and media owner; media without an owner are left out."""
    per_app = daily_spend(df, [day, app], price)
    joined = per_app.join(owners.select(F.col("id").alias(app), "user_id").distinct(), app)
    return joined.groupBy(day, "user_id").agg(F.sum("cnt").alias("cnt"), F.sum("spend").alias("spend"))


def hourly_price(df: DataFrame, time: str, keys: Sequence[str], price: str, utc_offset_hours: int = 8) -> DataFrame:
    """Price per local hour and keys; blank prices count as 0."""
    local = F.timestamp_seconds(F.col(time).try_cast("bigint") + utc_offset_hours * 3600)
    hour = F.date_format(F.date_trunc("hour", local), "yyyy-MM-dd HH:00:00")
    value = F.coalesce(null_if_blank(price).try_cast("double"), F.lit(0.0))
    return df.groupBy(hour.alias("hour"), *keys).agg(F.sum(value).alias("price"))


