"""Content-feed reports: hourly and daily statistics, visitors, tags, in-app activity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import SIGNED_ID, blank_to
from ..operators.dims import DimSpec, backfill_measure, conditional_lookup, keep_known, lookup_dims
from ..operators.funnel import FactSpec, daily_uv, merge_funnel, rollup

# The name of the pinned channel, the anonymous user, activity codes and duration limits in seconds.
PINNED_CHANNEL = "固定"
ANONYMOUS = "anonymity"
ACT_START, ACT_PLAY, ACT_TASK, ACT_CLICK = 1, 2, 3, 4
DURATION_EDGES = {"less10": 600, "range30": 1800, "range60": 3600, "range120": 7200}
DURATION_LAST = "more120"
CONTENT_KEYS = ["mediaID", "mediaGateID", "channel", "contentID", "advSource", "advSourceID", "advTypeID", "cityID"]
CONTENT_MEASURES = ["cr_imps", "cr_clicks", "ad_imps", "ad_clicks", "h5_request", "api_request"]
STAT_KEYS = ["app_id", "user_id", "content_source_id", "properties_id", "real_tag_id", "channel", "code_advsource",
             "code_style_id", "city_id", "province_id", "put_platform_id"]
PROVINCE_KEYS = [k for k in STAT_KEYS if k != "city_id"]


def _one(cond: Column | None = None) -> Column:
    one = F.lit(1).cast("bigint")
    return one if cond is None else F.when(cond, one)


def _place() -> dict[str, Column]:
    return {c: blank_to(c) for c in ("mediaID", "mediaGateID", "cityID")}


def content_funnel(logs: Mapping[str, DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """Page requests, feed requests, impressions and clicks (content 1, advertising 2) per content key.

    ``extra`` names further key columns all logs have, such as the hour when
    several hours are built at once.
    """
    none = F.lit("-1")
    no_content = {c: none for c in ("contentID", "advSource", "advSourceID", "advTypeID")}
    content = {c: blank_to(c) for c in ("contentID", "advSource", "advSourceID", "advTypeID")}
    channel = blank_to("channel", PINNED_CHANNEL)
    is_content, is_ad = F.col("advType") == "1", F.col("advType") == "2"
    place = {**_place(), **{c: F.col(c) for c in extra}}
    facts = [
        FactSpec(logs["h5_req"], {**place, "channel": none, **no_content}, {"h5_request": _one()}),
        FactSpec(logs["api_req"], {**place, "channel": channel, **no_content}, {"api_request": _one()}),
        FactSpec(logs["imp"], {**place, "channel": channel, **content}, {"cr_imps": _one(is_content), "ad_imps": _one(is_ad)}),
        FactSpec(logs["clk"], {**place, "channel": channel, **content}, {"cr_clicks": _one(is_content), "ad_clicks": _one(is_ad)}),
    ]
    return merge_funnel(facts, [*CONTENT_KEYS, *extra])


def content_hour(
    funnel: DataFrame, channels: DataFrame, apps: DataFrame, cities: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """The hourly statistics table: known channels only, app owner and platform, province of the city."""
    known = keep_known(funnel, channels, "channel", "name")
    named = lookup_dims(known, [
        DimSpec(apps, "mediaID", "id", {"user_id": "user_id", "put_platform_id": "put_platform_id"}, default=None),
        DimSpec(cities, "cityID", "id", {"province_id": "province_id"}, default="0"),
    ])
    named = named.where(
        (F.col("advTypeID") != "") & (F.col("mediaID") != "") & F.col("user_id").isNotNull()
        & F.col("put_platform_id").isNotNull() & F.col("contentID").rlike(SIGNED_ID)
    ).withColumnsRenamed({
        "mediaID": "app_id", "contentID": "content_source_id", "mediaGateID": "properties_id", "advSourceID": "real_tag_id",
        "advSource": "code_advsource", "advTypeID": "code_style_id", "cityID": "city_id",
    })
    return rollup(named, [*STAT_KEYS, *extra], CONTENT_MEASURES)


def content_day(hours: DataFrame, time: str = "time") -> DataFrame:
    """Hours summed to days."""
    return rollup(hours.withColumn("day", F.to_date(time).cast("string")), ["day", *STAT_KEYS], CONTENT_MEASURES)


def content_uv(api_req: DataFrame, visitor: Column, cities: DataFrame, channels: DataFrame, apps: DataFrame) -> DataFrame:
    """Distinct feed visitors per media, gate, channel and province.

    The province is looked up before counting, so a visitor seen in two cities
    of a province is one visitor and the result has one row per key.  Log lines are reduced to
    distinct visits first; the look-up sees one row per visitor, media and city.
    """
    rows = api_req.select(blank_to("mediaID").alias("app_id"), blank_to("mediaGateID").alias("properties_id"),
                          blank_to("channel", PINNED_CHANNEL).alias("channel"), blank_to("cityID").alias("city_id"), visitor.alias("_v")).distinct()
    rows = lookup_dims(rows, [DimSpec(cities, "city_id", "id", {"province_id": "province_id"}, default="0")])
    keys = ["app_id", "properties_id", "channel", "province_id"]
    uv = daily_uv(rows, keys, F.col("_v"))
    named = lookup_dims(keep_known(uv, channels, "channel", "name"), [
        DimSpec(apps, "app_id", "id", {"user_id": "user_id", "put_platform_id": "put_platform_id"}, default=None)
    ])
    named = named.where(F.col("user_id").isNotNull() & F.col("put_platform_id").isNotNull())
    return named.withColumns({c: F.lit("-1") for c in ("content_source_id", "real_tag_id", "code_advsource", "code_style_id")})


def content_province(hours: DataFrame, uv: DataFrame) -> DataFrame:
    """Statistics per province with the visitor count joined on all eleven keys (0 when absent)."""
    return backfill_measure(rollup(hours, PROVINCE_KEYS, CONTENT_MEASURES), uv, PROVINCE_KEYS, "uv")


def data_comparison(hours: DataFrame, time: str = "time") -> DataFrame:
    keys = ["app_id", "user_id", time, "properties_id", "put_platform_id"]
    return rollup(hours, keys, CONTENT_MEASURES)


def tag_map(report: DataFrame, stats: DataFrame) -> DataFrame:
    """Distinct (app, user, property, tag) from the report and from statistics, whose tag names are filled from the report."""
    keys = ["app_id", "user_id", "properties_id"]

    def known(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        for c in cols:
            df = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != "-1"))
        return df

    direct = known(report, [*keys, "tag_name", "tag_id"]).select(*keys, "tag_name", F.trim("tag_id").alias("tag_id"))
    names = report.where(F.col("tag_id").isNotNull()).select(F.col("tag_id").alias("_t"), "tag_name").distinct()
    used = known(stats, [*keys, "real_tag_id"]).select(*keys, "real_tag_id").distinct()
    filled = used.join(names, F.col("real_tag_id") == F.col("_t"), "left").select(
        *keys, F.when(F.col("_t").isNotNull(), F.col("tag_name")).otherwise(F.col("real_tag_id")).alias("tag_name"),
        F.trim("real_tag_id").alias("tag_id"),
    )
    return direct.unionByName(filled).distinct()


def app_starts_by_hour(df: DataFrame) -> DataFrame:
    """Starts per wall-clock hour: distinct users, logged-in and anonymous counts."""
    hour = F.date_format(F.timestamp_seconds("ts"), "HH:00:00")
    rows = df.where(F.col("type") == ACT_START)
    per_user = rows.groupBy(hour.alias("hour"), "uid").agg(F.sum("cnt").alias("_c"))
    return per_user.groupBy("hour").agg(
        F.count("uid").alias("login_uv"),
        F.coalesce(F.sum(F.when(F.col("uid") != ANONYMOUS, F.col("_c"))), F.lit(0)).alias("login_pv"),
        F.coalesce(F.sum(F.when(F.col("uid") == ANONYMOUS, F.col("_c"))), F.lit(0)).alias("unlogin_pv"),
    )


def user_seconds(df: DataFrame, user: str = "uid", seconds: str = "cnt") -> DataFrame:
    """Total playing time per user."""
    return df.groupBy(user).agg(F.sum(seconds).alias("game_seconds"))


def duration_buckets(
    df: DataFrame, user: str = "uid", seconds: str = "cnt", edges: Mapping[str, int] = DURATION_EDGES, last: str = DURATION_LAST
) -> DataFrame:
    """Users per total-duration band (bands closed above) and total time logged in or anonymous."""
    per_user = user_seconds(df, user, seconds)
    s, u = F.col("game_seconds"), F.col(user)
    bands, low = [], None
    for name, hi in edges.items():
        cond = (s <= hi) if low is None else (s > low) & (s <= hi)
        bands.append(F.count(F.when(cond, u)).alias(name))
        low = hi
    bands.append(F.count(F.when(s > low, u)).alias(last))
    return per_user.agg(
        *bands,
        F.coalesce(F.sum(F.when(u != ANONYMOUS, s)), F.lit(0)).alias("login_cnt"),
        F.coalesce(F.sum(F.when(u == ANONYMOUS, s)), F.lit(0)).alias("unlogin_cnt"),
    )


def user_clicks(df: DataFrame, tasks: DataFrame, click_names: DataFrame) -> DataFrame:
    """Counts per object and type (3 task, 4 click), logged in or anonymous, with the name from the matching dimension."""
    counts = df.where(F.col("type").isin(ACT_TASK, ACT_CLICK)).groupBy(F.col("obj").alias("action"), "type").agg(
        F.coalesce(F.sum(F.when(F.col("uid") != ANONYMOUS, F.col("cnt"))), F.lit(0)).alias("login_cnt"),
        F.coalesce(F.sum(F.when(F.col("uid") == ANONYMOUS, F.col("cnt"))), F.lit(0)).alias("unlogin_cnt"),
    )
    return conditional_lookup(counts, [
        (F.col("type") == ACT_TASK, "action", tasks, "id", "title"),
        (F.col("type") == ACT_CLICK, "action", click_names, "click_flag", "click_name"),
    ], "name")
