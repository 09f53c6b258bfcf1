"""Access-log reports: slot statistics, package counts, URL traffic and its change from day to day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import round_places
from ..functions.cleaning import max_length
from ..functions.requests import normalize_uri
from ..operators.dims import DimSpec, lookup_dims
from ..operators.rules import IP_RULES, suspicious_ips
from ..sources.lines import parse_request_query

# Query parameters of the slot script, length limits, change-rate limits.
SLOT_PARAMS = {
    "act": "act", "domain": "domain", "chid": "chid", "template_id": "template_id", "page": "page",
    "ad_flag": "adflag", "_id": "adslocation_id",
}
NEW_URL_RATE = 999999.0
MIN_PREVIOUS = 1000


def access_hour(time: str = "time"):
    """Hour label of an ISO log time; the zone suffix is cut off, not applied."""
    return F.concat(F.translate(F.substring(time, 1, 13), "T", " "), F.lit(":00:00"))


def access_stats_hourly(log: DataFrame) -> DataFrame:
    """Calls, answers and clicks per hour, slot, domain, channel, template, page and flag."""
    rows = parse_request_query(log.select(access_hour().alias("hour"), "request"), SLOT_PARAMS)
    rows = max_length(rows, {"page": 100, "domain": 200})
    keys = ["hour", "adslocation_id", "domain", "chid", "template_id", "page", "adflag"]
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("act") == "call").alias("impression"),
        F.count_if(F.col("act") == "resp").alias("resp"),
        F.count_if(F.col("act") == "clk").alias("clicks"),
    )


def access_stats_named(stats: DataFrame, tag_links: DataFrame, urls: DataFrame, channels: DataFrame) -> DataFrame:
    """Slot, domain and channel replaced by their ids where known; link owner columns added."""
    stats = max_length(stats, {"adflag": 100})
    owned = lookup_dims(stats, [DimSpec(tag_links, "adslocation_id", "tags_md5", {"_slot": "tags_map_id", "user_id": "user_id", "station_id": "station_id", "link_id": "link_id"}, default=None)])
    owned = owned.withColumn("adslocation_id", F.coalesce(F.col("_slot").cast("string"), "adslocation_id")).drop("_slot")
    return lookup_dims(owned, [
        DimSpec(urls, "domain", "url", {"domain": "id"}, fallback_to_key=True),
        DimSpec(channels, "chid", "channel_id", {"chid": "id"}, fallback_to_key=True),
    ])


def slot_suspicious_ips(log: DataFrame, limits: Mapping[str, float] = IP_RULES) -> DataFrame:
    """Rule-breaking addresses per slot of one day of the access log."""
    rows = parse_request_query(log.select(access_hour().alias("hour"), "request", "user_ip"), {"act": "act", "_id": "adslocation_id"})
    return suspicious_ips(rows, limits=limits)


def package_counts(log: DataFrame, urls: DataFrame, channels: DataFrame) -> DataFrame:
    """Lines per domain, channel and package, ids where known."""
    rows = max_length(log.select("request", "package_name"), {"package_name": 200})
    rows = parse_request_query(rows, {"domain": "domain", "chid": "chid"})
    counts = rows.groupBy("domain", "chid", "package_name").agg(F.count(F.lit(1)).alias("cnt"))
    return lookup_dims(counts, [
        DimSpec(urls, "domain", "url", {"domain": "id"}, fallback_to_key=True),
        DimSpec(channels, "chid", "channel_id", {"chid": "id"}, fallback_to_key=True),
    ])


def url_request_counts(log: DataFrame, request: str = "request", host: str = "hostname") -> DataFrame:
    """Requests per host and normalised URL (host + path, nulls read as empty)."""
    rows = max_length(log.select(F.col(host).alias("hostname"), normalize_uri(request).alias("_u")), {"hostname": 200})
    counts = rows.groupBy("hostname", "_u").agg(F.count(F.lit(1)).alias("request_num"))
    return counts.select("hostname", F.concat("hostname", F.coalesce("_u", F.lit(""))).alias("url"), "request_num")


def day_over_day(
    cur: DataFrame, prev: DataFrame, keys: Sequence[str], n: str, new_rate: float = NEW_URL_RATE, min_previous: int = MIN_PREVIOUS
) -> DataFrame:
    """Today's counts beside yesterday's: change and change rate.

    No row yesterday → ``new_rate``; fewer than ``min_previous`` yesterday →
    null; otherwise the relative change rounded to two places.
    """
    before = prev.select(*keys, F.col(n).alias("_p"))
    joined = cur.join(before, list(keys), "left")
    rate = F.when(F.col("_p").isNull(), F.lit(float(new_rate))).when(
        F.col("_p") >= min_previous, round_places(F.try_divide((F.col(n) - F.col("_p")).cast("double"), F.col("_p").cast("double")), 2)
    )
    return joined.select(
        *keys, F.coalesce(n, F.lit(0)).alias(n), F.coalesce("_p", F.lit(0)).alias(f"pre_{n}"),
        (F.coalesce(n, F.lit(0)) - F.coalesce("_p", F.lit(0))).alias("change_num"), rate.alias("change_rate"),
    )
