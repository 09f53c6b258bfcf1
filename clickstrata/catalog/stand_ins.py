"""The given tables read as advertising logs; each Spark frame has its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import Tables


def epoch_seconds(ts: str) -> Column:
    """Wall-clock seconds since 1970 of a zone-less timestamp, independent of the session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def lettered(letter: str, c: Column) -> Column:
    return F.concat(F.lit(letter), c.cast("string"))


def events(t: Tables) -> DataFrame:
    """``events`` with its number from ``props`` (k), epoch seconds (sec), day and hour."""
    return t.events.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"), epoch_seconds("ts").alias("sec"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH").alias("hour"),
    )


EVENTS_CTE = """ev AS (
  SELECT event_id, user_id, event_type, value, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour
  FROM events)"""


def bid_log(t: Tables) -> DataFrame:
    """One bidding event per ``events`` row; the event code comes from its type and the parity of k."""
    e, even = events(t), F.col("k") % 2 == 0
    u, k, v = F.col("user_id"), F.col("k"), F.col("value")
    code = (
        F.when(F.col("event_type") == "view", F.when(even, "10").otherwise("11"))
        .when(F.col("event_type") == "signup", F.when(even, "12").otherwise("13"))
        .when(F.col("event_type") == "error", F.when(even, "14").otherwise("16"))
        .when(F.col("event_type") == "click", F.lit("15"))
        .otherwise(F.lit("17"))
    )
    return e.select(
        "event_id", code.alias("logtype"), F.col("sec").alias("time"), lettered("t", u).alias("trace_id"),
        lettered("r", F.floor(F.col("event_id") / 3)).alias("request_id"), lettered("s", k % 4).alias("adsolt_id"),
        lettered("y", k % 3).alias("adsolt_type"), v.alias("floor_price"), v.alias("plan_price"), (v * 0.5).alias("real_price"),
        (v * 0.25).alias("win_price"), (v * 2).alias("conversion_unit_price"), lettered("d", u).alias("device_id"),
        F.when(u % 10 == 0, F.lit("")).otherwise(lettered("a", u % 7)).alias("admaster_id"), lettered("p", u % 23).alias("plan_id"),
        lettered("c", k % 10).alias("creative_id"), lettered("m", k % 5).alias("stuff_id"), lettered("x", k % 2).alias("stuff_shape"),
        lettered("z", k % 2).alias("adsolt_shape"), lettered("h", u % 5).alias("downstream_id"), lettered("n", u % 11).alias("country_code"),
        (u % 2 + 1).cast("string").alias("os"), lettered("b", u % 13).alias("pkg_name"),
        F.when(v > 15, "400").otherwise("0").alias("res_code"), lettered("q", k % 3).alias("conversion_task_id"),
        lettered("s", k % 4).alias("advlocation_id"), F.col("hour").alias("log_hour"),
        F.col("day").alias("etl_date"), F.col("hour").alias("etl_hour"),
    )


BID_CTE = EVENTS_CTE + """, bid AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN '10' ELSE '11' END
           WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN '12' ELSE '13' END
           WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN '14' ELSE '16' END
           WHEN 'click' THEN '15' ELSE '17' END AS logtype,
         sec AS time, 't' || user_id AS trace_id, 'r' || (event_id // 3) AS request_id, 's' || (k % 4) AS adsolt_id,
         'y' || (k % 3) AS adsolt_type, value AS floor_price, value AS plan_price, value * 0.5 AS real_price, value * 0.25 AS win_price,
         value * 2 AS conversion_unit_price, 'd' || user_id AS device_id,
         CASE WHEN user_id % 10 = 0 THEN '' ELSE 'a' || (user_id % 7) END AS admaster_id, 'p' || (user_id % 23) AS plan_id,
         'c' || (k % 10) AS creative_id, 'm' || (k % 5) AS stuff_id, 'x' || (k % 2) AS stuff_shape, 'z' || (k % 2) AS adsolt_shape,
         'h' || (user_id % 5) AS downstream_id, 'n' || (user_id % 11) AS country_code, CAST(user_id % 2 + 1 AS VARCHAR) AS os,
         'b' || (user_id % 13) AS pkg_name, CASE WHEN value > 15 THEN '400' ELSE '0' END AS res_code,
         'q' || (k % 3) AS conversion_task_id, day AS etl_date, hour AS etl_hour
  FROM ev)"""


def exchange_log(t: Tables) -> DataFrame:
    """One exchange event per ``events`` row: request key, source, raw dimension names, status, prices."""
    u, k, v = F.col("user_id"), F.col("k"), F.col("value")
    return events(t).select(
        "event_type", F.floor(F.col("event_id") / 4).cast("string").alias("request_id"), F.col("sec").alias("req_time"),
        (k % 3).cast("string").alias("real_dsp_id"), (k % 6).cast("string").alias("dsp_id"),
        F.when(u % 9 == 0, F.lit("")).otherwise((u % 12).cast("string")).alias("app_id"), (k % 4).cast("string").alias("adsolt_id"),
        F.concat(F.lit("pkg"), (u % 30).cast("string")).alias("pkg_name"), F.concat(F.lit("NATION_"), (u % 25).cast("string")).alias("country"),
        (u % 2 + 1).cast("string").alias("os"), (k % 3).cast("string").alias("adsolt_type"),
        F.when(k % 5 == 0, "1").when(k % 5 == 1, "201").when(k % 5 == 2, "202").when(k % 5 == 3, "203").otherwise("206").alias("staus_code"),
        v.alias("req_floor_price"), v.alias("dsp_bid_price"), v.alias("dsp_bid"), (v * 2).alias("dsp_final_price"), (v * 0.5).alias("ssp_final_price"),
    )


EXCHANGE_CTE = EVENTS_CTE + """, x AS (
  SELECT event_type, CAST(event_id // 4 AS VARCHAR) AS request_id, sec AS req_time, CAST(k % 3 AS VARCHAR) AS real_dsp_id, CAST(k % 6 AS VARCHAR) AS dsp_id,
         CASE WHEN user_id % 9 = 0 THEN '' ELSE CAST(user_id % 12 AS VARCHAR) END AS app_id, CAST(k % 4 AS VARCHAR) AS adsolt_id,
         'pkg' || (user_id % 30) AS pkg_name, 'NATION_' || (user_id % 25) AS country, CAST(user_id % 2 + 1 AS VARCHAR) AS os,
         CAST(k % 3 AS VARCHAR) AS adsolt_type,
         CASE k % 5 WHEN 0 THEN '1' WHEN 1 THEN '201' WHEN 2 THEN '202' WHEN 3 THEN '203' ELSE '206' END AS staus_code,
         value AS req_floor_price, value AS dsp_bid_price, value AS dsp_bid, value * 2 AS dsp_final_price, value * 0.5 AS ssp_final_price
  FROM ev)"""


def exchange_dims(t: Tables) -> dict[str, DataFrame]:
    """Dimensions with gaps, so that misses occur: packages from ``part``, countries from ``nation``, media from ``supplier``."""
    small = t.region.select(F.col("r_regionkey").cast("string").alias("jsonkey"), (F.col("r_regionkey") + 100).cast("string").alias("id"))
    return {
        "pkg": t.part.where(F.col("p_partkey") % 5 != 0).select(F.concat(F.lit("pkg"), F.col("p_partkey").cast("string")).alias("name"), (F.col("p_partkey") + 500).cast("string").alias("id")),
        "country": t.nation.where(F.col("n_nationkey") != 3).select(F.col("n_name").alias("jsonkey"), F.col("n_nationkey").cast("string").alias("id")),
        "platform": small,
        "style": small.where(F.col("jsonkey") != "2"),
        "media": t.supplier.where(F.col("s_suppkey") % 11 != 10).select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_nationkey").cast("string").alias("mlevel_id")),
    }


EXCHANGE_DIMS_CTE = """d_pkg AS (SELECT 'pkg' || p_partkey AS name, CAST(p_partkey + 500 AS VARCHAR) AS id FROM part WHERE p_partkey % 5 <> 0),
d_country AS (SELECT n_name AS jsonkey, CAST(n_nationkey AS VARCHAR) AS id FROM nation WHERE n_nationkey <> 3),
d_platform AS (SELECT CAST(r_regionkey AS VARCHAR) AS jsonkey, CAST(r_regionkey + 100 AS VARCHAR) AS id FROM region),
d_style AS (SELECT * FROM d_platform WHERE jsonkey <> '2'),
d_media AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS mlevel_id FROM supplier WHERE s_suppkey % 11 <> 10)"""


def device_log(t: Tables) -> DataFrame:
    """Device columns on every ``events`` row: ids with placeholders, producer, carrier, network, addresses."""
    u, k = F.col("user_id"), F.col("k")
    text = u.cast("string")
    return events(t).select(
        "event_id", "event_type", "value", "sec", "day", "hour", "k", "user_id",
        (u % 2 + 1).cast("string").alias("os"),
        F.when(u % 5 == 0, "000000000000000").when(u % 7 == 0, F.md5(text)).when(u % 11 == 0, "").otherwise(F.concat(F.lit("86"), F.lpad(text, 13, "0"))).alias("imei"),
        F.when(u % 6 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("IDFA-"), text)).alias("idfa"),
        F.when(u % 10 == 0, "00000000-0000-0000-0000-000000000000").otherwise(F.concat(F.lit("oa-"), text)).alias("oaid"),
        F.when(u % 13 == 0, "unknown").otherwise(F.concat(F.lit("an"), text)).alias("android_id"),
        F.concat_ws(".", (u % 200 + 1).cast("string"), (k % 256).cast("string"), (u * 7 % 256).cast("string"), (k * 3 % 256).cast("string")).alias("ip"),
        F.when(k % 5 == 0, "HUAWEI P30").when(k % 5 == 1, "iPhone 11").when(k % 5 == 2, "Redmi Note").when(k % 5 == 3, "GREE").otherwise("").alias("producer"),
        F.concat(F.lit("c"), (k % 3).cast("string")).alias("carrier"), (k % 2).cast("string").alias("network"), (u % 25).cast("string").alias("city_id"),
        (u % 4).cast("string").alias("app_id"), (u % 3 + k % 2).cast("string").alias("adsolt_id"),
        F.concat(F.lit("cr"), (k % 7).cast("string")).alias("creative_id"),
        F.when(k % 4 == 0, "alp_1").when(k % 4 == 1, "alp_2").when(k % 4 == 2, "alp_3").otherwise("alp_4").alias("ocpx_tag"),
    )


DEVICE_CTE = EVENTS_CTE + """, dv AS (
  SELECT event_id, event_type, value, sec, day, hour, k, user_id, CAST(user_id % 2 + 1 AS VARCHAR) AS os,
    CASE WHEN user_id % 5 = 0 THEN '000000000000000' WHEN user_id % 7 = 0 THEN md5(CAST(user_id AS VARCHAR)) WHEN user_id % 11 = 0 THEN ''
         ELSE '86' || lpad(CAST(user_id AS VARCHAR), 13, '0') END AS imei,
    CASE WHEN user_id % 6 = 0 THEN NULL ELSE 'IDFA-' || user_id END AS idfa,
    CASE WHEN user_id % 10 = 0 THEN '00000000-0000-0000-0000-000000000000' ELSE 'oa-' || user_id END AS oaid,
    CASE WHEN user_id % 13 = 0 THEN 'unknown' ELSE 'an' || user_id END AS android_id,
    (user_id % 200 + 1) || '.' || (k % 256) || '.' || (user_id * 7 % 256) || '.' || (k * 3 % 256) AS ip,
    CASE k % 5 WHEN 0 THEN 'HUAWEI P30' WHEN 1 THEN 'iPhone 11' WHEN 2 THEN 'Redmi Note' WHEN 3 THEN 'GREE' ELSE '' END AS producer,
    'c' || (k % 3) AS carrier, CAST(k % 2 AS VARCHAR) AS network, CAST(user_id % 25 AS VARCHAR) AS city_id,
    CAST(user_id % 4 AS VARCHAR) AS app_id, CAST(user_id % 3 + k % 2 AS VARCHAR) AS adsolt_id, 'cr' || (k % 7) AS creative_id,
    CASE k % 4 WHEN 0 THEN 'alp_1' WHEN 1 THEN 'alp_2' WHEN 2 THEN 'alp_3' ELSE 'alp_4' END AS ocpx_tag
  FROM ev)"""

# SQL for the canonical device id and its kind over a table with os, imei, idfa, oaid.
DEVICE_ID_SQL = """CASE WHEN os = '1' THEN CASE WHEN imei IS NOT NULL AND imei <> '' AND imei <> '000000000000000' THEN CASE WHEN length(imei) = 32 THEN imei ELSE md5(imei) END
    WHEN oaid IS NOT NULL AND oaid <> '' AND oaid <> '00000000-0000-0000-0000-000000000000' THEN CASE WHEN length(oaid) = 32 THEN oaid ELSE md5(oaid) END END
  WHEN os = '2' THEN CASE WHEN idfa IS NOT NULL AND idfa <> '' THEN CASE WHEN length(idfa) = 32 THEN idfa ELSE md5(idfa) END END END"""
