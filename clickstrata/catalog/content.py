"""Content-feed statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identity import anonymous_visitor_id
from ..plans import content as N
from .registry import Tables, query
from .stand_ins import EVENTS_CTE, events

FEED_CTE = EVENTS_CTE + """, fd AS (SELECT event_type, day, hour, user_id, k, CASE WHEN user_id % 11 = 0 THEN '' ELSE CAST(user_id % 4 AS VARCHAR) END AS media, CAST(k % 3 AS VARCHAR) AS gate,
  CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'ASIA' WHEN 2 THEN 'EUROPE' ELSE 'garbled' END AS chan, CASE WHEN k % 6 = 0 THEN '' WHEN k % 6 = 1 THEN 'x1' ELSE CAST(k % 9 AS VARCHAR) END AS cont,
  CASE WHEN k % 2 = 0 THEN '1' ELSE '2' END AS adv, CAST(k % 2 AS VARCHAR) AS src, CAST(user_id % 3 AS VARCHAR) AS srcid, CAST(k % 2 AS VARCHAR) AS typ, CASE WHEN user_id % 13 = 0 THEN '' ELSE CAST(user_id % 28 AS VARCHAR) END AS city,
  CASE k % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '3' END AS fos FROM ev)"""


def feed(t: Tables):
    u, k = F.col("user_id"), F.col("k")
    return events(t).select(
        "event_type", "day", "hour", F.when(u % 11 == 0, "").otherwise((u % 4).cast("string")).alias("mediaID"), (k % 3).cast("string").alias("mediaGateID"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, "ASIA").when(k % 4 == 2, "EUROPE").otherwise("garbled").alias("channel"),
        F.when(k % 6 == 0, "").when(k % 6 == 1, "x1").otherwise((k % 9).cast("string")).alias("contentID"), F.when(k % 2 == 0, "1").otherwise("2").alias("advType"),
        (k % 2).cast("string").alias("advSource"), (u % 3).cast("string").alias("advSourceID"), (k % 2).cast("string").alias("advTypeID"),
        F.when(u % 13 == 0, "").otherwise((u % 28).cast("string")).alias("cityID"), F.when(k % 3 == 0, "1").when(k % 3 == 1, "2").otherwise("3").alias("os"),
        F.when(k % 2 == 0, F.concat(F.lit("an"), u)).otherwise("").alias("androidId"), F.concat(F.lit("if"), u).alias("idfa"), F.concat(F.lit("ck"), u).alias("cookie"),
    )


def feed_logs(t: Tables):
    f = feed(t)
    return {"h5_req": f.where("event_type = 'view'"), "api_req": f.where("event_type = 'signup'"), "imp": f.where("event_type IN ('error', 'purchase')"), "clk": f.where("event_type = 'click'")}


def dims(t: Tables):
    channels = t.region.select(F.col("r_name").alias("name"))
    apps = t.nation.where("n_nationkey <> 2").select(F.col("n_nationkey").cast("string").alias("id"), (F.col("n_nationkey") + 100).alias("user_id"), F.col("n_regionkey").alias("put_platform_id"))
    cities = t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_regionkey").cast("string").alias("province_id"))
    return channels, apps, cities


B = "CASE WHEN {c} = '' THEN '-1' ELSE {c} END"
CHAN = "CASE WHEN chan = '' THEN '固定' ELSE chan END"
HOURS_SQL = f"""fm AS (SELECT {B.format(c='media')} AS m, gate AS g, CASE event_type WHEN 'view' THEN '-1' ELSE {CHAN} END AS c, CASE WHEN event_type IN ('view', 'signup') THEN '-1' ELSE {B.format(c='cont')} END AS n,
  CASE WHEN event_type IN ('view', 'signup') THEN '-1' ELSE src END AS a, CASE WHEN event_type IN ('view', 'signup') THEN '-1' ELSE srcid END AS ai, CASE WHEN event_type IN ('view', 'signup') THEN '-1' ELSE typ END AS ty, {B.format(c='city')} AS ci,
  event_type, adv, day, hour FROM fd),
fh AS (SELECT m AS app_id, CAST(ap.n_nationkey + 100 AS BIGINT) AS user_id, n AS content_source_id, g AS properties_id, ai AS real_tag_id, c AS channel, a AS code_advsource, ty AS code_style_id, ci AS city_id, coalesce(CAST(ct.n_regionkey AS VARCHAR), '0') AS province_id, CAST(ap.n_regionkey AS BIGINT) AS put_platform_id,
  fm.event_type, adv, day, hour FROM fm LEFT JOIN nation ap ON m = CAST(ap.n_nationkey AS VARCHAR) AND ap.n_nationkey <> 2 LEFT JOIN nation ct ON ci = CAST(ct.n_nationkey AS VARCHAR)
  WHERE (c = '-1' OR c IN (SELECT r_name FROM region)) AND ap.n_nationkey IS NOT NULL AND regexp_full_match(n, '-?[0-9]+'))"""
MEASURES = """count(*) FILTER (WHERE event_type IN ('error', 'purchase') AND adv = '1') AS cr_imps, count(*) FILTER (WHERE event_type = 'click' AND adv = '1') AS cr_clicks, count(*) FILTER (WHERE event_type IN ('error', 'purchase') AND adv = '2') AS ad_imps,
  count(*) FILTER (WHERE event_type = 'click' AND adv = '2') AS ad_clicks, count(*) FILTER (WHERE event_type = 'view') AS h5_request, count(*) FILTER (WHERE event_type = 'signup') AS api_request"""
STAT = ", ".join(N.STAT_KEYS)
PROVINCE = ", ".join(N.PROVINCE_KEYS)


def stats(t: Tables):
    return N.content_hour(N.content_funnel(feed_logs(t)), *dims(t))


def hourly_stats(t: Tables):
    """The hourly table of every hour at once."""
    logs = {n: df.withColumn("time", F.concat("day", F.lit(" "), "hour", F.lit(":00:00"))) for n, df in feed_logs(t).items()}
    return N.content_hour(N.content_funnel(logs, ["time"]), *dims(t), ["time"])


@query("content_hour", f"WITH {FEED_CTE}, {HOURS_SQL} SELECT {STAT}, {MEASURES} FROM fh GROUP BY {STAT}")
def _(t: Tables):
    return stats(t)


@query("content_day", f"WITH {FEED_CTE}, {HOURS_SQL} SELECT day, {STAT}, {MEASURES} FROM fh GROUP BY day, {STAT}")
def _(t: Tables):
    return N.content_day(hourly_stats(t))


@query("content_comparison", f"WITH {FEED_CTE}, {HOURS_SQL} SELECT day || ' ' || hour || ':00:00' AS time, app_id, user_id, properties_id, put_platform_id, {MEASURES} FROM fh GROUP BY ALL")
def _(t: Tables):
    return N.data_comparison(hourly_stats(t))


UV_SQL = f"""vu AS (SELECT {B.format(c='media')} AS app_id, gate AS properties_id, {CHAN} AS channel, coalesce(CAST(ct.n_regionkey AS VARCHAR), '0') AS province_id,
  CASE WHEN fos IN ('1', '2') THEN CASE WHEN k % 2 = 0 THEN 'an' || user_id ELSE 'if' || user_id END ELSE 'ck' || user_id END AS v FROM fd LEFT JOIN nation ct ON {B.format(c='city')} = CAST(ct.n_nationkey AS VARCHAR) WHERE event_type = 'signup'),
uv AS (SELECT app_id, properties_id, channel, province_id, CAST(ap.n_nationkey + 100 AS BIGINT) AS user_id, CAST(ap.n_regionkey AS BIGINT) AS put_platform_id, count(DISTINCT v) AS uv FROM vu JOIN nation ap ON app_id = CAST(ap.n_nationkey AS VARCHAR) AND ap.n_nationkey <> 2
  WHERE channel = '-1' OR channel IN (SELECT r_name FROM region) GROUP BY ALL)"""


def visitors(t: Tables):
    channels, apps, cities = dims(t)
    return N.content_uv(feed_logs(t)["api_req"], anonymous_visitor_id("os", "androidId", "idfa", "cookie"), cities, channels, apps)


@query("content_visitors", f"WITH {FEED_CTE}, {UV_SQL} SELECT app_id, properties_id, channel, province_id, user_id, put_platform_id, uv FROM uv")
def _(t: Tables):
    return visitors(t).select("app_id", "properties_id", "channel", "province_id", "user_id", "put_platform_id", "uv")


@query("content_province", f"""WITH {FEED_CTE}, {HOURS_SQL}, {UV_SQL}, pv AS (SELECT {PROVINCE}, {MEASURES} FROM fh GROUP BY {PROVINCE})
SELECT pv.*, coalesce(uv.uv, 0) AS uv FROM pv LEFT JOIN uv ON pv.content_source_id = '-1' AND pv.real_tag_id = '-1' AND pv.code_advsource = '-1' AND pv.code_style_id = '-1' AND pv.app_id = uv.app_id AND pv.properties_id = uv.properties_id
  AND pv.channel = uv.channel AND pv.province_id = uv.province_id AND pv.user_id = uv.user_id AND pv.put_platform_id = uv.put_platform_id""")
def _(t: Tables):
    return N.content_province(stats(t), visitors(t))


@query("tag_map", """WITH rep AS (SELECT p_size AS app_id, p_partkey % 7 - 1 AS user_id, CAST(p_partkey % 5 AS VARCHAR) AS properties_id, p_brand AS tag_name, ' ' || p_brand AS tag_id FROM part),
st AS (SELECT l_linenumber AS app_id, l_suppkey % 3 AS user_id, CAST(l_partkey % 4 AS VARCHAR) AS properties_id, CASE WHEN l_partkey % 3 = 0 THEN ' Brand#' || (l_partkey % 30) ELSE '-1' END AS tag FROM lineitem),
nm AS (SELECT DISTINCT tag_id, tag_name FROM rep)
SELECT DISTINCT * FROM (SELECT CAST(app_id AS BIGINT) AS app_id, user_id, properties_id, tag_name, trim(tag_id) AS tag_id FROM rep WHERE user_id <> -1 UNION ALL
SELECT CAST(app_id AS BIGINT), user_id, properties_id, CASE WHEN nm.tag_id IS NOT NULL THEN nm.tag_name ELSE tag END, trim(tag) FROM st LEFT JOIN nm ON tag = nm.tag_id WHERE tag <> '-1')""")
def _(t: Tables):
    report = t.part.select(F.col("p_size").cast("bigint").alias("app_id"), (F.col("p_partkey") % 7 - 1).alias("user_id"), (F.col("p_partkey") % 5).cast("string").alias("properties_id"),
                           F.col("p_brand").alias("tag_name"), F.concat(F.lit(" "), "p_brand").alias("tag_id"))
    tag = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit(" Brand#"), F.col("l_partkey") % 30)).otherwise("-1")
    used = t.lineitem.select(F.col("l_linenumber").cast("bigint").alias("app_id"), (F.col("l_suppkey") % 3).alias("user_id"), (F.col("l_partkey") % 4).cast("string").alias("properties_id"), tag.alias("real_tag_id"))
    return N.tag_map(report, used)
