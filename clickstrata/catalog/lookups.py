"""Dimension look-ups, membership and range joins over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims as O
from ..plans import access as A
from ..plans.reports import plan_media_lookup
from .registry import Tables, query
from .stand_ins import DEVICE_CTE, EVENTS_CTE, device_log, events


@query("lookup_chain", """WITH c AS (SELECT * FROM customer WHERE c_custkey % 4 > 0), n AS (SELECT * FROM nation WHERE n_nationkey <> 3)
SELECT coalesce(c.c_mktsegment, '-1') AS segment, coalesce(n.n_name, '-1') AS nation, coalesce(g.r_name, '-1') AS region, count(*) AS orders
FROM orders o LEFT JOIN c ON o.o_custkey = c.c_custkey LEFT JOIN n ON c.c_nationkey = n.n_nationkey LEFT JOIN region g ON n.n_regionkey = g.r_regionkey GROUP BY ALL""")
def _(t: Tables):
    customers = t.customer.where(F.col("c_custkey") % 4 > 0)
    nations = t.nation.where(F.col("n_nationkey") != 3)
    # Orders are counted per customer first; names are looked up on the counts.
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    named = O.lookup_dims(per_customer, [O.DimSpec(customers, "o_custkey", "c_custkey", {"segment": "c_mktsegment", "_nation": "c_nationkey"}, default=None)])
    named = O.lookup_dims(named, [O.DimSpec(nations, "_nation", "n_nationkey", {"nation": "n_name", "_region": "n_regionkey"}, default=None)])
    named = O.lookup_dims(named, [O.DimSpec(t.region, "_region", "r_regionkey", {"region": "r_name"})])
    return named.groupBy(O.blank_to("segment").alias("segment"), O.blank_to("nation").alias("nation"), "region").agg(F.sum("n").alias("orders"))


@query("keep_known_keys", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') OR o_custkey = 1")
def _(t: Tables):
    known = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return O.keep_known(t.orders, known, "o_custkey", "c_custkey", [1]).select("o_orderkey", "o_custkey")


@query("conditional_lookup", f"""WITH {EVENTS_CTE} SELECT event_id, CASE WHEN k % 3 = 0 THEN coalesce(r_name, '') WHEN k % 3 = 1 THEN coalesce(n_name, '') ELSE '' END AS name
FROM ev LEFT JOIN region ON k % 3 = 0 AND user_id % 10 = r_regionkey LEFT JOIN nation ON k % 3 = 1 AND user_id % 30 = n_nationkey""")
def _(t: Tables):
    e = events(t).select("event_id", "k", (F.col("user_id") % 10).alias("r"), (F.col("user_id") % 30).alias("n"))
    out = O.conditional_lookup(e, [
        (F.col("k") % 3 == 0, "r", t.region, "r_regionkey", "r_name"), (F.col("k") % 3 == 1, "n", t.nation, "n_nationkey", "n_name"),
    ], "name")
    return out.select("event_id", "name")


@query("request_id_join", f"WITH {EVENTS_CTE} SELECT DISTINCT user_id, k % 2 AS kind FROM ev WHERE event_type = 'view' AND event_id // 5 IN (SELECT event_id // 5 FROM ev WHERE event_type = 'click')")
def _(t: Tables):
    e = events(t).withColumns({"request_id": F.floor(F.col("event_id") / 5), "kind": F.col("k") % 2})
    return O.request_id_join(e.where("event_type = 'click'"), e.where("event_type = 'view'"), "request_id", ["user_id", "kind"])


RANGES = """rg AS (SELECT n.n_name, g.r_name, (CAST(n_nationkey AS BIGINT) * 8 + 1) * 16777216 AS lo, (CAST(n_nationkey AS BIGINT) * 8 + 7) * 16777216 + 8388607 AS hi FROM nation n JOIN region g ON n.n_regionkey = g.r_regionkey)"""


def nation_ranges(t: Tables):
    """One address range per nation: from octet 8n+1 to the middle of octet 8n+7."""
    first = (F.col("n_nationkey").cast("bigint") * 8 + 1) * 16777216
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        first.alias("ip_start"), ((F.col("n_nationkey").cast("bigint") * 8 + 7) * 16777216 + 8388607).alias("ip_end"), "n_name", "r_name"
    )


IP_NUM = "(user_id % 200 + 1) * 16777216 + (k % 256) * 65536 + (user_id * 7 % 256) * 256 + (k * 3 % 256)"


@query("ip_geo_join", f"WITH {DEVICE_CTE}, {RANGES} SELECT event_id, ip, n_name, r_name FROM dv LEFT JOIN rg ON {IP_NUM} BETWEEN lo AND hi")
def _(t: Tables):
    return O.ip_geo_join(device_log(t).select("event_id", "ip"), nation_ranges(t), "ip", ["n_name", "r_name"], prefix_bits=8)


@query("ip_as_of_join", f"WITH {DEVICE_CTE}, {RANGES} SELECT event_id, ip, n_name, r_name FROM dv LEFT JOIN rg ON {IP_NUM} BETWEEN lo AND hi")
def _(t: Tables):
    return O.ip_as_of_join(device_log(t).select("event_id", "ip"), nation_ranges(t), "ip", ["n_name", "r_name"])


@query("blacklist_counts", f"""WITH {DEVICE_CTE}, u AS (SELECT app_id, 'imei' AS kind, imei AS value FROM dv UNION ALL SELECT app_id, 'idfa', idfa FROM dv UNION ALL SELECT app_id, 'anid', android_id FROM dv),
bl AS (SELECT 'idfa' AS kind, 'IDFA-' || s_suppkey AS value FROM supplier UNION SELECT 'anid', 'an' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)
SELECT app_id, kind, count(*) FILTER (WHERE l) AS exists_cnt, count(*) FILTER (WHERE NOT l) AS not_exists_cnt
FROM (SELECT u.*, bl.value IS NOT NULL AS l FROM u LEFT JOIN bl USING (kind, value)) GROUP BY app_id, kind""")
def _(t: Tables):
    from ..operators.rules import unpivot_ids

    ids = unpivot_ids(device_log(t), {"imei": "imei", "idfa": "idfa", "anid": "android_id"}, keep=["app_id"])
    n = F.col("s_suppkey")
    listed = t.supplier.select(F.lit("idfa").alias("kind"), F.concat(F.lit("IDFA-"), n).alias("value")).unionByName(
        t.supplier.where(n % 2 == 0).select(F.lit("anid").alias("kind"), F.concat(F.lit("an"), n).alias("value"))
    )
    return O.blacklist_counts(ids, listed, ["app_id", "kind"], ["kind", "value"])


@query("blacklist_flags", f"WITH {EVENTS_CTE} SELECT event_id, CAST(CASE WHEN user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000) THEN 1 ELSE 0 END AS BIGINT) AS listed FROM ev")
def _(t: Tables):
    listed = t.supplier.where("s_acctbal < 3000").select(F.col("s_suppkey").alias("user_id"))
    return O.is_blacklisted(events(t), listed, ["user_id"]).select("event_id", "listed")


@query("in_set", "SELECT page_id FROM pages WHERE regexp_extract(url, '/([a-z]{2})/', 1) IN (SELECT DISTINCT lang FROM documents WHERE n_chars > 200)")
def _(t: Tables):
    pages = t.pages.select("page_id", F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))
    return O.in_set(pages, t.documents.where("n_chars > 200"), "lang", "lang").select("page_id")


@query("build_link_dim", "SELECT n_nationkey AS tags_map_id, n_name AS tags_md5, r_regionkey AS link_id, r_name AS url_id FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) g ON n_regionkey = r_regionkey".replace("n_nationkey AS", "CAST(n_nationkey AS BIGINT) AS").replace("r_regionkey AS", "CAST(r_regionkey AS BIGINT) AS"))
def _(t: Tables):
    links = t.region.where("r_regionkey <> 2")
    dim = O.build_link_dim(t.nation, links, {"n_regionkey": "r_regionkey"}, ["n_nationkey", "n_name", "r_regionkey", "r_name"])
    return dim.toDF("tags_map_id", "tags_md5", "link_id", "url_id")


@query("plan_media_lookup", """SELECT c_custkey AS plan_id, max(l.l_suppkey) AS adslocation_id, CAST(max(s.s_nationkey) AS BIGINT) AS media_id FROM customer
LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' LEFT JOIN lineitem l ON l_orderkey = o_orderkey LEFT JOIN supplier s ON s_suppkey = l_suppkey GROUP BY c_custkey""")
def _(t: Tables):
    placed = t.orders.where("o_orderstatus = 'F'").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("plan_id"), F.col("l_suppkey").alias("adslocation_id"))
    slots = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("media_id"))
    return plan_media_lookup(t.customer.select(F.col("c_custkey").alias("plan_id")), placed, slots)


@query("discover_dimension", "SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT 'Brand#' || n_nationkey FROM nation WHERE n_nationkey < 12)")
def _(t: Tables):
    known = t.nation.where("n_nationkey < 12").select(F.concat(F.lit("Brand#"), F.col("n_nationkey")).alias("name"))
    return O.discover_dimension(t.part, "p_brand", known, "name", max_len=500)


ACCESS_CTE = EVENTS_CTE + """, al AS (SELECT event_id, day || ' ' || hour || ':00:00' AS hour, day, CASE k % 4 WHEN 0 THEN 'resp' WHEN 1 THEN 'clk' ELSE 'call' END AS act,
  'd' || (user_id % 6) || '.com' AS domain, CAST(user_id % 8 AS VARCHAR) AS chid, 't' || (k % 2) AS template_id, '/p' || (k % 5) AS page, 'f' || (k % 2) AS adflag,
  'md' || (user_id % 12) AS adslocation_id, '10.1.' || (user_id % 5) || '.' || (user_id % 7) AS user_ip, 'com.pkg' || (user_id % 4) AS package_name FROM ev)"""


def access_log(t: Tables):
    """One slot-script request line per event."""
    u, k = F.col("user_id"), F.col("k")
    act = F.when(k % 4 == 0, "resp").when(k % 4 == 1, "clk").otherwise("call")
    request = F.concat(
        F.lit("GET /api/v1/sa?act="), act, F.lit("&domain=d"), u % 6, F.lit(".com&chid="), u % 8, F.lit("&template_id=t"), k % 2,
        F.lit("&page=/p"), k % 5, F.lit("&ad_flag=f"), k % 2, F.lit("&_id=md"), u % 12, F.lit(" HTTP/1.1"),
    )
    return events(t).select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-07:00")).alias("time"), request.alias("request"),
        F.concat(F.lit("10.1."), u % 5, F.lit("."), u % 7).alias("user_ip"), F.concat(F.lit("com.pkg"), u % 4).alias("package_name"), "day",
        F.concat(F.lit("host"), u % 3).alias("hostname"),
    )


def access_dims(t: Tables):
    tags = t.nation.where("n_nationkey % 3 <> 2").select(F.col("n_nationkey").alias("tags_map_id"), F.concat(F.lit("md"), "n_nationkey").alias("tags_md5"), F.col("n_regionkey").alias("link_id"),
                                                    (F.col("n_nationkey") + 50).alias("user_id"), (F.col("n_nationkey") + 70).alias("station_id"))
    urls = t.region.where("r_regionkey % 5 <> 4").select((F.col("r_regionkey") + 30).alias("id"), F.concat(F.lit("d"), "r_regionkey", F.lit(".com")).alias("url"))
    channels = t.region.select((F.col("r_regionkey") + 90).alias("id"), F.col("r_regionkey").cast("string").alias("channel_id"))
    return tags, urls, channels


ACCESS_DIMS = """tg AS (SELECT n_nationkey AS tags_map_id, 'md' || n_nationkey AS tags_md5, CAST(n_regionkey AS BIGINT) AS link_id, CAST(n_nationkey + 50 AS BIGINT) AS user_id, CAST(n_nationkey + 70 AS BIGINT) AS station_id FROM nation WHERE n_nationkey % 3 <> 2),
ur AS (SELECT CAST(r_regionkey + 30 AS VARCHAR) AS id, 'd' || r_regionkey || '.com' AS url FROM region WHERE r_regionkey % 5 <> 4), ch AS (SELECT CAST(r_regionkey + 90 AS VARCHAR) AS id, CAST(r_regionkey AS VARCHAR) AS channel_id FROM region)"""
ACT_COUNTS = "count(*) FILTER (WHERE act = 'call') AS impression, count(*) FILTER (WHERE act = 'resp') AS resp, count(*) FILTER (WHERE act = 'clk') AS clicks"


@query("access_stats_hourly", f"WITH {ACCESS_CTE} SELECT hour, adslocation_id, domain, chid, template_id, page, adflag, {ACT_COUNTS} FROM al GROUP BY ALL")
def _(t: Tables):
    return A.access_stats_hourly(access_log(t))


@query("access_stats_named", f"""WITH {ACCESS_CTE}, {ACCESS_DIMS}, g AS (SELECT hour, adslocation_id, domain, chid, template_id, page, adflag, {ACT_COUNTS} FROM al GROUP BY ALL)
SELECT hour, coalesce(CAST(tags_map_id AS VARCHAR), adslocation_id) AS adslocation_id, coalesce(ur.id, domain) AS domain, coalesce(ch.id, chid) AS chid, template_id, page, adflag, user_id, station_id, link_id, impression, resp, clicks
FROM g LEFT JOIN tg ON adslocation_id = tags_md5 LEFT JOIN ur ON domain = ur.url LEFT JOIN ch ON chid = ch.channel_id""")
def _(t: Tables):
    return A.access_stats_named(A.access_stats_hourly(access_log(t)), *access_dims(t))


@query("access_package_counts", f"""WITH {ACCESS_CTE}, {ACCESS_DIMS}, g AS (SELECT domain, chid, package_name, count(*) AS cnt FROM al GROUP BY ALL)
SELECT coalesce(ur.id, domain) AS domain, coalesce(ch.id, chid) AS chid, package_name, cnt FROM g LEFT JOIN ur ON domain = ur.url LEFT JOIN ch ON chid = ch.channel_id""")
def _(t: Tables):
    _, urls, channels = access_dims(t)
    return A.package_counts(access_log(t), urls, channels)


@query("slot_suspicious_ips", f"""WITH {ACCESS_CTE}, h AS (SELECT adslocation_id, user_ip, hour, {ACT_COUNTS} FROM al WHERE day = '2024-01-03' GROUP BY ALL),
g AS (SELECT adslocation_id, user_ip, CAST(sum(impression) AS BIGINT) AS impression, CAST(sum(resp) AS BIGINT) AS resp, max(clicks) AS clicks FROM h GROUP BY ALL),
f AS (SELECT *, impression > 4 AS c1, impression > 2 AND resp / impression < 0.5 AS c2, clicks > 1 AS c3 FROM g)
SELECT adslocation_id, user_ip, CAST(c1 AS BIGINT) AS condition1, CAST(c2 AS BIGINT) AS condition2, CAST(c3 AS BIGINT) AS condition3, CASE WHEN c1 OR c2 THEN impression END AS impression,
CASE WHEN c2 THEN resp END AS resp, nullif(clicks, 0) AS clicks FROM f WHERE c1 OR c2 OR c3""")
def _(t: Tables):
    log = access_log(t).where("day = '2024-01-03'")
    return A.slot_suspicious_ips(log, {"calls": 4, "few_calls": 2, "resp_ratio": 0.5, "hour_clicks": 1})


URLS = "CASE k % 3 WHEN 0 THEN '/api/v1/sa' WHEN 1 THEN '/vip' || (user_id % 4) ELSE '/x' || (user_id % 3) END"
URL_COUNTS = f"""uc AS (SELECT day, 'host' || (user_id % 3) AS hostname, 'host' || (user_id % 3) || {URLS} AS url, count(*) AS request_num FROM ev WHERE day IN ('2024-01-10', '2024-01-11') GROUP BY ALL)"""


def url_counts(t: Tables, day: str):
    u, k = F.col("user_id"), F.col("k")
    path = F.when(k % 3 == 0, F.concat(F.lit("/api/v1/sa?q="), k)).when(k % 3 == 1, F.concat(F.lit("/vip"), u % 4, F.lit(".html"))).otherwise(F.concat(F.lit("/x"), u % 3))
    log = events(t).where(F.col("day") == day).select(F.concat(F.lit("host"), u % 3).alias("hostname"), F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1")).alias("request"))
    return A.url_request_counts(log)


@query("url_request_counts", f"WITH {EVENTS_CTE}, {URL_COUNTS} SELECT hostname, url, request_num FROM uc WHERE day = '2024-01-10'")
def _(t: Tables):
    return url_counts(t, "2024-01-10")


@query("url_day_over_day", f"""WITH {EVENTS_CTE}, {URL_COUNTS} SELECT a.hostname, a.url, a.request_num, coalesce(b.request_num, 0) AS pre_request_num, a.request_num - coalesce(b.request_num, 0) AS change_num,
round(CASE WHEN b.request_num IS NULL THEN 999999.0 WHEN b.request_num < 15 THEN NULL ELSE CAST(a.request_num - b.request_num AS DOUBLE) / b.request_num END + 1e-9, 2) AS change_rate
FROM uc a LEFT JOIN uc b ON a.hostname = b.hostname AND a.url = b.url AND b.day = '2024-01-10' WHERE a.day = '2024-01-11'""")
def _(t: Tables):
    return A.day_over_day(url_counts(t, "2024-01-11"), url_counts(t, "2024-01-10"), ["hostname", "url"], "request_num", min_previous=15)
