"""Line parsers and column expressions: lines are built from table columns, parsed back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import devices as D
from ..functions import identity as I
from ..functions import requests as Q
from ..sources import lines as L
from ..sources.scans import read_date_range, read_hour_range, read_partition
from .registry import Tables, query, r
from .stand_ins import DEVICE_CTE, DEVICE_ID_SQL, EVENTS_CTE, device_log, events


@query("read_partition_hour", f"WITH {EVENTS_CTE} SELECT event_id, user_id FROM ev WHERE day = '2024-01-07' AND hour = '12'")
def _(t: Tables):
    return read_partition(events(t), "2024-01-07", "12", "day", "hour").select("event_id", "user_id")


@query("read_hour_range", f"WITH {EVENTS_CTE} SELECT event_id FROM ev WHERE day = '2024-01-07' AND hour BETWEEN '03' AND '05'")
def _(t: Tables):
    return read_hour_range(events(t), "2024-01-07", "03", "05", "day", "hour").select("event_id")


@query("read_last_days", f"WITH {EVENTS_CTE} SELECT day, count(*) AS n FROM ev WHERE day BETWEEN '2024-01-08' AND '2024-01-10' GROUP BY day")
def _(t: Tables):
    return read_date_range(events(t), "2024-01-10", 3, date_col="day").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


TSV = {"id": (0, "bigint"), "nation": (2, "int"), "balance": (3, "double"), "segment": (4, "string"), "absent": (9, "string")}


@query("parse_tsv", f"SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, {r('c_acctbal')} AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS absent FROM customer")
def _(t: Tables):
    line = F.concat_ws("\t", "c_custkey", "c_name", F.concat(F.lit(" "), F.col("c_nationkey").cast("string")), F.col("c_acctbal").cast("string"), "c_mktsegment", F.lit(""))
    return L.parse_tsv(t.customer.select(line.alias("value")), TSV, min_cols=6)


@query("parse_pipe_fields", "SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier")
def _(t: Tables):
    line = F.concat_ws("|", "s_suppkey", "s_name", F.col("s_nationkey").cast("string"))
    return L.parse_sep(t.supplier.select(line.alias("value")), "|", {"id": (0, "bigint"), "name": (1, "string"), "nation": (2, "int")}, exact_cols=3)


@query("parse_control_char_fields", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW'")
def _(t: Tables):
    # A third field on some lines makes them fail the exact field count.
    line = F.concat_ws("\x01", F.col("o_orderkey").cast("string"), "o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", "x"))
    return L.parse_sep(t.orders.select(line.alias("value")), "\x01", {"id": (0, "bigint"), "status": (1, "string")}, exact_cols=2)


@query("parse_marked_kv", f"WITH {EVENTS_CTE} SELECT sec AS ts, k % 5 AS type, CAST(user_id AS VARCHAR) AS uid, k AS cnt FROM ev WHERE event_type <> 'error'")
def _(t: Tables):
    body = F.concat(F.lit("[[[ts="), F.col("sec"), F.lit("&type="), F.col("k") % 5, F.lit("&uid="), F.col("user_id"), F.lit("&cnt="), F.col("k"), F.lit("]]]"))
    line = F.concat(F.lit("noise "), F.when(F.col("event_type") != "error", body).otherwise(F.lit("no marker")), F.lit(" tail"))
    return L.parse_marked_kv(events(t).select(line.alias("value")), {"ts": "bigint", "type": "bigint", "uid": "string", "cnt": "bigint"})


@query("parse_request_query", """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
  nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source FROM pages""")
def _(t: Tables):
    lines = t.pages.select("page_id", F.concat(F.lit("GET "), F.substring_index("url", "#", 1), F.lit(" HTTP/1.1")).alias("request"))
    return L.parse_request_query(lines, {"page": "page", "ref": "ref", "utm_source": "source"}).drop("request")


@query("page_url_parts", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, CAST(CASE WHEN url LIKE '%utm_source=feed%' THEN 1 ELSE 0 END AS BIGINT) AS from_feed FROM pages")
def _(t: Tables):
    return t.pages.select(
        "page_id", Q.url_host("url").alias("host"), Q.url_path("url").alias("path"),
        F.coalesce(Q.url_query("url")["utm_source"] == "feed", F.lit(False)).alias("from_feed"),
    )


@query("parse_access_line", f"""WITH {EVENTS_CTE} SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, '10.0.0.' || (k % 256) AS ip, CAST(k % 4 AS VARCHAR) AS event,
  'ad' || (user_id % 9) AS ad, 'u' || user_id AS uid, '200' AS resp_code FROM ev WHERE event_type <> 'error'""")
def _(t: Tables):
    e = events(t)
    request = F.concat(
        F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0700]"PUT /api/v1/adsync?ad=ad'), F.col("user_id") % 9,
        F.lit("&event="), F.col("k") % 4, F.lit("&msg=&os=android&uid=u"), F.col("user_id"), F.lit('&ver=5.9.0 HTTP/1.1"'),
    )
    fields = [F.concat(F.lit("10.0.0."), F.col("k") % 256), F.lit("-"), request, F.lit("200"), F.lit("0.000"), F.lit("32"), F.lit("-"), F.lit("Dalvik/2.1.0"), F.lit("-")]
    good, short = F.concat_ws("\t", *fields), F.concat_ws("\t", *fields[:5])
    parsed = L.parse_access_line(e.select(F.when(F.col("event_type") == "error", short).otherwise(good).alias("value")))
    return parsed.select("date", "hour", "ip", "url.event", "url.ad", "url.uid", "resp_code")


@query("normalize_uri", """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '/api/v1/sa' WHEN page_id % 4 = 1 THEN '/vip' || page_id WHEN page_id % 4 = 2 THEN NULL
  ELSE regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) END AS uri FROM pages""")
def _(t: Tables):
    n = F.col("page_id") % 4
    line = (
        F.when(n == 0, F.concat(F.lit("GET /api/v1/sa?x="), "page_id", F.lit(" HTTP/1.1")))
        .when(n == 1, F.concat(F.lit("GET  /vip"), "page_id", F.lit(".html HTTP/1.1")))
        .when(n == 2, F.lit("broken line with five tokens"))
        .otherwise(F.concat(F.lit("GET "), Q.url_path("url"), F.lit(" HTTP/1.1")))
    )
    return t.pages.select("page_id", Q.normalize_uri(line).alias("uri"))


@query("blank_to_default", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 3 = 1 THEN '-1' ELSE o_orderstatus END AS status FROM orders")
def _(t: Tables):
    n = F.col("o_orderkey") % 3
    raw = F.when(n == 0, F.lit(None).cast("string")).when(n == 1, F.lit(" ")).otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", C.blank_to(raw).alias("status"))


@query("require_numeric_ids", "SELECT p_partkey, p_brand FROM part WHERE p_size % 2 = 0")
def _(t: Tables):
    raw = t.part.withColumn("id", F.when(F.col("p_size") % 2 == 0, F.col("p_partkey").cast("string")).otherwise(F.col("p_brand")))
    return C.require_numeric_ids(raw, ["id"]).select("p_partkey", "p_brand")


@query("canonical_device_ids", f"""WITH {DEVICE_CTE} SELECT event_id, {DEVICE_ID_SQL} AS id,
  CAST(CASE WHEN os = '1' THEN CASE WHEN imei IS NULL OR imei = '' OR imei = '000000000000000' THEN 3 ELSE 1 END ELSE 2 END AS BIGINT) AS id_type FROM dv""")
def _(t: Tables):
    return device_log(t).select("event_id", I.canonical_device_id("os", "imei", "idfa", "oaid").alias("id"), I.device_id_type("os", "imei").alias("id_type"))


@query("plain_and_md5_ids", f"WITH {DEVICE_CTE} SELECT event_id, CASE WHEN length(imei) = 32 THEN NULL ELSE imei END AS plain, CASE WHEN length(imei) = 32 THEN imei ELSE md5(imei) END AS hashed FROM dv")
def _(t: Tables):
    plain, hashed = I.plain_and_md5("imei")
    return device_log(t).select("event_id", plain.alias("plain"), hashed.alias("hashed"))


@query("valid_device_values", f"WITH {DEVICE_CTE} SELECT event_id, CAST(CASE WHEN imei NOT IN ('', '000000000000000') THEN 1 ELSE 0 END AS BIGINT) AS imei_ok, CAST(CASE WHEN android_id <> 'unknown' THEN 1 ELSE 0 END AS BIGINT) AS android_ok, CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS ip_ok FROM dv")
def _(t: Tables):
    broken = F.when(F.col("k") % 2 == 0, F.concat(F.lit("3"), F.lpad("ip", 15, "0"))).otherwise(F.concat("ip", F.lit(".1")))
    return device_log(t).withColumn("ip", F.when(F.col("k") % 7 == 0, broken).otherwise(F.col("ip"))).select(
        "event_id", C.valid_device_value("imei").alias("imei_ok"), C.valid_device_value("android_id").alias("android_ok"), C.valid_ipv4("ip").alias("ip_ok")
    )


@query("ip_prefixes", f"WITH {DEVICE_CTE} SELECT event_id, printf('%02x%02x%02x', user_id % 200 + 1, k % 256, user_id * 7 % 256) AS prefix, (user_id % 200 + 1) * 16777216 + (k % 256) * 65536 + (user_id * 7 % 256) * 256 + (k * 3 % 256) AS number FROM dv")
def _(t: Tables):
    return device_log(t).select("event_id", I.ip_prefix_hex("ip").alias("prefix"), I.ip_to_long("ip").alias("number"))


#: A handset of every brand, and one of none.
HANDSETS = {
    "huawei": "HUAWEI P30", "apple": "iPhone 11", "oppo": "OPPO R9", "vivo": "vivo X9", "honor": "HONOR 20", "xiaomi": "Xiaomi Mix", "meizu": "MEIZU", "samsung": "SAMSUNG S9", "redmi": "Redmi Note",
    "oneplus": "OnePlus 7", "gionee": "GIONEE M7", "360": "360 N7", "meitu": "Meitu T8", "smartisan": "Smartisan U3", "nubia": "nubia Z20", "leeco": "LeEco Pro", "lenovo": "Lenovo Z6", "hisense": "Hisense A5",
    "zte": "ZTE Axon", "nokia": "Nokia X7", "coolpad": "Coolpad 10", "realme": "realme X2", "motorola": "Motorola Z2", "koobee": "koobee K20", "sony": "Sony Xperia", "doov": "DOOV D900", "other": "GREE",
}


@query("handset_brands", f"WITH {EVENTS_CTE} SELECT event_id, ([{', '.join(repr(b) for b in HANDSETS)}])[event_id % {len(HANDSETS)} + 1] AS brand FROM ev")
def _(t: Tables):
    names = F.array(*[F.lit(n) for n in HANDSETS.values()])
    return events(t).select("event_id", D.brand_of(F.get(names, F.col("event_id") % len(HANDSETS))).alias("brand"))


@query("browser_families", f"""WITH {EVENTS_CTE} SELECT event_id, CASE k % 4 WHEN 0 THEN 'Chrome' || (k + 1) WHEN 1 THEN 'Firefox' || (k + 1) WHEN 2 THEN 'MicroMessenger8' ELSE '' END AS browser FROM ev""")
def _(t: Tables):
    k = F.col("k")
    ua = (
        F.when(k % 4 == 0, F.concat(F.lit("Mozilla/5.0%20(X11)%20AppleWebKit/537.36%20Chrome/"), k + 1, F.lit(".0.1%20Safari/537.36")))
        .when(k % 4 == 1, F.concat(F.lit("Mozilla/5.0%20(X11)%20Gecko%20Firefox/"), k + 1, F.lit(".0")))
        .when(k % 4 == 2, F.lit("Mozilla/5.0%20(iPhone)%20AppleWebKit/605.1%20MicroMessenger/8.0.2"))
        .otherwise(F.lit(""))
    )
    return events(t).select("event_id", D.ua_browser(D.url_decode(ua)).alias("browser"))


@query("creative_image_urls", """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'http://i/' || p_partkey || '.jpg' WHEN 1 THEN 'http://o/' || p_partkey || '.png' END AS img_url,
  CASE p_size % 4 WHEN 0 THEN md5('http://i/' || p_partkey || '.jpg') WHEN 1 THEN md5('http://o/' || p_partkey || '.png') END AS img_url_md5 FROM part""")
def _(t: Tables):
    n = F.col("p_size") % 4
    js = (
        F.when(n == 0, F.concat(F.lit('{"img":[{"url":"http:\\/\\/i\\/'), "p_partkey", F.lit('.jpg"}]}')))
        .when(n == 1, F.concat(F.lit('{"imgurl":"http://o/'), "p_partkey", F.lit('.png"}')))
        .when(n == 2, F.lit('{"img":[]}')).otherwise(F.lit("not json"))
    )
    url = Q.creative_image_url(js, F.when(n.isin(0, 2), 3).otherwise(1))
    return t.part.select("p_partkey", url.alias("img_url"), F.md5(url).alias("img_url_md5"))


@query("split_dimensions", "SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN CAST(p_size * 10 AS VARCHAR) END AS width, CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS VARCHAR) END AS height FROM part")
def _(t: Tables):
    size = F.col("p_size")
    w, h = C.split_dims(F.when(size % 3 > 0, F.concat((size * 10).cast("string"), F.lit("x"), size.cast("string"))).otherwise(F.lit("640")))
    return t.part.select("p_partkey", w.alias("width"), h.alias("height"))


@query("truncated_coordinates", "SELECT s_suppkey, regexp_extract(CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS VARCHAR), '^([^.]*)', 1) AS text_part, CAST(floor(s_acctbal) AS BIGINT) AS floor_part FROM supplier")
def _(t: Tables):
    text = F.col("s_acctbal").cast("decimal(12,2)").cast("string")
    return t.supplier.select("s_suppkey", C.truncate_coord(text).alias("text_part"), C.floor_coord(text).alias("floor_part"))


@query("utc_buckets", f"WITH {EVENTS_CTE} SELECT event_id, sec - sec % 3600 AS hour_start, sec - sec % 86400 AS day_start FROM ev")
def _(t: Tables):
    return events(t).select("event_id", C.utc_bucket("sec", "hour").alias("hour_start"), C.utc_bucket("sec", "day").alias("day_start"))


@query("tagged_creatives", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS adslocation_type_id, '2024-01-01' AS time, 'no' AS del FROM part WHERE p_size % 2 = 0")
def _(t: Tables):
    raw = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.lit("n/a")).alias("adslocation_type_id"))
    return C.tag_columns(C.require_numeric_ids(raw, ["adslocation_type_id"], C.UNSIGNED_ID), time="2024-01-01", del_="no")


@query("limited_lengths", "SELECT doc_id FROM documents WHERE length(text) <= 500 AND length(source) <= 4")
def _(t: Tables):
    return C.max_length(t.documents, {"text": 500, "source": 4}).select("doc_id")


@query("content_click_filter", f"WITH {EVENTS_CTE} SELECT event_id FROM ev WHERE event_type = 'click' AND k % 3 = 0 AND user_id % 2 = 0")
def _(t: Tables):
    k = F.col("k")
    clicks = events(t).select(
        "event_id", F.when(F.col("event_type") == "click", "1").otherwise("2").alias("logType"),
        F.when(k % 3 == 0, F.concat(F.lit("yd_"), F.md5(k.cast("string")))).otherwise(F.lit("yd_short")).alias("contentId"),
        F.when(F.col("user_id") % 2 == 0, F.lit("科技")).otherwise(F.lit("tech1")).alias("channel"),
    )
    return C.content_click_filter(clicks, channel="channel").select("event_id")


@query("excluded_media", f"WITH {DEVICE_CTE} SELECT app_id, count(*) AS n FROM dv WHERE app_id NOT IN ('1', '3') GROUP BY app_id")
def _(t: Tables):
    return C.exclude_values(device_log(t), "app_id", ["1", "3"]).groupBy("app_id").agg(F.count(F.lit(1)).alias("n"))
