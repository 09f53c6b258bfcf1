"""Funnels: many logs merged per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.aggregates import ratio
from ..operators.funnel import Agg, FactSpec, daily_uv, event_pivot, intersect_ids, merge_funnel, union_all
from ..operators.ranking import share_of_total
from ..plans import campaigns as P
from ..plans import exchange as X
from ..plans import supply as S
from .registry import Tables, query, r
from .stand_ins import (
    DEVICE_CTE,
    EVENTS_CTE,
    EXCHANGE_CTE,
    EXCHANGE_DIMS_CTE,
    device_log,
    events,
    exchange_dims,
    exchange_log,
)


def one(cond=None):
    n = F.lit(1).cast("bigint")
    return n if cond is None else F.when(cond, n)


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


DAILY_SQL = f"""WITH {EVENTS_CTE}, g AS (SELECT day, user_id, {cnt("event_type = 'view'")} AS views, {cnt("event_type = 'click'")} AS clicks, {cnt("event_type = 'purchase'")} AS purchases,
  {cnt("event_type = 'signup'")} AS signups, {cnt("event_type = 'error'")} AS errors, coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0) AS revenue FROM ev GROUP BY ALL)
SELECT day, user_id, views, clicks, purchases, signups, errors, {r('revenue')} AS revenue, {r('CAST(clicks AS DOUBLE) / nullif(views, 0)')} AS ctr,
  {r('CAST(views AS DOUBLE) / nullif(sum(views) OVER (PARTITION BY user_id), 0)')} AS view_share FROM g"""


def daily_user_funnel(t: Tables):
    """One row per day and user with a count per event type, the click rate and the day's share of the user's views.

    All five logs live in one table here, so they are one fact with conditional
    measures: one scan.
    """
    names = {"view": "views", "click": "clicks", "purchase": "purchases", "signup": "signups", "error": "errors"}
    kind = F.col("event_type")
    measures = {m: one(kind == k) for k, m in names.items()} | {"revenue": F.when(kind == "purchase", F.col("value"))}
    merged = merge_funnel([FactSpec(events(t), {"day": "day", "user_id": "user_id"}, measures)], ["day", "user_id"])
    with_ctr = merged.withColumn("ctr", ratio(F.col("clicks"), F.col("views")))
    return share_of_total(with_ctr, "views", ["user_id"], "view_share")


query("daily_user_funnel", DAILY_SQL)(daily_user_funnel)


@query("event_pivot", f"""WITH {EVENTS_CTE} SELECT day, {cnt("event_type = 'view'")} AS views, {cnt("event_type IN ('click', 'purchase')")} AS actions, {r("sum(value) FILTER (WHERE event_type = 'purchase')")} AS spent,
{r("avg(value) FILTER (WHERE event_type = 'click')")} AS click_value, {r("max(value) FILTER (WHERE event_type = 'click')")} AS click_max FROM ev GROUP BY day""")
def _(t: Tables):
    return event_pivot(events(t), ["day"], {
        "views": Agg("view"), "actions": Agg(["click", "purchase"]), "spent": Agg("purchase", "sum", "value"),
        "click_value": Agg("click", "avg", "value"), "click_max": Agg("click", "max", "value"),
    }, "event_type")


@query("merge_funnel_max", f"""WITH {EVENTS_CTE} SELECT user_id, {r("max(value) FILTER (WHERE event_type = 'view')")} AS top_view, {r("min(value) FILTER (WHERE event_type = 'click')")} AS low_click FROM ev WHERE event_type IN ('view', 'click') GROUP BY user_id""")
def _(t: Tables):
    e, key = events(t), {"user_id": "user_id"}
    return merge_funnel([
        FactSpec(e, key, {"top_view": F.col("value")}, F.col("event_type") == "view"),
        FactSpec(e, key, {"low_click": F.col("value")}, F.col("event_type") == "click"),
    ], ["user_id"], ops={"top_view": "max", "low_click": "min"}, fill=None)


LOG_OF = {"media_req": None, "dsp_req": ["view", "signup"], "media_resp": ["signup"], "imp": ["purchase"], "clk": ["click"], "dsp_win": ["error"]}


def exchange_logs(t: Tables):
    x = exchange_log(t).withColumn("tag_id", F.col("adsolt_type"))
    return {n: x if kinds is None else x.where(F.col("event_type").isin(kinds)) for n, kinds in LOG_OF.items()}


def in_types(*kinds: str) -> str:
    return "event_type IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"


RESOLVE = """coalesce(d_pkg.id, '-1') AS pkg_id, coalesce(d_country.id, '-1') AS country_id, coalesce(d_platform.id, '-1') AS platform_id, coalesce(d_style.id, '-1') AS style_id, coalesce(d_media.mlevel_id, '-1') AS mlevel_id"""
RESOLVE_JOINS = """LEFT JOIN d_pkg ON {a}.pkg = d_pkg.name LEFT JOIN d_country ON {a}.country = d_country.jsonkey LEFT JOIN d_platform ON {a}.platform = d_platform.jsonkey
  LEFT JOIN d_style ON {a}.style = d_style.jsonkey LEFT JOIN d_media ON {a}.media_id = d_media.id"""


def blank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN '-1' ELSE {c} END"


MEDIA_SQL = f"""mr AS (SELECT req_time - req_time % 3600 AS hour, {blank('app_id')} AS media_id, {blank('adsolt_id')} AS posid_id, pkg_name AS pkg, country, os AS platform, adsolt_type AS style, req_floor_price FROM x),
mh AS (SELECT hour, mr.media_id, posid_id, {RESOLVE}, count(*) AS ssp_req, sum(req_floor_price) AS ssp_floor FROM mr {RESOLVE_JOINS.format(a='mr')} GROUP BY ALL)"""


@query("media_request_hourly", f"WITH {EXCHANGE_CTE}, {EXCHANGE_DIMS_CTE}, {MEDIA_SQL} SELECT hour, media_id, posid_id, pkg_id, country_id, platform_id, style_id, mlevel_id, ssp_req, {r('ssp_floor')} AS ssp_floor FROM mh")
def _(t: Tables):
    return X.media_request_hourly(exchange_log(t), exchange_dims(t))


def block_sql(name: str, where: str, inner: str, outer: str, tagged: bool = False) -> str:
    """Two-phase block: once per request, then per resolved dimension; ``tagged`` adds tag and, for responses, size."""
    extra, joins = "", ""
    if tagged:
        size = "max('640*' || adsolt_id)" if name == "b_resp" else "NULL"
        inner = f"max(adsolt_type) AS tag, {size} AS size, {inner}"
        extra = "coalesce(d_tag.id, '-1') AS tag_id, coalesce(d_size.id, '-1') AS adsize_id, "
        joins = f" LEFT JOIN d_tag ON {name}1.tag = d_tag.name LEFT JOIN d_size ON {name}1.size = d_size.name"
    return f"""{name}0 AS (SELECT request_id, real_dsp_id AS dsp_id, dsp_id AS target_id, req_time - req_time % 3600 AS hour, max(app_id) AS app, max(adsolt_id) AS slot, max(pkg_name) AS pkg, max(country) AS country,
  max(os) AS platform, max(adsolt_type) AS style, {inner} FROM x WHERE {where} GROUP BY 1, 2, 3, 4),
{name}1 AS (SELECT *, {blank('app')} AS media_id, {blank('slot')} AS posid_id FROM {name}0),
{name} AS (SELECT hour, dsp_id, target_id, {name}1.media_id, posid_id, {RESOLVE}, {extra}{outer} FROM {name}1 {RESOLVE_JOINS.format(a=name + '1')}{joins} GROUP BY ALL)"""


STATUS_INNER = "1 AS dsp_req, sum(dsp_bid_price) FILTER (WHERE staus_code = '1') AS dsp_floor, " + ", ".join(f"count(*) FILTER (WHERE staus_code = '{code}') AS {n}" for n, code in X.DEMAND_STATUS.items())
STATUS_OUTER = ", ".join(f"sum({m}) AS {m}" for m in ["dsp_req", "dsp_floor", *X.DEMAND_STATUS])


def block_ctes(tagged: bool = False) -> dict[str, str]:
    parts = {
        "b_req": (in_types("view", "signup"), STATUS_INNER, STATUS_OUTER),
        "b_resp": (in_types("signup"), "1 AS dsp_win, max(dsp_bid) AS dsp_win_price", "sum(dsp_win) AS dsp_win, sum(dsp_win_price) AS dsp_win_price"),
        "b_imp": (in_types("purchase"), "1 AS imp, max(dsp_final_price) AS revenue, max(ssp_final_price) AS cost", "sum(imp) AS imp, sum(revenue) AS revenue, sum(cost) AS cost"),
        "b_clk": (in_types("click"), "1 AS clk", "sum(clk) AS clk"),
        "b_win": (in_types("error"), "1 AS ssp_win", "sum(ssp_win) AS ssp_win"),
    }
    return {name: block_sql(name, *p, tagged=tagged) for name, p in parts.items()}


BLOCKS, TAGGED_BLOCKS = block_ctes(), block_ctes(True)
XKEYS = ["hour", "dsp_id", "target_id", "media_id", "posid_id", "pkg_id", "country_id", "platform_id", "style_id", "mlevel_id"]
XCOUNTS = ["dsp_req", "dsp_fill_req", "dsp_req_timeout", "dsp_req_parse_error", "dsp_req_invalid_ad", "dsp_req_no_bid", "dsp_win", "imp", "clk", "ssp_win", "ssp_req"]
XSUMS = ["dsp_floor", "dsp_win_price", "revenue", "cost", "ssp_floor"]


@query("demand_requests_per_request", f"""WITH {EXCHANGE_CTE}, {EXCHANGE_DIMS_CTE}, {BLOCKS['b_req']}
SELECT {', '.join(XKEYS)}, {', '.join(f'CAST({m} AS BIGINT) AS {m}' for m in ['dsp_req', *X.DEMAND_STATUS])}, {r('dsp_floor')} AS dsp_floor FROM b_req""")
def _(t: Tables):
    return X.request_level_dedup_agg(exchange_logs(t)["dsp_req"], X.demand_request_measures(), exchange_dims(t))


@query("exchange_hourly", f"""WITH {EXCHANGE_CTE}, {EXCHANGE_DIMS_CTE}, {MEDIA_SQL}, {', '.join(BLOCKS.values())},
un AS (SELECT *, '-2' AS dsp_id, '-2' AS target_id FROM mh {' '.join(f'UNION ALL BY NAME SELECT * FROM {b}' for b in BLOCKS)})
SELECT {', '.join(XKEYS)}, hour - hour % 86400 AS time, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in XCOUNTS)}, {', '.join(f'{r(f"sum({m})")} AS {m}' for m in XSUMS)} FROM un GROUP BY {', '.join(XKEYS)}""")
def _(t: Tables):
    return X.exchange_hourly(exchange_logs(t), exchange_dims(t))


TKEYS = [*XKEYS, "tag_id", "adsize_id"]
TAG_DIMS = "d_tag AS (SELECT CAST(r_regionkey AS VARCHAR) AS name, CAST(r_regionkey + 60 AS VARCHAR) AS id FROM region), d_size AS (SELECT '640*' || r_regionkey AS name, CAST(r_regionkey + 9 AS VARCHAR) AS id FROM region)"


@query("exchange_hourly_tags_sizes", f"""WITH {EXCHANGE_CTE}, {EXCHANGE_DIMS_CTE}, {TAG_DIMS}, {MEDIA_SQL}, {', '.join(TAGGED_BLOCKS.values())},
un AS (SELECT *, '-2' AS dsp_id, '-2' AS target_id, '-1' AS tag_id, '-1' AS adsize_id FROM mh {' '.join(f'UNION ALL BY NAME SELECT * FROM {b}' for b in TAGGED_BLOCKS)})
SELECT {', '.join(TKEYS)}, hour - hour % 86400 AS time, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in XCOUNTS)}, {', '.join(f'{r(f"sum({m})")} AS {m}' for m in XSUMS)} FROM un GROUP BY {', '.join(TKEYS)}""")
def _(t: Tables):
    dims = exchange_dims(t)
    logs = exchange_logs(t)
    logs["media_resp"] = logs["media_resp"].withColumns({"width": F.lit("640"), "height": F.col("adsolt_id")})
    sizes = t.region.select(F.concat(F.lit("640*"), "r_regionkey").alias("name"), (F.col("r_regionkey") + 9).cast("string").alias("id"))
    tags = t.region.select(F.col("r_regionkey").cast("string").alias("name"), (F.col("r_regionkey") + 60).cast("string").alias("id"))
    return X.exchange_hourly(logs, dims, tags, sizes)


REQ_ATTRS = "max(app_id) AS media_id, max(adsolt_id) AS posid_id, max(pkg_name) AS pkg, max(country) AS country, max(os) AS platform, max(adsolt_type) AS style"
DEMAND2 = ", ".join(f"count(*) FILTER (WHERE staus_code = '{code}') AS {n}" for n, code in X.DEMAND_STATUS.items())
FUNNEL_SQL = f"""q AS (SELECT request_id, {REQ_ATTRS} FROM x GROUP BY 1), d AS (SELECT request_id, dsp_id, 1 AS dsp_req, sum(dsp_bid_price) AS dsp_floor, {DEMAND2} FROM x WHERE {in_types('view', 'signup')} GROUP BY 1, 2),
w AS (SELECT request_id, dsp_id, 1 AS dsp_win, max(dsp_bid) AS dsp_win_price FROM x WHERE {in_types('signup')} GROUP BY 1, 2),
f AS (SELECT q.*, d.* EXCLUDE (request_id), w.dsp_win, w.dsp_win_price FROM q LEFT JOIN d ON q.request_id = d.request_id LEFT JOIN w ON d.request_id = w.request_id AND d.dsp_id = w.dsp_id)"""


@query("request_funnel", f"WITH {EXCHANGE_CTE}, {FUNNEL_SQL} SELECT request_id, dsp_id, media_id, posid_id, pkg, country, platform, style, CAST(dsp_req AS BIGINT) AS dsp_req, {r('dsp_floor')} AS dsp_floor, {', '.join(X.DEMAND_STATUS)}, CAST(dsp_win AS BIGINT) AS dsp_win, {r('dsp_win_price')} AS dsp_win_price FROM f")
def _(t: Tables):
    logs = exchange_logs(t)
    return X.request_funnel(logs["media_req"], logs["dsp_req"], logs["media_resp"])


R2 = ["dsp_req", "dsp_fill_req", "dsp_req_timeout", "dsp_req_parse_error", "dsp_req_invalid_ad", "dsp_req_no_bid", "dsp_win", "imp", "clk", "ssp_win", "ssp_req"]
R2KEYS = ["dsp_id", "media_id", "posid_id", "pkg_id", "country_id", "platform_id", "style_id", "mlevel_id"]


@query("request_funnel_report", f"""WITH {EXCHANGE_CTE}, {EXCHANGE_DIMS_CTE}, {FUNNEL_SQL},
u AS (SELECT * FROM f UNION ALL BY NAME SELECT request_id, dsp_id, 1 AS imp, dsp_final_price AS revenue, ssp_final_price AS cost FROM x WHERE {in_types('purchase')}
  UNION ALL BY NAME SELECT request_id, dsp_id, 1 AS clk FROM x WHERE {in_types('click')} UNION ALL BY NAME SELECT request_id, dsp_id, 1 AS ssp_win FROM x WHERE {in_types('error')}),
m0 AS (SELECT request_id, dsp_id, max(media_id) AS media0, max(posid_id) AS pos0, max(pkg) AS pkg, max(country) AS country, max(platform) AS platform, max(style) AS style, max(dsp_req) AS dsp_req,
  sum(dsp_floor) AS dsp_floor, {', '.join(f'sum({n}) AS {n}' for n in X.DEMAND_STATUS)}, max(dsp_win) AS dsp_win, sum(dsp_win_price) AS dsp_win_price, max(imp) AS imp, max(revenue) AS revenue, max(cost) AS cost, max(clk) AS clk, max(ssp_win) AS ssp_win FROM u GROUP BY 1, 2),
m1 AS (SELECT * EXCLUDE (dsp_id), {blank('dsp_id')} AS dsp_id, {blank('media0')} AS media_id, {blank('pos0')} AS posid_id FROM m0),
a AS (SELECT m1.dsp_id, m1.media_id, posid_id, {RESOLVE}, {', '.join(f'sum({c}) AS {c}' for c in [*R2[:-1], 'dsp_floor', 'dsp_win_price', 'revenue', 'cost'])} FROM m1 {RESOLVE_JOINS.format(a='m1')} GROUP BY ALL),
o0 AS (SELECT request_id, max({blank('app_id')}) AS media_id, max({blank('adsolt_id')}) AS posid_id, max(pkg_name) AS pkg, max(country) AS country, max(os) AS platform, max(adsolt_type) AS style, sum(req_floor_price) AS ssp_floor FROM x GROUP BY 1),
o AS (SELECT '-2' AS dsp_id, o0.media_id, posid_id, {RESOLVE}, count(*) AS ssp_req, sum(ssp_floor) AS ssp_floor FROM o0 {RESOLVE_JOINS.format(a='o0')} GROUP BY ALL),
z AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM o)
SELECT {', '.join(R2KEYS)}, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in R2)}, {', '.join(f'{r(c)} AS {c}' for c in XSUMS)} FROM z""")
def _(t: Tables):
    return X.request_funnel_report(exchange_logs(t), exchange_dims(t))


# Supply-side logs: every event is a request; other logs are picked by event type and k.
SLOT_LOGS = {
    "imp": "event_type = 'view'", "clk": "event_type = 'click'", "media_resp": "event_type = 'signup'", "media_req_filter": "event_type = 'error'",
    "dsp_resp": "event_type = 'purchase'", "dp": "event_type = 'click' AND k % 4 = 0", "send_dsp_res": "event_type = 'signup' AND k % 3 = 0", "win": "event_type = 'purchase' AND k % 2 = 0",
    **{m: f"event_type = 'error' AND k % 8 = {i}" for i, m in enumerate(S.EVENT_MEASURES)},
}
SLOT_CTE = DEVICE_CTE + """, sl AS (SELECT *, 'dsp' || (k % 3) AS dsp_id, CASE WHEN k % 9 = 0 THEN 'bad' ELSE CAST(10000 + k % 6 - 2 AS VARCHAR) END AS slot_id,
  CASE WHEN k % 5 = 0 THEN '1' ELSE '0' END AS is_default, CASE WHEN k % 4 = 1 THEN '1' ELSE '0' END AS deeplink, CASE WHEN user_id % 3 = 0 THEN '1' ELSE '0' END AS is_sdk,
  CASE WHEN k % 7 = 0 THEN '1' ELSE '0' END AS status_code FROM dv)"""


def slot_log(t: Tables):
    u, k = F.col("user_id"), F.col("k")
    return device_log(t).withColumns({
        "dsp_id": F.concat(F.lit("dsp"), k % 3), "adsolt_id": F.when(k % 9 == 0, "bad").otherwise((k % 6 + 9998).cast("string")),
        "is_default": F.when(k % 5 == 0, "1").otherwise("0"), "deeplink": F.when(k % 4 == 1, "1").otherwise("0"), "is_sdk": F.when(u % 3 == 0, "1").otherwise("0"),
        "status_code": F.when(k % 7 == 0, "1").otherwise("0"), "dsp_price": F.when(k % 6 == 0, "").otherwise(F.col("value").cast("string")),
        "real_price": F.col("value"), "floor_price": F.when(k % 4 > 0, F.col("value") * 0.5),
    })


def slot_logs(t: Tables):
    log = slot_log(t)
    return {"media_req": log, **{n: log.where(cond) for n, cond in SLOT_LOGS.items()}}


SOURCE = "CASE WHEN is_default = '1' THEN '-1' ELSE dsp_id END"
UV_ID = "coalesce(imei, '') || coalesce(idfa, '')"
SLOT_UNION = " UNION ALL BY NAME ".join([
    f"SELECT app_id, {SOURCE} AS dsp_id, slot_id, {cnt('is_default = ' + chr(39) + '1' + chr(39))} AS def_show, {cnt('is_default = ' + chr(39) + '0' + chr(39))} AS \"show\" FROM sl WHERE {SLOT_LOGS['imp']} GROUP BY ALL",
    f"SELECT app_id, {SOURCE} AS dsp_id, slot_id, count(*) FILTER (WHERE is_default = '1') AS def_click, count(*) FILTER (WHERE is_default = '0') AS click, count(*) FILTER (WHERE deeplink = '1') AS clkdpnum FROM sl WHERE {SLOT_LOGS['clk']} GROUP BY ALL",
    f"SELECT app_id, '-1' AS dsp_id, slot_id, count(DISTINCT CASE WHEN is_sdk = '0' THEN {UV_ID} END) AS valid_uv, count(*) FILTER (WHERE is_sdk = '0') AS valid_pv, count(DISTINCT CASE WHEN is_sdk = '1' THEN {UV_ID} END) AS sdk_uv, count(*) FILTER (WHERE is_sdk = '1') AS sdk_pv FROM sl GROUP BY ALL",
    f"SELECT app_id, '-1' AS dsp_id, slot_id, count(*) AS filter_req FROM sl WHERE {SLOT_LOGS['media_req_filter']} GROUP BY ALL",
    f"SELECT app_id, dsp_id, slot_id, count(*) AS adv_back FROM sl WHERE {SLOT_LOGS['media_resp']} AND status_code = '0' GROUP BY ALL",
    f"SELECT app_id, dsp_id, slot_id, count(*) AS channel_uv, count(*) AS channel_pv FROM sl WHERE {SLOT_LOGS['dsp_resp']} GROUP BY ALL",
    f"SELECT app_id, dsp_id, slot_id, count(*) AS dpnum FROM sl WHERE {SLOT_LOGS['dp']} GROUP BY ALL",
    f"SELECT app_id, dsp_id, slot_id, count(*) AS send_dsp_res FROM sl WHERE {SLOT_LOGS['send_dsp_res']} GROUP BY ALL",
    *[f"SELECT app_id, {SOURCE} AS dsp_id, slot_id, count(*) AS {m} FROM sl WHERE {SLOT_LOGS[m]} GROUP BY ALL" for m in S.EVENT_MEASURES],
    f"SELECT app_id, dsp_id, slot_id, sum(CASE WHEN k % 6 = 0 THEN NULL ELSE value END) AS rjcost FROM sl WHERE {SLOT_LOGS['win']} GROUP BY ALL",
])
SLOT_COUNTS = [m for m in S.FUNNEL_MEASURES if m != "rjcost"]
SLOT_MERGED = f"""su AS ({SLOT_UNION}), sm AS (SELECT app_id, dsp_id, slot_id AS adsolt_id, {', '.join(f'CAST(coalesce(sum("{m}"), 0) AS BIGINT) AS "{m}"' for m in SLOT_COUNTS)}, coalesce(sum(rjcost), 0) AS rjcost
FROM su WHERE regexp_matches(slot_id, '^[0-9]+$') GROUP BY ALL)"""


@query("slot_hour_funnel", f"WITH {SLOT_CTE}, {SLOT_MERGED} SELECT * REPLACE ({r('rjcost')} AS rjcost) FROM sm")
def _(t: Tables):
    return S.slot_hour_funnel(slot_logs(t))


@query("slot_hour_publish", f"""WITH {SLOT_CTE}, {SLOT_MERGED}
SELECT app_id AS media_id, dsp_id AS channel_id, adsolt_id AS adslocation_id, CAST(g.r_regionkey + 10 AS BIGINT) AS dev_id, n.n_name AS joint_id, coalesce(CAST(g2.r_regionkey + 20 AS VARCHAR), '-1') AS am_id,
  CAST(coalesce(n.n_regionkey, 0) AS BIGINT) AS deduct, {', '.join(chr(34) + m + chr(34) for m in SLOT_COUNTS)}, {r('rjcost')} AS rjcost
FROM sm LEFT JOIN region g ON app_id = CAST(g.r_regionkey AS VARCHAR) LEFT JOIN nation n ON adsolt_id = CAST(9998 + n.n_nationkey * 2 AS VARCHAR) LEFT JOIN (SELECT * FROM region WHERE r_regionkey % 3 <> 2) g2 ON app_id = CAST(g2.r_regionkey AS VARCHAR)""")
def _(t: Tables):
    media = t.region.select(F.col("r_regionkey").cast("string").alias("id"), (F.col("r_regionkey") + 10).alias("user_id"))
    slots = t.nation.select((F.col("n_nationkey") * 2 + 9998).cast("string").alias("id"), F.col("n_name").alias("joint_id"), F.col("n_regionkey").alias("deduct"))
    managers = t.region.where("r_regionkey % 3 <> 2").select(F.col("r_regionkey").cast("string").alias("id"), (F.col("r_regionkey") + 20).cast("string").alias("user_id"))
    return S.slot_hour_publish(S.slot_hour_funnel(slot_logs(t)), media, slots, managers)


@query("daily_actives", f"""WITH {SLOT_CTE} SELECT app_id, slot_id AS adsolt_id, count(DISTINCT CASE WHEN is_sdk = '0' THEN {UV_ID} END) AS valid_uv, count(*) FILTER (WHERE is_sdk = '0') AS valid_pv,
count(DISTINCT CASE WHEN is_sdk = '1' AND os = '1' THEN coalesce(android_id, '') END) AS android_sdk_uv, count(DISTINCT CASE WHEN is_sdk = '1' AND os = '2' THEN {UV_ID} END) AS ios_sdk_uv,
count(*) FILTER (WHERE is_sdk = '1' AND os = '1') AS android_sdk_pv, count(*) FILTER (WHERE is_sdk = '1' AND os = '2') AS ios_sdk_pv FROM sl GROUP BY ALL""")
def _(t: Tables):
    return S.daily_actives(slot_log(t))


BRAND_SQL = "CASE k % 5 WHEN 0 THEN 'huawei' WHEN 1 THEN 'apple' WHEN 2 THEN 'redmi' ELSE 'other' END"


@query("dimension_report", f"""WITH {SLOT_CTE}, rp AS (SELECT *, {BRAND_SQL} AS brand FROM sl),
un AS (SELECT app_id, slot_id, NULL AS dsp_id, os, carrier, network, brand, city_id, 1 AS req_cnt FROM rp UNION ALL BY NAME SELECT app_id, slot_id, dsp_id, os, carrier, network, brand, city_id, 1 AS resp_cnt FROM rp WHERE {SLOT_LOGS['media_resp']} AND status_code = '0'
  UNION ALL BY NAME SELECT app_id, slot_id, dsp_id, os, carrier, network, brand, city_id, 1 AS imp_cnt, value AS cpm_sum, 1 AS cpm_cnt, CASE WHEN k % 4 > 0 THEN value * 0.5 END AS floor_price_sum, CASE WHEN k % 4 > 0 THEN 1 END AS floor_price_cnt FROM rp WHERE {SLOT_LOGS['imp']}
  UNION ALL BY NAME SELECT app_id, slot_id, dsp_id, os, carrier, network, brand, city_id, 1 AS clk_cnt FROM rp WHERE {SLOT_LOGS['clk']})
SELECT app_id, slot_id AS adsolt_id, dsp_id, g.r_name AS os, NULL AS carrier, CAST(g2.r_regionkey AS BIGINT) AS network, CASE WHEN brand IN ('huawei', 'apple') THEN brand || '-id' END AS producer, city_id,
  {', '.join(f'CAST(coalesce(sum({m}), 0) AS BIGINT) AS {m}' for m in ('req_cnt', 'resp_cnt', 'imp_cnt', 'clk_cnt', 'cpm_cnt', 'floor_price_cnt'))}, {r('coalesce(sum(cpm_sum), 0)')} AS cpm_sum, {r('coalesce(sum(floor_price_sum), 0)')} AS floor_price_sum
FROM un LEFT JOIN region g ON os = CAST(g.r_regionkey AS VARCHAR) LEFT JOIN region g2 ON network = CAST(g2.r_regionkey AS VARCHAR)
GROUP BY app_id, slot_id, dsp_id, un.os, un.carrier, un.network, brand, city_id, g.r_name, g2.r_regionkey""")
def _(t: Tables):
    key = F.col("r_regionkey").cast("string").alias("jsonkey")
    dims = {
        "os": t.region.select(key, F.col("r_name").alias("id")), "carrier": t.region.select(key, F.col("r_name").alias("id")),
        "network": t.region.select(key, F.col("r_regionkey").alias("id")),
        "brand": t.region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "huawei").otherwise("apple").alias("jsonkey"), F.when(F.col("r_regionkey") == 0, "huawei-id").otherwise("apple-id").alias("id")),
    }
    return S.dimension_report(slot_logs(t), dims)


@query("slot_hour", f"""WITH {SLOT_CTE}, un AS (SELECT app_id, slot_id, {SOURCE} AS src, CASE WHEN is_default = '0' THEN 1 END AS "show" FROM sl WHERE {SLOT_LOGS['imp']}
  UNION ALL BY NAME SELECT app_id, slot_id, {SOURCE} AS src, CASE WHEN is_default = '0' THEN 1 END AS click FROM sl WHERE {SLOT_LOGS['clk']} UNION ALL BY NAME SELECT app_id, slot_id, '-1' AS src, CASE WHEN is_sdk = '0' THEN 1 END AS valid_pv FROM sl
  UNION ALL BY NAME SELECT app_id, slot_id, '-1' AS src, 1 AS filter_req FROM sl WHERE {SLOT_LOGS['media_req_filter']} UNION ALL BY NAME SELECT app_id, slot_id, dsp_id AS src, 1 AS adv_back FROM sl WHERE {SLOT_LOGS['media_resp']} AND status_code = '0'
  UNION ALL BY NAME SELECT app_id, slot_id, dsp_id AS src, 1 AS channel_uv FROM sl WHERE {SLOT_LOGS['dsp_resp']})
SELECT app_id AS media_id, slot_id AS adslocation_id, src AS channel_id, r_name AS dev_id, {', '.join(f'CAST(coalesce(sum("{m}"), 0) AS BIGINT) AS "{m}"' for m in ('show', 'click', 'valid_pv', 'filter_req', 'adv_back', 'channel_uv'))}
FROM un LEFT JOIN region ON app_id = CAST(r_regionkey AS VARCHAR) WHERE TRY_CAST(slot_id AS BIGINT) >= 10000 GROUP BY ALL""")
def _(t: Tables):
    media = t.region.select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("dev_id"))
    return P.slot_hour(slot_logs(t), media)


# Plan logs: each event names one to three plans.
PLANS_CTE = DEVICE_CTE + """, pl AS (SELECT *, CASE k % 3 WHEN 0 THEN [user_id % 6] WHEN 1 THEN [user_id % 6, 7] ELSE [user_id % 6, 8, 9] END AS plans, CASE WHEN k % 10 = 0 THEN NULL ELSE event_id END AS request_id,
  'g' || (user_id % 5) AS geo, 'n' || (k % 2) AS grp FROM dv), px AS (SELECT *, CAST(unnest(plans) AS VARCHAR) AS plan_id FROM pl)"""


def plan_log(t: Tables):
    u, k = (F.col("user_id") % 6).cast("string"), F.col("k")
    return device_log(t).withColumns({
        "plan_id": F.when(k % 3 == 0, u).when(k % 3 == 1, F.concat(u, F.lit(",7"))).otherwise(F.concat(u, F.lit(",8,9"))),
        "request_id": F.when(k % 10 > 0, F.col("event_id")), "geo": F.concat(F.lit("g"), F.col("user_id") % 5), "adsolt_group_name": F.concat(F.lit("n"), k % 2),
        "adslot_id": F.col("adsolt_id"), "real_bid_price": F.col("value"), "real_pay_price": F.col("value") * 0.5, "pay_price": F.col("value") * 0.5,
    })


def plan_logs(t: Tables):
    log = plan_log(t)
    kinds = {"req": "view", "bid": "signup", "imp": "error", "clk": "click", "conv": "purchase"}
    return {n: log.where(F.col("event_type") == kind) for n, kind in kinds.items()}


def fc(kind: str, extra: str = "") -> str:
    return f"count(request_id) FILTER (WHERE event_type = '{kind}'{extra})"


PLAN_SQL = f"""pf AS (SELECT plan_id, CASE WHEN event_type = 'view' THEN '-1' ELSE creative_id END AS creative_id, adsolt_id AS adslot_id, geo, grp AS adsolt_group_name, CAST(79 AS BIGINT) AS channel_id,
  {fc('view')} AS req, {fc('signup')} AS bid, {fc('error')} AS imp, {fc('click')} AS clk, {fc('purchase')} AS ocpx, coalesce(sum(value) FILTER (WHERE event_type = 'signup'), 0) AS bid_real_cost,
  coalesce(sum(value * 0.5) FILTER (WHERE event_type = 'error'), 0) AS imp_real_cost, {', '.join(f"count(*) FILTER (WHERE event_type = 'purchase' AND ocpx_tag = '{a}') AS {a}" for a in P.TAGS)} FROM px GROUP BY ALL)"""


@query("split_plan_funnel", f"WITH {PLANS_CTE}, {PLAN_SQL} SELECT * REPLACE ({r('bid_real_cost')} AS bid_real_cost, {r('imp_real_cost')} AS imp_real_cost) FROM pf")
def _(t: Tables):
    return P.split_plan_funnel(plan_logs(t))


@query("plan_publish", f"""WITH {PLANS_CTE}, {PLAN_SQL} SELECT pf.* REPLACE ({r('bid_real_cost')} AS bid_real_cost, {r('imp_real_cost')} AS imp_real_cost), g.r_name AS admaster_id, coalesce('grp' || n.n_nationkey, '-1') AS creative_group_id,
 s.s_name AS dev_id, CAST(s.s_nationkey AS BIGINT) AS media_id, s.s_name AS joint_id, coalesce(g.r_name, '-1') AS agent_id, n2.n_name AS geo_name
FROM pf LEFT JOIN region g ON plan_id = CAST(g.r_regionkey AS VARCHAR) LEFT JOIN nation n ON pf.creative_id = 'cr' || n.n_nationkey AND n.n_nationkey % 5 <> 4 LEFT JOIN supplier s ON adslot_id = CAST(s.s_suppkey AS VARCHAR) LEFT JOIN nation n2 ON geo = 'g' || n2.n_nationkey AND n2.n_nationkey <> 2""")
def _(t: Tables):
    key = F.col("r_regionkey").cast("string").alias("id")
    return P.plan_publish(
        P.split_plan_funnel(plan_logs(t)), t.region.select(key, F.col("r_name").alias("aduser_id")),
        t.nation.where("n_nationkey % 5 <> 4").select(F.concat(F.lit("cr"), "n_nationkey").alias("id"), F.concat(F.lit("grp"), "n_nationkey").alias("creative_group_id")),
        t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("user_id"), F.col("s_nationkey").alias("media_id"), F.col("s_name").alias("joint_id")),
        t.region.select(key, F.col("r_name").alias("user_oem_id")),
        t.nation.where("n_nationkey <> 2").select(F.concat(F.lit("g"), "n_nationkey").alias("id"), F.col("n_name").alias("name")),
    )


@query("split_plan_cost", f"""WITH {PLANS_CTE} SELECT plan_id, CASE WHEN event_type = 'view' THEN '-1' ELSE creative_id END AS creative_id, adsolt_id AS adslot_id, CAST(79 AS BIGINT) AS channel_id, {fc('view')} AS req, {fc('signup')} AS bid,
 {fc('error')} AS "show", {fc('click')} AS click, {r("coalesce(sum(value * 0.5) FILTER (WHERE event_type IN ('error', 'click')), 0)")} AS cost FROM px WHERE event_type <> 'purchase' GROUP BY ALL""")
def _(t: Tables):
    return P.split_plan_cost(plan_logs(t))


@query("type_words", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word")
def _(t: Tables):
    from ..operators.funnel import split_list_rows

    return split_list_rows(t.part, "p_name", "word", " ").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("affiliate_summary", f"""WITH {EVENTS_CTE} SELECT CAST(user_id % 5 AS VARCHAR) AS channel_id, CAST(k % 4 AS VARCHAR) AS adv_id, CAST(k % 2 AS VARCHAR) AS aduser_id, CAST(user_id % 3 AS VARCHAR) AS subchannel,
 {cnt("event_type = 'click'")} AS click_count, {cnt("event_type = 'purchase'")} AS activate_count, {cnt("event_type = 'purchase' AND k % 6 = 0")} AS shave_activates FROM ev WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def _(t: Tables):
    u, k = F.col("user_id"), F.col("k")
    log = events(t).withColumns({
        "media_id": (u % 5).cast("string"), "offer_id": (k % 4).cast("string"), "source_id": (k % 2).cast("string"), "sub_channel": (u % 3).cast("string"),
        "referrer": F.when(k % 6 == 0, "true").otherwise("false"),
    })
    return P.affiliate_summary(log.where("event_type = 'click'"), log.where("event_type = 'purchase'"))


@query("creative_summary", "SELECT p_brand AS \"unique\", CAST(max(p_size) AS VARCHAR) AS adslocation_type_id, max(p_name) AS creative_json, max(p_type) AS channel_url, count(*) AS \"count\" FROM (SELECT * FROM part WHERE p_size >= 10) GROUP BY p_brand")
def _(t: Tables):
    # Two-digit sizes, so that the largest text is the largest number.
    log = t.part.select(
        F.when(F.col("p_size") >= 10, F.col("p_size").cast("string")).otherwise("none").alias("creative_type"), F.col("p_name").alias("creative_json"), F.col("p_type").alias("channel_url"),
        F.col("p_brand").alias("unique"), F.lit("1").alias("dsp_id"), F.lit("1").alias("res_type"), F.lit("1").alias("media_id"),
    )
    return S.creative_summary(log).drop("channel_id", "res_type", "media_id")


@query("creative_rows", "SELECT CAST(p_size AS VARCHAR) AS adslocation_type_id, p_name AS creative_json, p_type AS channel_url, p_brand AS channel_id FROM part WHERE p_size % 2 = 0")
def _(t: Tables):
    log = t.part.select(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("x").alias("creative_type"), F.col("p_name").alias("creative_json"), F.col("p_type").alias("channel_url"), F.col("p_brand").alias("dsp_id"))
    return S.creative_passthrough(log)


@query("creative_image_counts", """SELECT img_url, md5(img_url) AS img_url_md5, channel_id, adslocation_id, count(*) AS "count" FROM (SELECT CASE WHEN p_size % 2 = 0 THEN 'http://i/' || p_brand END AS img_url, p_type AS channel_id, p_name AS adslocation_id FROM part) GROUP BY ALL""")
def _(t: Tables):
    js = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('{"img":[{"url":"http://i/'), "p_brand", F.lit('"}]}'))).otherwise(F.lit("{}"))
    return S.creative_image_counts(t.part.select(js.alias("creative_json"), F.lit("3").alias("creative_type"), F.col("p_type").alias("dsp_id"), F.col("p_name").alias("adsolt_id")))


@query("media_package_counts", "SELECT o_orderpriority AS media_id, o_orderstatus AS pkg, count(*) AS \"count\" FROM orders GROUP BY ALL")
def _(t: Tables):
    return S.media_package_counts(t.orders, "o_orderpriority", "o_orderstatus")


@query("daily_spend", f"WITH {EVENTS_CTE} SELECT day, event_type, count(*) AS cnt, {r('sum(CASE WHEN k % 5 = 0 THEN 0 ELSE value END) / 1000')} AS spend FROM ev GROUP BY ALL")
def _(t: Tables):
    priced = events(t).withColumn("price", F.when(F.col("k") % 5 == 0, "n/a").otherwise(F.col("value").cast("string")))
    return S.daily_spend(priced, ["day", "event_type"], "price")


@query("owner_daily_spend", f"WITH {EVENTS_CTE} SELECT day, n_name AS user_id, count(*) AS cnt, {r('sum(value) / 1000')} AS spend FROM ev JOIN nation ON user_id % 40 = n_nationkey GROUP BY ALL")
def _(t: Tables):
    owners = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("user_id"))
    log = events(t).select("day", (F.col("user_id") % 40).alias("app"), "value")
    return S.owner_daily_spend(log, owners, "day", "app", "value")


@query("hourly_price", f"WITH {EVENTS_CTE} SELECT strftime(date_trunc('hour', ts + INTERVAL 8 HOUR), '%Y-%m-%d %H:%M:%S') AS hour, event_type, {r('sum(CASE WHEN k % 4 = 0 THEN 0 ELSE value END)')} AS price FROM ev GROUP BY ALL")
def _(t: Tables):
    log = events(t).select("sec", "event_type", F.when(F.col("k") % 4 == 0, "").otherwise(F.col("value").cast("string")).alias("p"))
    return S.hourly_price(log, "sec", ["event_type"], "p")


@query("daily_uv", f"WITH {EVENTS_CTE} SELECT day, event_type, count(DISTINCT user_id) AS uv FROM ev GROUP BY ALL")
def _(t: Tables):
    return daily_uv(events(t), ["day", "event_type"], F.col("user_id"))


@query("union_of_sources", "SELECT s_nationkey AS nation, 'supplier' AS source FROM supplier UNION ALL SELECT c_nationkey, 'customer' FROM customer".replace("SELECT s_nationkey", "SELECT CAST(s_nationkey AS BIGINT)"))
def _(t: Tables):
    return union_all(
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source")), t.customer.select(F.lit("customer").alias("source"), F.col("c_nationkey").alias("nation"))
    )


@query("intersect_ids", "SELECT md5(CAST(o_custkey AS VARCHAR)) AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT md5(CAST(user_id AS VARCHAR)) FROM events")
def _(t: Tables):
    return intersect_ids(
        t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string")), t.events.select(F.col("user_id").cast("string")), F.md5
    )
