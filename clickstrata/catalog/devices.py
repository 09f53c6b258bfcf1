"""Behaviour features, conversion links, device profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import devices as D
from ..functions.identity import canonical_device_id, device_id_type
from ..operators import features as V
from ..operators import partials as P
from ..operators.dims import left_join_blocks
from ..sources.scans import read_date_range, read_partition
from .registry import Tables, query, r
from .stand_ins import DEVICE_CTE, DEVICE_ID_SQL, EVENTS_CTE, device_log, events

DAY, DAY_START = "2024-01-10", 1704844800
KEYS = ["app_id", "id", "adsolt_id"]
MODES = ["producer", "carrier", "network", "city_id"]


def with_id(t: Tables):
    log = device_log(t)
    return log.withColumns({"id": canonical_device_id("os", "imei", "idfa", "oaid"), "id_type": device_id_type("os", "imei")})


def logs(df):
    return df.where("event_type IN ('view', 'signup', 'error')"), df.where("event_type = 'purchase'"), df.where("event_type = 'click'")


IDS_CTE = DEVICE_CTE + f", di AS (SELECT *, {DEVICE_ID_SQL} AS id FROM dv)"


def mode_sql(src: str, keys: str, col: str, out: str) -> str:
    on = " AND ".join(f"m.{k} IS NOT DISTINCT FROM b.{k}" for k in keys.split(", "))
    return f"coalesce((SELECT {col} FROM (SELECT {keys}, {col}, count(*) AS c FROM {src} WHERE {col} <> '' GROUP BY ALL) m WHERE {on} ORDER BY c DESC, {col} LIMIT 1), '') AS {out}"


def mode_cte(name: str, src: str, keys: str, col: str, out: str) -> str:
    """Most frequent non-blank value per key as a CTE."""
    return f"""{name} AS (SELECT {keys}, {col} AS {out} FROM (SELECT {keys}, {col}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {col}) AS rn FROM {src} WHERE {col} <> '' GROUP BY {keys}, {col}) WHERE rn = 1)"""


def same(a: str, b: str, keys: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", "))


@query("most_frequent_values", f"""WITH {DEVICE_CTE}, {mode_cte('m1', 'dv', 'user_id', 'producer', 'producer')}, {mode_cte('m2', 'dv', 'user_id', 'creative_id', 'creative_id')}
SELECT u.user_id, coalesce(producer, '') AS producer, coalesce(creative_id, '') AS creative_id FROM (SELECT DISTINCT user_id FROM dv) u LEFT JOIN m1 ON u.user_id = m1.user_id LEFT JOIN m2 ON u.user_id = m2.user_id""")
def _(t: Tables):
    return V.modes(device_log(t), ["user_id"], ["producer", "creative_id"])


@query("most_frequent_value_aggregate", f"WITH {DEVICE_CTE}, {mode_cte('m1', 'dv', 'user_id', 'producer', 'producer')} SELECT u.user_id, coalesce(producer, '') AS producer FROM (SELECT DISTINCT user_id FROM dv) u LEFT JOIN m1 ON u.user_id = m1.user_id")
def _(t: Tables):
    return V.modes(device_log(t), ["user_id"], ["producer"])


def timing_sql(src: str, keys: str, start: str) -> str:
    """Click timing from sorted times and their differences."""
    return f"""tg AS (SELECT *, sec - lag(sec) OVER (PARTITION BY {keys} ORDER BY sec) AS gap FROM {src}),
tm AS (SELECT {keys}, min(sec) - {start} AS clk_first_seconds, max(sec) - {start} AS clk_last_seconds, CAST(coalesce(min(gap), -1) AS BIGINT) AS clk_min_interval, CAST(coalesce(max(gap), -1) AS BIGINT) AS clk_max_interval,
  CASE WHEN count(*) = 1 THEN CAST(-1 AS BIGINT) ELSE CAST((max(sec) - min(sec)) // (count(*) - 1) AS BIGINT) END AS clk_avg_interval FROM tg GROUP BY {keys})"""


@query("click_timing", f"WITH {EVENTS_CTE}, ck AS (SELECT * FROM ev WHERE event_type = 'click'), {timing_sql('ck', 'user_id', '1704067200')} SELECT * FROM tm")
def _(t: Tables):
    return V.click_timing(events(t).where("event_type = 'click'"), ["user_id"], "sec", 1704067200, "clk_")


def features_sql(req: str, imp: str, clk: str, keys: str, timing: bool, modes: list[str], apps: bool = False, maxima: list[str] = []) -> str:
    """CTE ``ft``: request block LEFT JOIN impression block LEFT JOIN click block."""
    blocks = []
    mode_ctes = [mode_cte(f"mo_{c}", "rq", keys, c, c) for c in modes]
    mode_joins = " ".join(f"LEFT JOIN mo_{c} ON {same('q0', 'mo_' + c, keys)}" for c in modes)
    mode_cols = "".join(f", coalesce(mo_{c}.{c}, '') AS {c}" for c in modes)
    most = "".join(f", max({c}) AS {c}" for c in maxima)
    app = ", count(DISTINCT app_id) AS {p}_app_count" if apps else ""
    for p, src in (("imp", "ip"), ("clk", "ck")):
        price = f", avg(value) AS {p}_avg_real_price, max(value) AS {p}_max_real_price, min(value) AS {p}_min_real_price" if p == "imp" else ""
        blocks += [
            mode_cte(f"mc_{p}", src, keys, "creative_id", "top"),
            f"{p}0 AS (SELECT {keys}, count(*) AS {p}_cnt, count(DISTINCT creative_id) AS {p}_creative_count{price}{app.format(p=p)} FROM {src} GROUP BY {keys})",
            f"{p}b AS (SELECT {p}0.*, coalesce(top, '') AS {p}_max_count_creative, {p}_cnt / sum({p}_cnt) OVER (PARTITION BY {p}0.id) AS {p}_rate FROM {p}0 LEFT JOIN mc_{p} ON {same(p + '0', 'mc_' + p, keys)})",
        ]
    tm = [timing_sql("ck", keys, str(DAY_START))] if timing else []
    clk_cols = "clkb.* EXCLUDE (" + keys + ")"
    tm_cols = ", tm.* EXCLUDE (" + keys + ")" if timing else ""
    eq = " AND ".join("{a}." + k + " = {b}." + k for k in keys.split(", "))
    tm_join = f"LEFT JOIN tm ON {eq.format(a='q1', b='tm')}" if timing else ""
    return f"""rq AS (SELECT * FROM {req}), ip AS (SELECT * FROM {imp}), ck AS (SELECT * FROM {clk}), {', '.join([*mode_ctes, *blocks, *tm])},
q0 AS (SELECT {keys}, count(*) AS req_count, avg(value) AS req_avg_real_price, max(value) AS req_max_real_price, min(value) AS req_min_real_price{app.format(p='req')}{most} FROM rq GROUP BY {keys}),
q1 AS (SELECT q0.*, req_count / sum(req_count) OVER (PARTITION BY q0.id) AS req_rate{mode_cols} FROM q0 {mode_joins}),
ft AS (SELECT q1.*, impb.* EXCLUDE ({keys}), {clk_cols}{tm_cols} FROM q1 LEFT JOIN impb ON {eq.format(a='q1', b='impb')} LEFT JOIN clkb ON {eq.format(a='q1', b='clkb')} {tm_join})"""


RATES = ["req_avg_real_price", "req_max_real_price", "req_min_real_price", "req_rate", "imp_avg_real_price", "imp_max_real_price", "imp_min_real_price", "imp_rate", "clk_rate"]


def rounded(cols=RATES) -> str:
    return "* REPLACE (" + ", ".join(f"{r(c)} AS {c}" for c in cols) + ")"


KINDS = {"req": "event_type IN ('view', 'signup', 'error')", "imp": "event_type = 'purchase'", "clk": "event_type = 'click'"}


def picked(where: str, src: str = "di") -> list[str]:
    return [f"(SELECT * FROM {src} WHERE {cond} AND {where})" for cond in KINDS.values()]


@query("behaviour_by_slot_day", f"WITH {IDS_CTE}, {features_sql(*picked(f'day = {chr(39)}{DAY}{chr(39)}'), 'app_id, id, adsolt_id', True, MODES)} SELECT {rounded()} FROM ft")
def _(t: Tables):
    log = read_partition(with_id(t), DAY, date_col="day")
    spec = V.BehaviourSpec(req_price="value", price="value", time="sec")
    return V.behaviour_features(*logs(log), KEYS, spec, DAY_START)


@query("behaviour_by_id_day", f"WITH {IDS_CTE}, {features_sql(*picked(f'day = {chr(39)}{DAY}{chr(39)}'), 'id', True, MODES, apps=True)} SELECT {rounded()} FROM ft")
def _(t: Tables):
    log = read_partition(with_id(t), DAY, date_col="day")
    return V.behaviour_features(*logs(log), ["id"], V.BehaviourSpec(req_price="value", price="value", time="sec", apps="app_id"), DAY_START)


THREE_DAYS = "day BETWEEN '2024-01-08' AND '2024-01-10'"


@query("behaviour_three_days", f"WITH {IDS_CTE}, {features_sql(*picked(THREE_DAYS), 'app_id, id, adsolt_id', False, [])} SELECT {rounded()} FROM ft")
def _(t: Tables):
    log = read_date_range(with_id(t), DAY, 3, date_col="day")
    return V.behaviour_features(*logs(log), KEYS, V.BehaviourSpec(req_price="value", price="value", time="sec", mode_cols=()))


def conversions(t: Tables):
    log = with_id(t)
    known = log.where("event_type = 'view'").select(*KEYS)
    conv = log.where("event_type = 'purchase'").select(*KEYS, F.concat(F.lit("p"), F.col("k") % 6).alias("plan_id"), "creative_id", F.concat(F.lit("a"), F.col("k") % 3).alias("admaster_id"), "ocpx_tag")
    return V.link_conversions(known, conv, KEYS)


LINK_SQL = """lk AS (SELECT app_id, id, adsolt_id, max('p' || (k % 6)) AS plan_id, max(creative_id) AS creative_id, max('a' || (k % 3)) AS admaster_id, max(ocpx_tag) AS ocpx_tag, CAST(max(CASE WHEN ocpx_tag = 'alp_1' THEN 1 ELSE 0 END) AS BIGINT) AS if_new_enter,
  CAST(max(CASE WHEN ocpx_tag = 'alp_2' THEN 1 ELSE 0 END) AS BIGINT) AS if_live_awaken, CAST(max(CASE WHEN ocpx_tag = 'alp_3' THEN 1 ELSE 0 END) AS BIGINT) AS if_pay, CAST(max(CASE WHEN ocpx_tag = 'alp_4' THEN 1 ELSE 0 END) AS BIGINT) AS if_mau
  FROM di WHERE event_type = 'purchase' AND (app_id, id, adsolt_id) IN (SELECT (app_id, id, adsolt_id) FROM di WHERE event_type = 'view' AND id IS NOT NULL) GROUP BY 1, 2, 3)"""


@query("link_conversions", f"WITH {IDS_CTE}, {LINK_SQL} SELECT * FROM lk")
def _(t: Tables):
    return conversions(t)


#: Attributes of the daily table of which the greatest value is kept.
MAXIMA = ["os", "imei", "idfa", "oaid", "android_id", "ip", "id_type", "brand", "browser", "longitude", "latitude"]


def full_log(t: Tables):
    """The device log with brand, browser and cut coordinates made from raw columns."""
    u, k = F.col("user_id"), F.col("k")
    agent = F.concat(F.lit("Mozilla/5.0 (X11) Chrome/"), k + 1, F.lit(".0 Safari/537.36"))
    point = F.concat(u % 180, F.lit("."), k % 100)
    return with_id(t).withColumns({
        "brand": D.brand_of("producer"), "browser": D.ua_browser(agent), "longitude": C.truncate_coord(point), "latitude": C.floor_coord(F.concat(F.lit("-"), point)),
    })


DEVICE_TYPE_SQL = "CAST(CASE WHEN os = '1' THEN CASE WHEN imei IS NULL OR imei = '' OR imei = '000000000000000' THEN 3 ELSE 1 END ELSE 2 END AS BIGINT)"
FULL_CTE = IDS_CTE + f""", dx AS (SELECT *, {DEVICE_TYPE_SQL} AS id_type, CASE k % 5 WHEN 0 THEN 'huawei' WHEN 1 THEN 'apple' WHEN 2 THEN 'redmi' ELSE 'other' END AS brand, 'Chrome' || (k + 1) AS browser,
  CAST(user_id % 180 AS VARCHAR) AS longitude, CAST(floor(CAST('-' || (user_id % 180) || '.' || (k % 100) AS DOUBLE)) AS BIGINT) AS latitude FROM di)"""
SHARED = ["req_count", *[c for c in RATES if c.startswith("req")], "imp_cnt", "imp_rate", "imp_creative_count", "imp_max_count_creative", "imp_avg_real_price", "imp_max_real_price", "imp_min_real_price", "clk_cnt", "clk_rate", "clk_creative_count", "clk_max_count_creative"]
PER_ID = [*SHARED, "req_app_count", "imp_app_count", "clk_app_count", *[f"clk_{n}" for n in ("first_seconds", "last_seconds", "min_interval", "max_interval", "avg_interval")]]


def renamed(alias: str, cols: list[str], suffix: str) -> str:
    return ", ".join(f"{r(f'{alias}.{c}') if c in RATES else f'{alias}.{c}'} AS {c}{suffix}" for c in cols)


ON_DAY = f"day = '{DAY}'"


@query("behaviour_daily_table", f"""WITH {FULL_CTE}, {LINK_SQL},
sl AS (WITH {features_sql(*picked(ON_DAY, 'dx'), 'app_id, id, adsolt_id', True, MODES, maxima=MAXIMA)} SELECT {rounded()} FROM ft),
pi AS (WITH {features_sql(*picked(ON_DAY, 'dx'), 'id', True, [], apps=True)} SELECT * FROM ft),
dd AS (WITH {features_sql(*picked(THREE_DAYS, 'dx'), 'app_id, id, adsolt_id', False, [])} SELECT * FROM ft)
SELECT sl.*, CAST(CASE WHEN sl.imp_cnt >= 1 THEN 1 ELSE 0 END AS BIGINT) AS if_imp, CAST(CASE WHEN sl.clk_cnt >= 1 THEN 1 ELSE 0 END AS BIGINT) AS if_clk, {renamed('pi', PER_ID, '_2')}, {renamed('dd', SHARED, '_3')}, lk.* EXCLUDE (app_id, id, adsolt_id)
FROM sl LEFT JOIN pi ON sl.id = pi.id LEFT JOIN dd ON sl.app_id = dd.app_id AND sl.id = dd.id AND sl.adsolt_id = dd.adsolt_id LEFT JOIN lk ON sl.app_id = lk.app_id AND sl.id = lk.id AND sl.adsolt_id = lk.adsolt_id""")
def _(t: Tables):
    log = read_date_range(full_log(t), DAY, 3, date_col="day").withColumn("log_kind", F.expr(f"CASE {' '.join(f'WHEN {cond} THEN {chr(39)}{k}{chr(39)}' for k, cond in KINDS.items())} END"))
    spec = V.BehaviourSpec(max_cols=MAXIMA, req_price="value", price="value", time="sec", apps="app_id")
    # one pass over the logs of all days; every grain and day range is made of these
    partials = P.behaviour_partials(log, "log_kind", "day", KEYS, spec)
    today = f"day = '{DAY}'"
    grains = [P.Grain("slot", KEYS, today, MODES, MAXIMA, timing=True), P.Grain("id", ["id"], today, timing=True, apps=True), P.Grain("days", KEYS, "true")]
    at = P.behaviour_of_partials(partials, grains, spec, P.column_types(log, MAXIMA), DAY_START)
    return V.behaviour_daily(at["slot"], at["id"], at["days"], conversions(t), KEYS)


@query("feature_block_join", f"""WITH {EVENTS_CTE} SELECT a.user_id, a.day, a.n AS views, b.n AS clicks, c.n AS total FROM (SELECT user_id, day, count(*) AS n FROM ev WHERE event_type = 'view' GROUP BY ALL) a
LEFT JOIN (SELECT user_id, day, count(*) AS n FROM ev WHERE event_type = 'click' GROUP BY ALL) b ON a.user_id = b.user_id AND a.day = b.day LEFT JOIN (SELECT user_id, count(*) AS n FROM ev GROUP BY ALL) c ON a.user_id = c.user_id""")
def _(t: Tables):
    e = events(t)
    views = e.where("event_type = 'view'").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("views"))
    clicks = e.where("event_type = 'click'").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("clicks"))
    total = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    return left_join_blocks(views, [(clicks, ["user_id", "day"]), (total, ["user_id"])])


CROWD_SQL = """lg AS (SELECT CASE event_type WHEN 'purchase' THEN 'conv' WHEN 'click' THEN 'clk' ELSE 'imp' END AS log, CASE WHEN k % 2 = 0 THEN 'm1' ELSE 'm2' END AS model_type, CASE WHEN length(imei) = 32 THEN NULL ELSE imei END AS imei_p, CASE WHEN length(imei) = 32 THEN imei ELSE md5(imei) END AS imei_m,
  CASE WHEN length(idfa) = 32 THEN NULL ELSE idfa END AS idfa_p, CASE WHEN length(idfa) = 32 THEN idfa ELSE md5(idfa) END AS idfa_m, oaid, sec, substr(ocpx_tag, 5) AS tag FROM dv WHERE event_type IN ('purchase', 'click', 'view')),
lx AS (SELECT 'imei_md5' AS device_type, imei_m AS device_value, * FROM lg UNION ALL SELECT 'idfa_md5', idfa_m, * FROM lg UNION ALL SELECT 'oaid', oaid, * FROM lg),
lc AS (SELECT *, row_number() OVER (PARTITION BY device_type, device_value, model_type ORDER BY sec DESC, tag DESC) AS rn FROM lx WHERE log = 'conv'),
cr AS (SELECT device_type, device_value, model_type, max(imei_p) FILTER (WHERE log <> 'conv') AS i1, max(idfa_p) FILTER (WHERE log <> 'conv') AS f1, count(*) FILTER (WHERE log = 'imp') AS imp_count, coalesce(max(sec) FILTER (WHERE log = 'clk'), 0) AS clk_time, count(*) FILTER (WHERE log = 'clk') AS clk_count
  FROM lx WHERE device_value IS NOT NULL AND device_value <> '' GROUP BY ALL),
cp AS (SELECT cr.device_type, cr.device_value, cr.model_type, greatest(lc.imei_p, i1) AS imei, greatest(lc.idfa_p, f1) AS idfa, lc.tag AS ocpx_tag, coalesce(lc.sec, 0) AS ocpx_time, imp_count, clk_time, clk_count
  FROM cr LEFT JOIN lc ON rn = 1 AND cr.device_type = lc.device_type AND cr.device_value = lc.device_value AND cr.model_type = lc.model_type)"""


def crowd(t: Tables):
    log = device_log(t)
    model = F.when(F.col("k") % 2 == 0, "m1").otherwise("m2")
    return V.crowd_profile(log.where("event_type = 'purchase'"), log.where("event_type = 'click'"), log.where("event_type = 'view'"), model, time="sec")


@query("crowd_profile", f"WITH {DEVICE_CTE}, {CROWD_SQL} SELECT * FROM cp")
def _(t: Tables):
    return crowd(t)


@query("latest_result_per_device", f"""WITH {DEVICE_CTE}, w AS (SELECT network, CASE WHEN length(imei) = 32 THEN NULL ELSE imei END AS p, CASE WHEN length(imei) = 32 THEN imei ELSE md5(imei) END AS m, sec, ocpx_tag FROM dv WHERE imei <> '')
SELECT network, m AS device_id_md5, max(p) AS device_id, max(sec) AS time, (list(ocpx_tag ORDER BY sec DESC, ocpx_tag DESC))[1] AS result FROM w GROUP BY ALL""")
def _(t: Tables):
    return V.latest_result(device_log(t), ["network"], "imei", "sec", "ocpx_tag")
