"""Queries over the bidding log stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranking import dedup_first, latest_flag, latest_per_key
from ..plans import bidding as B
from .registry import Tables, query, r
from .stand_ins import BID_CTE, EVENTS_CTE, bid_log, events


def deduped(t: Tables):
    return B.dedup_bid_log(bid_log(t), tie_break=["event_id"])


DEDUP_CTE = BID_CTE + """, dd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY logtype, trace_id, request_id, adsolt_id ORDER BY time, event_id) AS rn FROM bid) WHERE rn = 1)"""

c14, c11, c12, c13, c15, c16, c17, c10 = (f"count(*) FILTER (WHERE logtype = '{c}')" for c in (14, 11, 12, 13, 15, 16, 17, 10))


def s(code: str, col: str) -> str:
    return f"sum({col}) FILTER (WHERE logtype = '{code}')"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def dec(expr: str, places: int) -> str:
    """A decimal of ``places`` as :func:`tidy` shows it; halves are told from the nine-place value."""
    return r(f"round(CAST({expr} AS DECIMAL(30, 9)), {places})")


@query("bid_log_dedup", f"WITH {DEDUP_CTE} SELECT logtype, trace_id, request_id, adsolt_id, event_id, time FROM dd")
def _(t: Tables):
    return deduped(t).select("logtype", "trace_id", "request_id", "adsolt_id", "event_id", "time")


@query("bid_log_dedup_one_day", f"WITH {BID_CTE} SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY logtype, trace_id, request_id, adsolt_id ORDER BY time, event_id) AS rn FROM bid WHERE etl_date = '2024-01-05') WHERE rn = 1")
def _(t: Tables):
    return B.dedup_bid_log(bid_log(t), "2024-01-05", tie_break=["event_id"]).select("event_id")


LATEST_PRICE = "coalesce((list({col} ORDER BY time DESC, {col} DESC) FILTER (WHERE logtype = '11'))[1], 0.0)"


@query("plan_hourly", f"""WITH {DEDUP_CTE}
SELECT admaster_id, plan_id, {r(LATEST_PRICE.format(col='plan_price'))} AS plan_price, {r(LATEST_PRICE.format(col='real_price'))} AS real_price,
  {c11} AS plan_bid_count, {c12} AS inner_win_count, {c13} AS outer_bid_succ_count, {c16} AS outer_bid_fail_count, {c14} AS imp_count,
  {r(f"coalesce({s('14', 'win_price')}, 0)")} AS real_cost, {c15} AS clk_count, {c17} AS trans_count
FROM dd WHERE logtype <> '10' AND admaster_id <> '' AND plan_id <> '' GROUP BY admaster_id, plan_id""")
def _(t: Tables):
    return B.plan_hourly(deduped(t))


@query("creative_hourly", f"""WITH {DEDUP_CTE}, g AS (
SELECT admaster_id, plan_id, creative_id, adsolt_type AS creative_type, {LATEST_PRICE.format(col='plan_price')} AS pp, {c11} AS n11, {c12} AS n12, {c13} AS n13, {c16} AS n16, {c14} AS n14,
  {s('14', 'win_price')} AS cost, {c15} AS n15, {c17} AS n17, {s('17', 'conversion_unit_price')} AS earn
FROM dd WHERE logtype <> '10' GROUP BY ALL)
SELECT admaster_id, plan_id, creative_id, creative_type, {dec('pp', 3)} AS plan_price, n11 AS bid_count, n12 AS inner_win_count, {dec(div('n12', 'n11'), 4)} AS inner_bid_succ_rate,
  n13 AS outer_bid_succ_count, {dec(div('n13', 'n12'), 4)} AS outer_bid_succ_rate, n16 AS outer_bid_fail_count, n14 AS imp_count, {dec(div('n14', 'n13'), 4)} AS imp_rate,
  {dec(div('cost', 'n14'), 3)} AS avg_win_price, n15 AS clk_count, {dec(div('n15', 'n14'), 4)} AS clk_rate, n17 AS trans_count, {dec(div('n17', 'n15'), 4)} AS trans_rate,
  {dec('cost / 1000', 3)} AS total_cost, {dec(div('cost / 1000', 'n17'), 3)} AS trans_cost, {dec('earn', 3)} AS total_earning, {dec('earn - cost / 1000', 3)} AS profit
FROM g""")
def _(t: Tables):
    return B.creative_hourly(deduped(t))


@query("channel_quality", f"""WITH {DEDUP_CTE}, g AS (
SELECT downstream_id, adsolt_type, {c10} AS n10, {s('10', 'floor_price')} AS fl, count(*) FILTER (WHERE logtype = '10' AND res_code = '400') AS bad, {c12} AS n12,
  avg(plan_price) FILTER (WHERE logtype = '12') AS bid, {c11} AS n11, {c13} AS n13, {c16} AS n16, {c14} AS n14, {s('14', 'win_price')} AS cost, {c15} AS n15
FROM dd GROUP BY ALL)
SELECT downstream_id, adsolt_type, n10 AS req_count, CAST(n10 // 3600 AS BIGINT) AS qps, {r(div('fl', 'n10'))} AS avg_floor_price, bad AS abnormal_req_count,
  n12 AS fill_resp_count, {r('bid')} AS avg_bid_price, {r(div('n12', 'n10'))} AS fill_rate, n11 AS plan_bid_count, n13 AS outer_bid_succ_count,
  {r(div('n13', 'n12'))} AS bid_win_rate, n16 AS outer_bid_fail_count, n14 AS imp_count, {r(div('cost', 'n14'))} AS avg_win_price, {r(div('n14', 'n13'))} AS imp_rate,
  n15 AS clk_count, {r(div('n15', 'n14'))} AS clk_rate, {r('cost / 1000')} AS total_cost, {r(div('cost / 1000', 'n15'))} AS clk_cost
FROM g""")
def _(t: Tables):
    return B.channel_quality(deduped(t))


@query("conversion_daily", f"""WITH {DEDUP_CTE}, g AS (
SELECT plan_id, creative_id, stuff_id, conversion_task_id AS conv_id, {c11} AS n11, {c12} AS n12, avg(plan_price) FILTER (WHERE logtype = '12') AS bid,
  {c13} AS n13, {c14} AS n14, avg(win_price) FILTER (WHERE logtype = '14') AS clear, {c15} AS n15, {c17} AS n17, {s('14', 'win_price')} AS cost, {s('17', 'conversion_unit_price')} AS earn
FROM dd GROUP BY ALL)
SELECT plan_id, creative_id, stuff_id, conv_id, n11 AS offer_req, n12 AS fill_req, {r('bid')} AS bid_price_avg, n13 AS ssp_win, {r(div('n13', 'n12'))} AS win_rate,
  n14 AS imp, {r(div('n14', 'n13'))} AS imp_rate, {r('clear')} AS clear_price_avg, n15 AS clk, {r(div('n15', 'n14'))} AS ctr, n17 AS conversion,
  {r(div('n17', 'n15'))} AS cvr, {r('cost / 1000')} AS cost, {r('earn')} AS revenue, {r('earn - cost / 1000')} AS margin
FROM g""")
def _(t: Tables):
    return B.conversion_daily(deduped(t))


def target_sql(col: str, out: str) -> str:
    return f"""tf AS (SELECT {col} AS {out}, downstream_id AS channel_id, plan_id, conversion_task_id AS conv_task, avg(floor_price) FILTER (WHERE logtype = '11') AS floor_avg,
  {c12} AS fill_req, avg(plan_price) FILTER (WHERE logtype = '11') AS bid_price_avg, {c13} AS ssp_win, {c14} AS imp, avg(win_price) FILTER (WHERE logtype = '14') AS clear_price_avg,
  {c15} AS clk, {div(c15, c14)} AS ctr, {c17} AS conversion, {div(c17, c15)} AS cvr FROM dd GROUP BY ALL)"""


def labelled_sql(out: str, branches: list[str]) -> str:
    cols = f"{out}, channel_id, plan_id, conv_task, {r('floor_avg')} AS floor_avg, fill_req, {r('bid_price_avg')} AS bid_price_avg, ssp_win, imp, {r('clear_price_avg')} AS clear_price_avg, clk, {r('ctr')} AS ctr, conversion, {r('cvr')} AS cvr"
    return " UNION ALL ".join(f"SELECT {cols}, CAST({i + 1} AS BIGINT) AS summary_type FROM (SELECT * FROM tf WHERE {b})" for i, b in enumerate(branches))


KEYS = "channel_id, plan_id, conv_task"
WIN_RULE = f"ssp_win >= 2 AND {div('imp', 'ssp_win')} * 100 < 60 ORDER BY ssp_win DESC, {div('imp', 'ssp_win')} ASC, "


@query("device_conversion", f"""WITH {DEDUP_CTE}, {target_sql('device_id', 'device_id')}
{labelled_sql('device_id', ['conversion > 0', f'imp >= 2 AND ctr <= 0.5 ORDER BY imp DESC, ctr ASC, device_id, {KEYS} LIMIT 100', WIN_RULE + f'device_id, {KEYS} LIMIT 100'])}""")
def _(t: Tables):
    return B.device_conversion(deduped(t), min_imp=2, low_ctr=0.5, min_win=2, imp_per_win=60)


@query("bundle_conversion", f"""WITH {DEDUP_CTE}, {target_sql('pkg_name', 'bundle')}
{labelled_sql('bundle', [f'imp >= 2 AND ctr >= 1 ORDER BY imp DESC, ctr DESC, bundle, {KEYS} LIMIT 100', f'imp >= 2 AND ctr <= 0.5 ORDER BY imp DESC, ctr ASC, bundle, {KEYS} LIMIT 100', WIN_RULE + f'bundle, {KEYS} LIMIT 100'])}""")
def _(t: Tables):
    return B.bundle_conversion(deduped(t), min_imp=2, high_ctr=1.0, low_ctr=0.5, min_win=2, imp_per_win=60)


def _bands() -> str:
    edges = B.FLOOR_EDGES
    conds = {f"less_{edges[0]}": f"floor_price <= {edges[0]}"}
    conds |= {f"less_{hi}": f"floor_price > {lo} AND floor_price <= {hi}" for lo, hi in zip(edges, edges[1:])}
    conds[f"great_{edges[-1]}"] = f"floor_price > {edges[-1]}"
    return ", ".join(
        f"count(*) FILTER (WHERE logtype = '{code}' AND {cond}) AS {name}_{band}"
        for band, cond in conds.items() for name, code in (("req", "10"), ("fill", "12"), ("win", "13"))
    )


@query("floor_price_histogram", f"WITH {DEDUP_CTE} SELECT pkg_name AS bundle, adsolt_shape AS ad_size, {_bands()} FROM dd GROUP BY pkg_name, adsolt_shape HAVING {c10} > 30")
def _(t: Tables):
    return B.floor_price_histogram(deduped(t), min_req=30)


CUBE_COLS = ", ".join(f"{src} AS {out}" for out, src in B.CUBE_KEYS.items())
CUBE_CTE = DEDUP_CTE + f""", cube0 AS (SELECT {CUBE_COLS}, {c10} AS total_req, {s('10', 'floor_price')} AS bid_floor_sum, {c11} AS offer_bid, {s('11', 'plan_price')} AS offer_price,
  {c12} AS fill_req, {s('12', 'plan_price')} AS bid_price, {c13} AS ssp_win, {c16} AS ssp_loss, {c14} AS imp, {s('14', 'win_price')} AS clear_price, {c15} AS clk, {c17} AS conversion,
  {s('14', 'win_price')} AS cost, {s('17', 'conversion_unit_price')} AS revenue, {s('12', 'floor_price')} AS fill_bid_floor_sum FROM dd GROUP BY ALL)"""
CUBE_MONEY = ("bid_floor_sum", "offer_price", "bid_price", "clear_price", "cost", "revenue", "fill_bid_floor_sum")
CUBE_COUNTS = ("total_req", "offer_bid", "fill_req", "ssp_win", "ssp_loss", "imp", "clk", "conversion")


@query("dimension_cube", f"WITH {CUBE_CTE} SELECT {', '.join(B.CUBE_KEYS)}, {', '.join(CUBE_COUNTS)}, {', '.join(f'{r(m)} AS {m}' for m in CUBE_MONEY)} FROM cube0")
def _(t: Tables):
    return B.dimension_cube_base(deduped(t))


@query("dimension_cube_named", f"""WITH {CUBE_CTE}
SELECT c.plan_id, c.creative_id, c.adv_id, p.r_name AS plan_name, n.n_name AS creative_name, a.s_name AS adv_name, CAST(sum(total_req) AS BIGINT) AS total_req FROM cube0 c
LEFT JOIN region p ON c.plan_id = 'p' || p.r_regionkey LEFT JOIN nation n ON c.creative_id = 'c' || n.n_nationkey LEFT JOIN supplier a ON c.adv_id = 'a' || a.s_suppkey
GROUP BY ALL""")
def _(t: Tables):
    named = B.named_cube(
        B.dimension_cube_base(deduped(t)),
        t.region.select(F.concat(F.lit("p"), "r_regionkey").alias("plan_num"), F.col("r_name").alias("name")),
        t.nation.select(F.concat(F.lit("c"), "n_nationkey").alias("creative_num"), F.col("n_name").alias("name")),
        t.supplier.select(F.concat(F.lit("a"), "s_suppkey").alias("organ_id"), F.col("s_name").alias("name")),
    )
    return named.groupBy("plan_id", "creative_id", "adv_id", "plan_name", "creative_name", "adv_name").agg(F.sum("total_req").alias("total_req"))


@query("win_rate_report", f"""WITH {CUBE_CTE}, g AS (SELECT plan_id, country, ad_type, bundle, ad_size, CAST(sum(total_req) AS BIGINT) AS total_req,
  coalesce({div('sum(bid_floor_sum)', 'sum(total_req)')}, 0) AS bid_floor_avg, CAST(sum(fill_req) AS BIGINT) AS bid_req, coalesce({div('sum(bid_price)', 'sum(fill_req)')}, 0) AS bid_price_avg,
  CAST(sum(ssp_win) AS BIGINT) AS ssp_win, coalesce({div('sum(ssp_win)', 'sum(fill_req)')}, 0) AS win_rate, CAST(sum(conversion) AS BIGINT) AS conversion, coalesce({div('sum(cost)', 'sum(conversion)')}, 0) AS cpa
  FROM cube0 GROUP BY ALL), k AS (SELECT * FROM g WHERE bid_req > 1)
SELECT plan_id, country, ad_type, bundle, ad_size, total_req, {r('bid_floor_avg')} AS bid_floor_avg, bid_req, {r('bid_price_avg')} AS bid_price_avg, ssp_win, {r('win_rate')} AS win_rate, conversion, {r('cpa')} AS cpa, {r('q')} AS query_condition
FROM (SELECT *, 0.5 AS q FROM k WHERE win_rate > 0.5 UNION ALL SELECT *, 0.3 AS q FROM k WHERE win_rate < 0.3)""")
def _(t: Tables):
    return B.win_rate_report(B.dimension_cube_base(deduped(t)), min_bids=1)


@query("latest_event_per_user", f"WITH {EVENTS_CTE} SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY sec DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1")
def _(t: Tables):
    return latest_per_key(events(t), ["user_id", "event_type"], ["sec", "event_id"]).select("user_id", "event_type", "event_id")


@query("latest_event_flag", f"WITH {EVENTS_CTE} SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY sec DESC, event_id DESC) = 1 THEN CAST(1 AS BIGINT) ELSE 0 END AS is_latest FROM ev")
def _(t: Tables):
    return latest_flag(events(t), ["user_id", "event_type"], ["sec", "event_id"]).select("event_id", "is_latest")


@query("first_event_per_hour", f"WITH {EVENTS_CTE} SELECT user_id, event_type, day, hour, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day, hour ORDER BY sec, event_id) AS rn FROM ev) WHERE rn = 1")
def _(t: Tables):
    return dedup_first(events(t), ["user_id", "event_type", "day", "hour"], ["sec", "event_id"]).select("user_id", "event_type", "day", "hour", "event_id")
