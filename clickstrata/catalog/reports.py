"""Plan KPIs and settlement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports as R
from .registry import Tables, query, r

DAILY_CTE = """dl AS (SELECT strftime(o_orderdate, '%Y-%m') AS time, o_custkey % 40 AS plan_id, o_custkey % 3 AS aduser_id, l_quantity * 10 AS req, l_quantity * 5 AS bid, CASE WHEN o_custkey % 20 = 5 THEN 0 ELSE l_quantity END AS "show",
  CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END AS click, CAST(l_extendedprice * 100 AS DECIMAL(18, 2)) AS cost, CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)) AS income, CASE WHEN o_orderstatus = 'F' THEN 'no' ELSE 'yes' END AS del FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""


def daily(t: Tables):
    """Lines as daily plan statistics; money is decimal, so its sums are exact."""
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("time"), (F.col("o_custkey") % 40).alias("plan_id"), (F.col("o_custkey") % 3).alias("aduser_id"), (F.col("l_quantity") * 10).alias("req"),
        (F.col("l_quantity") * 5).alias("bid"), F.when(F.col("o_custkey") % 20 == 5, 0.0).otherwise(F.col("l_quantity")).alias("show"),
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).otherwise(0.0).alias("click"), (F.col("l_extendedprice") * 100).cast("decimal(18,2)").alias("cost"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)").alias("income"), F.when(F.col("o_orderstatus") == "F", "no").otherwise("yes").alias("del"),
    )


def r2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 9)), 2) AS DOUBLE)"


KPI_SQL = """kp AS (SELECT time, plan_id, sum(req) AS req, sum(bid) AS bid, sum("show") AS "show", sum(click) AS click, CAST(sum(cost) AS DOUBLE) / 100000 AS cost FROM dl GROUP BY ALL)"""


@query("plan_kpis", f"""WITH {DAILY_CTE}, {KPI_SQL} SELECT time, plan_id, {r('req')} AS req, {r('bid')} AS bid, {r('"show"')} AS "show", {r('click')} AS click, {r2('cost')} AS cost, {r2('click / nullif("show", 0) * 100')} AS ctr,
 {r2('cost / nullif("show", 0) * 1000')} AS ecpm, {r2('cost / nullif(click, 0)')} AS cpc, {r2('bid / nullif(req, 0) * 100')} AS bid_rate, {r2('"show" / nullif(bid, 0) * 100')} AS bid_success_rate FROM kp""")
def _(t: Tables):
    return R.plan_kpis(daily(t))


@query("slot_ecpm", f"""WITH {DAILY_CTE} SELECT time, plan_id, {r('sum("show")')} AS "show", {r2('CAST(sum(income) AS DOUBLE) / sum("show") * 1000')} AS ecpm FROM dl WHERE del = 'no' GROUP BY ALL HAVING sum("show") <> 0""")
def _(t: Tables):
    return R.slot_ecpm(daily(t).where("del = 'no'"), ["time", "plan_id"], "income")


UP_CTE = """up AS (SELECT strftime(o_orderdate, '%Y-%m') AS time, o_custkey % 40 AS plan_id, o_orderkey, o_totalprice FROM orders)"""


def uploads(t: Tables):
    return t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("time"), (F.col("o_custkey") % 40).alias("plan_id"), "o_orderkey", "o_totalprice")


@query("dedupe_upload_largest", f"WITH {UP_CTE} SELECT time, plan_id, o_orderkey, {r('o_totalprice')} AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY time, plan_id ORDER BY o_totalprice DESC, o_orderkey DESC) AS rn FROM up) WHERE rn = 1")
def _(t: Tables):
    return R.dedupe_upload(uploads(t), ["time", "plan_id"], largest="o_totalprice")


@query("dedupe_upload_summed", f"WITH {UP_CTE} SELECT time, plan_id, min(o_orderkey) AS o_orderkey, {r('sum(o_totalprice)')} AS o_totalprice FROM up GROUP BY time, plan_id")
def _(t: Tables):
    return R.dedupe_upload(uploads(t), ["time", "plan_id"], sum_cols=["o_totalprice"])


def settled(t: Tables):
    """Uploaded rebates joined with plan KPIs and conversion counts."""
    kpi = R.plan_kpis(daily(t)).select("time", "plan_id", "show", "click")
    ecpm = R.slot_ecpm(daily(t).where("del = 'no'"), ["time", "plan_id"], "income").select("time", "plan_id", "ecpm")
    wakes = daily(t).groupBy("time", "plan_id").agg(F.sum(F.when(F.col("del") == "no", F.col("click"))).alias("first_wake"))
    upload = uploads(t).groupBy("time", "plan_id").agg((F.sum("o_totalprice") / 1000).alias("rebate"), F.count(F.lit(1)).alias("total_active"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("target_active"))
    return R.settlement_report(R.join_report_blocks(upload, [kpi, ecpm, wakes]))


C = {"e": "ecpm", "s": '"show"', "k": "click", "r": "rebate", "w": "first_wake", "t": "total_active", "g": "target_active"}


def d(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


@query("settlement_report", f"""WITH {DAILY_CTE}, {UP_CTE}, {KPI_SQL}, u AS (SELECT time, plan_id, sum(o_totalprice) / 1000 AS rebate, count(*) AS total_active, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS target_active FROM up GROUP BY ALL),
e AS (SELECT time, plan_id, {r2('CAST(sum(income) AS DOUBLE) / sum("show") * 1000')} AS ecpm FROM dl WHERE del = 'no' GROUP BY ALL HAVING sum("show") <> 0), w AS (SELECT time, plan_id, sum(click) FILTER (WHERE del = 'no') AS first_wake FROM dl GROUP BY ALL),
j AS (SELECT u.*, kp."show", kp.click, e.ecpm, w.first_wake, CASE WHEN kp."show" <> 0 THEN e.ecpm * kp."show" / 1000 END AS real_cost FROM u LEFT JOIN kp USING (time, plan_id) LEFT JOIN e USING (time, plan_id) LEFT JOIN w USING (time, plan_id))
SELECT time, plan_id, {r('rebate')} AS rebate, total_active, target_active, {r('"show"')} AS "show", {r('click')} AS click, {r('ecpm')} AS ecpm, {r('first_wake')} AS first_wake, {r('real_cost')} AS real_cost,
 {r(f"ecpm / nullif({d('rebate', 'click')}, 0) / 1000")} AS breakeven_ctr, {r('CASE WHEN real_cost <> 0 THEN rebate - real_cost END')} AS profit, {r(d('rebate', 'real_cost'))} AS roi, {r(d('(rebate - real_cost)', 'real_cost'))} AS profit_share,
 {r(d('rebate * 1000', C['s']))} AS rebate_ecpm, {r(d('rebate', 'click'))} AS rebate_cpc, {r(d('real_cost', 'click'))} AS cost_cpc, {r(d('first_wake', 'click'))} AS wake_rate, {r(d('total_active', 'first_wake'))} AS total_per_wake,
 {r(d('target_active', 'first_wake'))} AS target_per_wake, {r(d('total_active', 'click'))} AS total_cvr, {r(d('target_active', 'click'))} AS target_cvr, {r(d('target_active', 'total_active'))} AS target_share, {r(d('rebate', 'target_active'))} AS uv_price, {r(d('real_cost', 'target_active'))} AS uv_cost FROM j""")
def _(t: Tables):
    return settled(t)


@query("tiered_rebate", f"SELECT l_orderkey, l_linenumber, {r('l_quantity * 0.3 * l_discount + l_quantity * 2 * l_tax + 0')} AS rebate FROM lineitem".replace("SELECT l_orderkey, l_linenumber", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"))
def _(t: Tables):
    rows = t.lineitem.withColumns({"n": F.col("l_quantity"), "p": F.lit(2.0), "none": F.lit(None).cast("double")})
    return rows.select("l_orderkey", "l_linenumber", R.tiered_rebate([("n", 0.3, "l_discount"), ("n", "p", "l_tax"), ("none", "p", "l_tax")]).alias("rebate"))


@query("plan_classes", "SELECT p_partkey, CASE WHEN p_name LIKE 's%' THEN 'mau' ELSE 'dau' END AS class, CASE WHEN lower(p_type) LIKE '%econ%' THEN 'ios' ELSE 'and' END AS system FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", R.class_of("p_name", "s").alias("class"), R.system_of("p_type", "econ").alias("system"))
