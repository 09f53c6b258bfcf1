"""In-app activity: starts, durations, clicks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import content as N
from .registry import Tables, query
from .stand_ins import EVENTS_CTE, events

ACTS_CTE = EVENTS_CTE + """, ac AS (SELECT sec AS ts, k % 4 + 1 AS type, CASE WHEN user_id % 10 = 0 THEN 'anonymity' ELSE 'u' || user_id END AS uid, CAST(user_id % 12 AS VARCHAR) AS obj, k AS cnt FROM ev)"""


def activity(t: Tables):
    u, k = F.col("user_id"), F.col("k")
    return events(t).select(
        F.col("sec").alias("ts"), (k % 4 + 1).alias("type"), F.when(u % 10 == 0, "anonymity").otherwise(F.concat(F.lit("u"), u)).alias("uid"),
        (u % 12).cast("string").alias("obj"), k.alias("cnt"),
    )


@query("app_starts_by_hour", f"""WITH {ACTS_CTE} SELECT strftime(make_timestamp(ts * 1000000), '%H:00:00') AS hour, count(DISTINCT uid) AS login_uv, CAST(coalesce(sum(cnt) FILTER (WHERE uid <> 'anonymity'), 0) AS BIGINT) AS login_pv,
  CAST(coalesce(sum(cnt) FILTER (WHERE uid = 'anonymity'), 0) AS BIGINT) AS unlogin_pv FROM ac WHERE type = 1 GROUP BY 1""")
def _(t: Tables):
    return N.app_starts_by_hour(activity(t))


@query("duration_buckets", f"""WITH {ACTS_CTE}, g AS (SELECT uid, sum(cnt) AS s FROM ac WHERE type = 2 GROUP BY uid) SELECT count(*) FILTER (WHERE s <= 600) AS less10, count(*) FILTER (WHERE s > 600 AND s <= 1800) AS range30, count(*) FILTER (WHERE s > 1800 AND s <= 3600) AS range60,
  count(*) FILTER (WHERE s > 3600 AND s <= 7200) AS range120, count(*) FILTER (WHERE s > 7200) AS more120, CAST(coalesce(sum(s) FILTER (WHERE uid <> 'anonymity'), 0) AS BIGINT) AS login_cnt, CAST(coalesce(sum(s) FILTER (WHERE uid = 'anonymity'), 0) AS BIGINT) AS unlogin_cnt FROM g""")
def _(t: Tables):
    return N.duration_buckets(activity(t).where("type = 2"))


@query("user_seconds", f"WITH {ACTS_CTE} SELECT uid, CAST(sum(cnt) AS BIGINT) AS game_seconds FROM ac WHERE type = 2 GROUP BY uid")
def _(t: Tables):
    return N.user_seconds(activity(t).where("type = 2"))


@query("user_clicks", f"""WITH {ACTS_CTE}, g AS (SELECT obj AS action, type, CAST(coalesce(sum(cnt) FILTER (WHERE uid <> 'anonymity'), 0) AS BIGINT) AS login_cnt, CAST(coalesce(sum(cnt) FILTER (WHERE uid = 'anonymity'), 0) AS BIGINT) AS unlogin_cnt FROM ac WHERE type IN (3, 4) GROUP BY ALL)
SELECT action, type, login_cnt, unlogin_cnt, CASE type WHEN 3 THEN coalesce(r_name, '') ELSE coalesce(n_name, '') END AS name FROM g LEFT JOIN region ON type = 3 AND action = CAST(r_regionkey AS VARCHAR) LEFT JOIN nation ON type = 4 AND action = CAST(n_nationkey AS VARCHAR)""")
def _(t: Tables):
    tasks = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))
    names = t.nation.select(F.col("n_nationkey").alias("click_flag"), F.col("n_name").alias("click_name"))
    return N.user_clicks(activity(t), tasks, names)
