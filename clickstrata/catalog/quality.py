"""Retention, coverage, sampled ranges, score reports, quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bitmaps as M
from ..operators import quality as Y
from ..operators.dims import ip_geo_join
from ..session import written
from .lookups import IP_NUM, RANGES, nation_ranges
from .registry import Tables, query, r
from .stand_ins import DEVICE_CTE, EVENTS_CTE, device_log, events


@query("retention_overlap", f"""WITH {EVENTS_CTE}, k AS (SELECT CASE WHEN event_type = 'signup' AND CAST(right(day, 2) AS INT) % 3 = 0 THEN 'view' ELSE event_type END AS event_type, user_id, day FROM ev),
d AS (SELECT DISTINCT event_type, user_id, dense_rank() OVER (PARTITION BY event_type ORDER BY day) AS p FROM k), x AS (SELECT event_type, user_id, p AS rn FROM d UNION ALL SELECT event_type, user_id, p + 1 FROM d),
g AS (SELECT event_type, user_id, rn, count(*) AS days_seen FROM x GROUP BY ALL) SELECT event_type, CAST(rn AS BIGINT) AS rn, days_seen, count(*) AS ids FROM g GROUP BY ALL""")
def _(t: Tables):
    # Sign-ups miss every third day, so the kinds have calendars of their own.
    gap = (F.col("event_type") == "signup") & (F.right("day", F.lit(2)).cast("int") % 3 == 0)
    return Y.retention_overlap(events(t).withColumn("event_type", F.when(gap, "view").otherwise(F.col("event_type"))), "day", "event_type", "user_id")


@query("counts_per_day", f"WITH {EVENTS_CTE} SELECT day, event_type, count(*) AS cnt FROM ev GROUP BY ALL")
def _(t: Tables):
    return Y.day_counts(events(t), "day", "event_type")


@query("distinct_over_days", f"WITH {EVENTS_CTE} SELECT event_type, count(DISTINCT user_id) AS cnt FROM ev WHERE day IN ('2024-01-03', '2024-01-04', '2024-01-05') GROUP BY event_type")
def _(t: Tables):
    return Y.distinct_over_days(events(t), "day", "event_type", "user_id", ["2024-01-03", "2024-01-04", "2024-01-05"])


@query("geo_precision", f"""WITH {DEVICE_CTE}, {RANGES}, d AS (SELECT DISTINCT ip, r_name AS region, CASE WHEN length(n_name) > 8 THEN n_name ELSE 'null' END AS nation FROM dv LEFT JOIN rg ON {IP_NUM} BETWEEN lo AND hi)
SELECT count(*) AS total, count(region) AS region_known, count(*) FILTER (WHERE region IS NOT NULL AND nation <> 'null') AS nation_known FROM d""")
def _(t: Tables):
    located = ip_geo_join(device_log(t).select("ip").distinct(), nation_ranges(t), "ip", ["n_name", "r_name"])
    named = located.select("ip", F.col("r_name").alias("region"), F.when(F.length("n_name") > 8, F.col("n_name")).otherwise("null").alias("nation"))
    return Y.geo_precision(named, ["region", "nation"], key="ip")


@query("ids_per_range_with_sample", """WITH p AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL), q AS (SELECT l_suppkey, l_partkey, CASE WHEN n <= 5 THEN CAST(n AS VARCHAR) WHEN n <= 8 THEN '6,7,8' WHEN n <= 10 THEN '9,10' ELSE '>10' END AS "range" FROM p),
s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, "range" ORDER BY l_partkey) AS rn FROM q) SELECT l_suppkey, "range", count(*) AS cnt, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) FILTER (WHERE rn <= 10) AS sample FROM s GROUP BY ALL""")
def _(t: Tables):
    return Y.bucket_with_sample(t.lineitem, ["l_suppkey"], "l_partkey")


def scored(t: Tables):
    return t.labels.select("doc_id", "toxic", ((F.col("doc_id") * 37) % 100 / 100).alias("score"))


SCORED = "sc AS (SELECT doc_id, toxic, ((doc_id * 37) % 100) / 100.0 AS score FROM labels)"


@query("confusion_report", f"""WITH {SCORED}, c AS (SELECT t AS threshold, count(*) FILTER (WHERE toxic = 1 AND score >= t) AS tp, count(*) FILTER (WHERE toxic <> 1 AND score >= t) AS fp, count(*) FILTER (WHERE toxic <> 1 AND score < t) AS tn, count(*) FILTER (WHERE toxic = 1 AND score < t) AS fn
  FROM sc, (VALUES (0.5), (0.4)) v(t) GROUP BY t) SELECT {r('threshold')} AS threshold, tp, fp, tn, fn, {r('tp / nullif(tp + fn, 0)')} AS tpr, {r('fp / nullif(fp + tn, 0)')} AS fpr, {r('tn / nullif(tn + fp, 0)')} AS tnr, {r('fn / nullif(fn + tp, 0)')} AS fnr FROM c""")
def _(t: Tables):
    return Y.confusion_report(scored(t), "toxic", "score")


@query("score_histogram", f"""WITH {SCORED}, b AS (SELECT (doc_id * 37) % 100 // 10 AS b, count(*) AS cnt FROM sc GROUP BY 1) SELECT {r('b / 10.0')} AS bucket, cnt, {r('cnt / sum(cnt) OVER ()')} AS rate, {r('(sum(cnt) FILTER (WHERE b >= 5) OVER ()) / sum(cnt) OVER ()')} AS share_high FROM b""")
def _(t: Tables):
    return Y.score_histogram(scored(t), "score")


@query("exact_percentile", f"SELECT {r('quantile_cont(l_extendedprice, 0.37)')} AS percentile FROM lineitem")
def _(t: Tables):
    return Y.exact_percentile(t.lineitem, "l_extendedprice", 0.37, accuracy=1000)


@query("median_per_group", f"WITH {EVENTS_CTE} SELECT event_type, {r('quantile_cont(value, 0.5)')} AS med FROM ev GROUP BY event_type")
def _(t: Tables):
    return Y.grouped_percentile(events(t), ["event_type"], "value", 0.5, "med")


TAIL = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
TAIL_CTE = "tl AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE 's' || (l_suppkey % 50) END AS grp, CAST(l_extendedprice AS DOUBLE) / (1 + l_linenumber * l_linenumber * l_linenumber) AS v FROM lineitem)"


@query("order_statistics", f"WITH {TAIL_CTE}, {', '.join(f'q{i} AS (SELECT grp, {q} AS q, quantile_cont(v, {q}) AS p FROM tl GROUP BY grp)' for i, q in enumerate(TAIL))} SELECT grp, {r('q')} AS q, {r('p')} AS percentile FROM ({' UNION ALL '.join(f'SELECT * FROM q{i}' for i in range(len(TAIL)))})")
def _(t: Tables):
    hot, n = F.col("l_orderkey") % 3 == 0, F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("double")
    tail = t.lineitem.select(F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("l_suppkey") % 50)).alias("grp"), (price / (1 + n * n * n)).alias("v"))
    return Y.order_statistics(tail, ["grp"], "v", TAIL, rows_per_range=5000)


def daily(t: Tables):
    """Daily bitmaps of users per event type; users of the second half of the month are numbered after those of the first."""
    e = events(t)
    numbers = M.number_ids(e.where("day <= '2024-01-15'"), "event_type", "user_id")
    return written(M.daily_bitmaps(e, "day", "event_type", "user_id", M.number_ids(e, "event_type", "user_id", numbers)), "bitmaps")


@query("distinct_days_from_bitmaps", f"WITH {EVENTS_CTE} SELECT event_type AS kind, count(DISTINCT user_id) AS cnt FROM ev WHERE day IN ('2024-01-03', '2024-01-04', '2024-01-20') GROUP BY event_type")
def _(t: Tables):
    return M.distinct_ids(daily(t), ["2024-01-03", "2024-01-04", "2024-01-20"])


@query("rolling_distinct_days", f"WITH {EVENTS_CTE}, d AS (SELECT DISTINCT event_type, user_id, day FROM ev) SELECT a.event_type AS kind, a.day, count(DISTINCT b.user_id) AS cnt FROM (SELECT DISTINCT event_type, day FROM ev) a JOIN d b ON a.event_type = b.event_type AND CAST(b.day AS DATE) BETWEEN CAST(a.day AS DATE) - 6 AND CAST(a.day AS DATE) GROUP BY ALL")
def _(t: Tables):
    return M.rolling_distinct(daily(t), 7)


@query("seen_on_both_days", f"WITH {EVENTS_CTE} SELECT event_type AS kind, count(*) AS both FROM (SELECT event_type, user_id FROM ev WHERE day = '2024-01-14' INTERSECT SELECT event_type, user_id FROM ev WHERE day = '2024-01-16') GROUP BY event_type")
def _(t: Tables):
    both = M.seen_on_both(daily(t), "2024-01-14", "2024-01-16")
    return both.where("both > 0")
