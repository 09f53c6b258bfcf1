"""Top-N, item lists, item sets, shares and ordered outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baskets as K
from ..operators import ranking as R
from ..sinks.writers import publish_topn
from .registry import Tables, query, r
from .stand_ins import EVENTS_CTE, events

ITEMS = "l_partkey"


@query("top_items", "SELECT l_partkey AS item, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY cnt DESC, item LIMIT 1000")
def _(t: Tables):
    return R.top_items(t.lineitem.select(F.col("l_partkey").alias("item")), "item", 1000)


@query("top_items_by_group", "SELECT grp, item, cnt, rn FROM (SELECT l_suppkey AS grp, l_partkey AS item, count(*) AS cnt, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn <= 100")
def _(t: Tables):
    return R.top_items_by(t.lineitem.select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("item")), "grp", "item", 100)


@query("top_spenders_per_day", f"WITH {EVENTS_CTE} SELECT day, user_id, {r('v')} AS v FROM (SELECT day, user_id, sum(value) AS v, row_number() OVER (PARTITION BY day ORDER BY sum(value) DESC, user_id) AS rn FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2) WHERE rn <= 3")
def _(t: Tables):
    spent = events(t).where("event_type = 'purchase'").groupBy("day", "user_id").agg(F.sum("value").alias("v"))
    return R.topn_per_group(spent, ["day"], [F.desc("v"), F.asc("user_id")], 3)


@query("published_lists", "SELECT 'TopN:' || grp AS key, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rn) AS items FROM (SELECT l_suppkey AS grp, l_partkey AS item, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) AS rn FROM lineitem GROUP BY l_suppkey, l_partkey) WHERE rn <= 10 GROUP BY grp")
def _(t: Tables):
    top = R.top_items_by(t.lineitem.select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("item")), "grp", "item", 100)
    return publish_topn(top, "grp", "item", "rn", 10)


@query("share_of_group", f"WITH {EVENTS_CTE} SELECT user_id, event_type, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY user_id)')} AS share FROM ev GROUP BY user_id, event_type")
def _(t: Tables):
    return R.share_of_total(R.count_by_key(events(t), ["user_id", "event_type"], "n"), "n", ["user_id"], "share")


@query("share_of_wide_group", f"WITH {EVENTS_CTE} SELECT day, user_id, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY day)')} AS share FROM ev GROUP BY day, user_id")
def _(t: Tables):
    return R.share_of_total(R.count_by_key(events(t), ["day", "user_id"], "n"), "n", ["day"], "share", wide=True)


@query("share_of_all", f"WITH {EVENTS_CTE} SELECT event_type, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM ev GROUP BY ALL")
def _(t: Tables):
    return R.share_of_total(R.count_by_key(events(t), ["event_type"], "n"), "n", [], "share")


@query("deduplicated_rows", "SELECT c_nationkey, c_mktsegment, min(c_custkey) AS c_custkey FROM customer GROUP BY ALL".replace("SELECT c_nationkey", "SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey"))
def _(t: Tables):
    return R.drop_duplicate_rows(t.customer.select("c_nationkey", "c_mktsegment", "c_custkey"), ["c_nationkey", "c_mktsegment"])


@query("distinct_packages", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


@query("counts_in_order", f"WITH {EVENTS_CTE} SELECT event_type, count(*) AS cnt FROM ev GROUP BY event_type ORDER BY cnt DESC, event_type")
def _(t: Tables):
    return R.count_by_key(events(t), ["event_type"]).orderBy(F.desc("cnt"), F.asc("event_type"))


@query("hits_and_users", "SELECT o_orderpriority, count(*) AS hits, count(DISTINCT o_custkey) AS users FROM orders GROUP BY 1")
def _(t: Tables):
    return K.top_overlap(t.orders, ["o_orderpriority"], "o_custkey")


BASKET = "SELECT DISTINCT {g}user_id, k AS item FROM ev WHERE event_type = 'click'"


@query("cookie_items", f"""WITH {EVENTS_CTE} SELECT user_id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items, count(*) AS n_items FROM ({BASKET.format(g='')}) GROUP BY user_id HAVING count(*) BETWEEN 2 AND 14""")
def _(t: Tables):
    clicks = events(t).where("event_type = 'click'").select("user_id", F.col("k").alias("item"))
    return K.cookie_items(clicks, "user_id", "item", hi=14)


@query("cookie_items_by_group", f"""WITH {EVENTS_CTE} SELECT grp, user_id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items, count(*) AS n_items FROM ({BASKET.format(g="'g' || (k % 3) AS grp, ")}) GROUP BY grp, user_id HAVING count(*) BETWEEN 2 AND 5""")
def _(t: Tables):
    clicks = events(t).where("event_type = 'click'").select(F.concat(F.lit("g"), F.col("k") % 3).alias("grp"), "user_id", F.col("k").alias("item"))
    return K.cookie_items(clicks, "user_id", "item", "grp", hi=5)


@query("users_per_item", f"""WITH {EVENTS_CTE}, n AS (SELECT k, count(DISTINCT user_id) AS n FROM ev GROUP BY k) SELECT max(n) AS max_cnt, min(n) AS min_cnt, {r('avg(n)')} AS avg_cnt, {r('quantile_cont(n, 0.5)')} AS mid_cnt FROM n""")
def _(t: Tables):
    return K.users_per_item_stats(events(t), "k", "user_id")


@query("extreme_items", f"""WITH {EVENTS_CTE}, n AS (SELECT k, count(*) AS n FROM ev GROUP BY k)
SELECT (SELECT k FROM n ORDER BY n DESC, k LIMIT 1) AS max_item, (SELECT max(n) FROM n) AS max_cnt, (SELECT k FROM n ORDER BY n, k LIMIT 1) AS min_item, (SELECT min(n) FROM n) AS min_cnt""")
def _(t: Tables):
    return K.extreme_items(events(t), "k")


BRANDS_CTE = "b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT count(DISTINCT o) AS n FROM b)"
SUPPORT = 0.01


def brand_baskets(t: Tables):
    """Distinct brands per order, an order having a handful of lines."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o"), F.col("p_brand").alias("i"))
    return K.cookie_items(rows, "o", "i", lo=1, hi=None, as_text=False)


ITEM_SETS_SQL = f"""WITH {BRANDS_CTE}, s AS (SELECT i AS items, count(*) AS freq FROM b GROUP BY i
  UNION ALL SELECT x.i || ',' || y.i, count(*) FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY 1
  UNION ALL SELECT x.i || ',' || y.i || ',' || z.i, count(*) FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON x.o = z.o AND y.i < z.i GROUP BY 1)
SELECT items, freq FROM s, n WHERE freq >= ceil(n * {SUPPORT})"""


@query("frequent_item_sets", ITEM_SETS_SQL)
def _(t: Tables):
    sets, _ = K.freq_itemsets(brand_baskets(t), "items", SUPPORT)
    return sets.select(F.concat_ws(",", F.sort_array("items")).alias("items"), "freq")


@query("apriori_item_sets", ITEM_SETS_SQL)
def _(t: Tables):
    sets = K.apriori(brand_baskets(t), "items", SUPPORT, longest=3)
    return sets.select(F.concat_ws(",", "items").alias("items"), "freq")


@query("association_rules", f"""WITH {BRANDS_CTE}, one AS (SELECT i AS a, count(*) AS f FROM b GROUP BY i), two AS (SELECT x.i AS p, y.i AS q, count(*) AS f FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY 1, 2),
three AS (SELECT x.i AS p, y.i AS q, z.i AS s, count(*) AS f FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON x.o = z.o AND y.i < z.i GROUP BY 1, 2, 3),
sets AS (SELECT a, f FROM one UNION ALL SELECT p || ',' || q, f FROM two),
parts AS (SELECT p AS a, q AS c, f FROM two UNION ALL SELECT q, p, f FROM two UNION ALL SELECT p || ',' || q, s, f FROM three UNION ALL SELECT p || ',' || s, q, f FROM three UNION ALL SELECT q || ',' || s, p, f FROM three)
SELECT parts.a AS antecedent, c AS consequent, {r('parts.f / sets.f')} AS confidence, {r('CAST(parts.f AS DOUBLE) / n')} AS support FROM parts JOIN sets ON parts.a = sets.a, n WHERE parts.f >= ceil(n * {SUPPORT}) AND parts.f / sets.f >= 0.1""")
def _(t: Tables):
    _, rules = K.freq_itemsets(brand_baskets(t), "items", SUPPORT, 0.1)
    return rules.select(F.concat_ws(",", F.sort_array("antecedent")).alias("antecedent"), F.concat_ws(",", "consequent").alias("consequent"), "confidence", "support")
