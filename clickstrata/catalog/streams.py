"""Streaming queries: the given files read as a stream until exhausted, the stored result read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import differences as D
from ..streaming import enrich as E
from ..streaming import orders as O
from ..streaming import run as U
from ..streaming import timers as K
from ..streaming import windows as W
from .registry import Tables, query
from .stand_ins import EVENTS_CTE, events


def event_stream(t: Tables):
    """``events`` as a file stream with a zoned event time."""
    stream = U.read_files(t.spark, f"{t.path}/events.parquet", t.events.schema)
    return stream.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def static_events(t: Tables):
    return events(t).withColumn("ts", F.col("ts").cast("timestamp"))


def stored(t: Tables, label: str):
    base = scratch_path(t.spark, label)
    return f"{base}/out", f"{base}/checkpoint"


TS = "strftime({c}, '%Y-%m-%d %H:%M:%S')"
PV_SQL = f"WITH {EVENTS_CTE} SELECT {TS.format(c='date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS window_start, event_type, count(*) AS pv FROM ev GROUP BY ALL"


@query("tumbling_page_views", PV_SQL)
def _(t: Tables):
    return W.tumbling_pv(static_events(t), "ts", ["event_type"]).select("window_start", "event_type", "pv")


@query("tumbling_page_views_stream", PV_SQL)
def _(t: Tables):
    out, checkpoint = stored(t, "pv")
    counts = W.tumbling_pv(event_stream(t), "ts", ["event_type"], delay="2 minutes 5 seconds")
    U.run_stream(counts, U.change_log_sink(out), checkpoint, "update")
    return U.read_change_log(t.spark, out, ["window_start", "window_end", "event_type"], like=counts).select("window_start", "event_type", "pv")


def pane_log(t: Tables, label: str, stream, keys: list[str], slide: str, delay: str):
    """The stream's pane counts, run to the end and read back."""
    out, checkpoint = stored(t, label)
    panes = W.pane_counts(stream, "ts", keys, slide, delay)
    U.run_stream(panes, U.change_log_sink(out), checkpoint, "update")
    return U.read_change_log(t.spark, out, ["pane_start", *keys], like=panes)


def slid(size_days: int, slide_days: int) -> str:
    """CTE ``sw``: every event once per sliding window (start day s) that holds it."""
    return f"sw AS (SELECT ev.*, date_trunc('day', ts) - INTERVAL (i) DAY AS s, date_trunc('day', ts) - INTERVAL (i) DAY + INTERVAL {size_days} DAY AS e FROM ev, range(0, {size_days}, {slide_days}) t(i))"


BLACK_SQL = f"WITH {EVENTS_CTE}, {slid(7, 1)} SELECT {TS.format(c='s')} AS window_start, user_id, count(*) AS n, 'bl:ip:' || user_id AS list_key FROM sw WHERE event_type = 'error' {{cond}} GROUP BY s, e, user_id HAVING count(*) >= 4"


@query("sliding_blacklist", BLACK_SQL.format(cond=""))
def _(t: Tables):
    errors = static_events(t).where("event_type = 'error'")
    return W.sliding_blacklist(errors, "ts", "user_id").select("window_start", "user_id", "n", "list_key")


@query("sliding_blacklist_stream", BLACK_SQL.format(cond=""))
def _(t: Tables):
    panes = pane_log(t, "blacklist", event_stream(t).where("event_type = 'error'"), ["user_id"], "1 day", "15 seconds")
    return W.blacklisted(W.slide_panes(panes, ["user_id"], "7 days", "1 day"), "user_id").select("window_start", "user_id", "n", "list_key")


def topn_sql(cond: str) -> str:
    hours = "sw AS (SELECT ev.*, date_trunc('hour', ts) - INTERVAL (i) HOUR AS s, date_trunc('hour', ts) - INTERVAL (i) HOUR + INTERVAL 2 HOUR AS e FROM ev, range(0, 2) t(i))"
    return f"""WITH {EVENTS_CTE}, {hours}, c AS (SELECT s, k, count(*) AS n FROM sw WHERE true {cond} GROUP BY s, k), q AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, k) AS rn FROM c)
SELECT {TS.format(c='s')} AS window_start, k, n, rn FROM q WHERE rn <= 10"""


@query("sliding_top_items", topn_sql(""))
def _(t: Tables):
    return W.sliding_topn(static_events(t), "ts", "k", "2 hours", "1 hour", 10).select("window_start", "k", "n", "rn")


@query("sliding_top_items_stream", topn_sql(""))
def _(t: Tables):
    panes = pane_log(t, "topn", event_stream(t), ["k"], "1 hour", "2 seconds")
    return W.rank_windows(W.slide_panes(panes, ["k"], "2 hours", "1 hour"), "k", 10).select("window_start", "k", "n", "rn")


def trending_sql(cond: str, per_channel: bool) -> str:
    part, cols, n = ("s, event_type", "s, event_type, k", 5) if per_channel else ("s", "s, k", 20)
    hours = "sw AS (SELECT ev.*, date_trunc('hour', ts) - INTERVAL (i) HOUR AS s, date_trunc('hour', ts) - INTERVAL (i) HOUR + INTERVAL 2 HOUR AS e FROM ev, range(0, 2) t(i))"
    out = "event_type, k" if per_channel else "k"
    return f"WITH {EVENTS_CTE}, {hours}, c AS (SELECT {cols}, count(*) AS n FROM sw WHERE true {cond} GROUP BY ALL), q AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY n DESC, k) AS rn FROM c) SELECT {TS.format(c='s')} AS window_start, {out}, n, rn FROM q WHERE rn <= {n}"


@query("trending_per_channel", trending_sql("", True))
def _(t: Tables):
    counts = W.trending_counts(static_events(t), "ts", "event_type", "k", "120 minutes", "60 minutes")
    return W.trending(counts, "event_type", "k", 5, 20)[0].select("window_start", "event_type", "k", "n", "rn")


@query("trending_overall_stream", trending_sql("", False))
def _(t: Tables):
    panes = pane_log(t, "trending", event_stream(t), ["event_type", "k"], "60 minutes", "2 seconds")
    counts = W.slide_panes(panes, ["event_type", "k"], "120 minutes", "60 minutes")
    return W.trending(counts, "event_type", "k", 5, 20)[1].select("window_start", "k", "n", "rn")


def changes_sql(size: int, slide: int, n: int, group: str | None = None) -> str:
    """Rankings of windows of ``size`` seconds by ``slide``, told where a count changes and where a part of ``size`` seconds ends."""
    g = f"{group}, " if group else ""
    same = f" AND x.{group} = y.{group}" if group else ""
    ox = f"x.{group}, " if group else ""
    return f"""WITH {EVENTS_CTE}, pn AS (SELECT {g}k, sec // {slide} * {slide} - {size - slide} AS enters, sec // {slide} * {slide} + {slide} AS leaves, count(*) AS n FROM ev GROUP BY ALL),
pt AS (SELECT *, unnest(range(enters // {size}, (leaves - 1) // {size} + 1)) AS part FROM pn),
df AS (SELECT part, {g}w FROM (SELECT part, {g}k, greatest(enters, part * {size}) AS w, n FROM pt UNION ALL SELECT part, {g}k, least(leaves, (part + 1) * {size}), -n FROM pt) GROUP BY part, {g}k, w HAVING sum(n) <> 0),
nx AS (SELECT {g}w, lead(w) OVER (PARTITION BY part{', ' + group if group else ''} ORDER BY w) AS until FROM (SELECT DISTINCT * FROM df)),
ct AS (SELECT {ox}w, until, k, CAST(sum(n) AS BIGINT) AS n FROM nx x JOIN pn y ON y.enters <= x.w AND x.w < y.leaves{same} WHERE until IS NOT NULL GROUP BY ALL)
SELECT strftime(make_timestamp(w * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, (until - w) // {slide} AS windows, {g}k, n, row_number() OVER (PARTITION BY {g}w ORDER BY n DESC, k) AS rn FROM ct QUALIFY rn <= {n}"""


@query("sliding_top_items_5s", changes_sql(7200, 5, 10))
def _(t: Tables):
    return D.top_by_changes(W.pane_counts(static_events(t), "ts", ["k"], "5 seconds"), "k", "2 hours", "5 seconds", 10)


@query("sliding_top_items_5s_stream", changes_sql(7200, 5, 10))
def _(t: Tables):
    panes = pane_log(t, "topn-5s", event_stream(t), ["k"], "5 seconds", "2 seconds")
    return D.top_by_changes(panes, "k", "2 hours", "5 seconds", 10)


@query("trending_per_channel_minutes", changes_sql(7200, 60, 100, "event_type"))
def _(t: Tables):
    panes = W.pane_counts(static_events(t), "ts", ["event_type", "k"], "1 minute")
    return D.top_by_changes(panes, "k", "120 minutes", "1 minute", 100, ["event_type"])


@query("trending_overall_minutes_stream", changes_sql(7200, 60, 1000))
def _(t: Tables):
    panes = pane_log(t, "trending-minutes", event_stream(t), ["event_type", "k"], "1 minute", "2 seconds")
    return D.top_by_changes(panes.groupBy("pane_start", "k").agg(F.sum("n").alias("n")), "k", "120 minutes", "1 minute", 1000)


COUNTERS_SQL = f"""WITH {EVENTS_CTE} SELECT day, user_id, {', '.join(f"count(*) FILTER (WHERE k % 4 = {c}) AS {n}" for n, c in W.DELIVERY_EVENTS.items())} FROM ev GROUP BY ALL"""


def delivery(df):
    return df.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", (F.col("k") % 4).cast("string").alias("event"))


@query("event_counters", COUNTERS_SQL)
def _(t: Tables):
    return W.event_counters(delivery(static_events(t)), ["day", "user_id"])


@query("event_counters_stream", COUNTERS_SQL)
def _(t: Tables):
    out, checkpoint = stored(t, "counters")
    sink = U.change_log_sink(out, lambda batch: W.event_counters(batch, ["day", "user_id"]))
    U.run_stream(delivery(event_stream(t)), sink, checkpoint)
    return U.read_change_log(t.spark, out, ["day", "user_id"], default="add", like=W.event_counters(delivery(static_events(t)), ["day", "user_id"]))


WORDS_SQL = "SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split_regex(trim(text, E' \\t\\n\\r'), '[ \\t\\n\\r\\f\\v]+')) AS word FROM conversations) WHERE word <> '' GROUP BY word"


@query("running_word_count_stream", WORDS_SQL)
def _(t: Tables):
    out, checkpoint = stored(t, "words")
    lines = U.read_files(t.spark, f"{t.path}/conversations.parquet", t.conversations.schema)
    counts = W.running_count(W.words(lines, "text"), ["word"])
    U.run_stream(counts, U.change_log_sink(out), checkpoint, "update")
    return U.read_change_log(t.spark, out, ["word"], like=counts)


@query("batch_word_count", WORDS_SQL)
def _(t: Tables):
    return W.running_count(W.words(t.conversations, "text"), ["word"])


@query("join_streams_by_user", f"WITH {EVENTS_CTE} SELECT v.event_id AS view_id, c.event_id AS click_id FROM ev v JOIN ev c ON v.user_id = c.user_id AND v.event_type = 'view' AND c.event_type = 'click' AND c.ts BETWEEN v.ts - INTERVAL 30 MINUTE AND v.ts + INTERVAL 30 MINUTE")
def _(t: Tables):
    out, checkpoint = stored(t, "join")
    views = event_stream(t).where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
    clicks = event_stream(t).where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), "ts")
    joined = W.join_streams(views, clicks, "user_id", "ts", "ts", "30 minutes")
    U.run_stream(joined, U.change_log_sink(out), checkpoint)
    return U.open_change_log(t.spark, out, joined).select("view_id", "click_id")


# Purchases take a click of the same id, which several clicks share: the latest before them, else the first after.
WAIT_CTE = EVENTS_CTE + """, od AS (SELECT event_id AS order_id, 'c' || (event_id // 6) AS click_id, ts, CASE WHEN k % 10 = 0 THEN 'own' END AS plan_id FROM ev WHERE event_type = 'purchase'),
cl AS (SELECT 'c' || (event_id // 6) AS click_id, ts, CASE WHEN k % 4 > 0 THEN 'p' || k END AS plan_id, CASE WHEN k % 4 <> 1 THEN 'm' || k END AS creative_id FROM ev WHERE event_type = 'click')"""
WAIT_SQL = f"""WITH {WAIT_CTE}, pr AS (SELECT order_id, coalesce(od.plan_id, cl.plan_id) AS plan_id, cl.creative_id, row_number() OVER (PARTITION BY order_id ORDER BY cl.ts > od.ts, abs(epoch(cl.ts) - epoch(od.ts)), cl.plan_id NULLS FIRST, cl.creative_id NULLS FIRST) AS rn
FROM od LEFT JOIN cl ON od.plan_id IS NULL AND od.click_id = cl.click_id AND (cl.plan_id IS NOT NULL OR cl.creative_id IS NOT NULL) AND cl.ts BETWEEN od.ts - INTERVAL 20 MINUTE AND od.ts + INTERVAL 20 MINUTE)
SELECT order_id, plan_id, creative_id FROM pr WHERE rn = 1"""


def orders_and_clicks(df):
    k, shared = F.col("k"), F.concat(F.lit("c"), F.floor(F.col("event_id") / 6))
    orders = df.where("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), shared.alias("click_id"), "ts", F.when(k % 10 == 0, "own").alias("plan_id"), F.lit(None).cast("string").alias("creative_id")
    )
    clicks = df.where("event_type = 'click'").select(
        shared.alias("click_id"), "ts", F.when(k % 4 > 0, F.concat(F.lit("p"), k)).alias("plan_id"), F.when(k % 4 != 1, F.concat(F.lit("m"), k)).alias("creative_id")
    )
    return orders, clicks


@query("click_order_enrich", WAIT_SQL)
def _(t: Tables):
    return E.enrich_orders(*orders_and_clicks(static_events(t))).select("order_id", "plan_id", "creative_id")


@query("click_order_enrich_stream", WAIT_SQL)
def _(t: Tables):
    out, checkpoint = stored(t, "enrich")
    orders, _ = orders_and_clicks(event_stream(t))
    _, clicks = orders_and_clicks(event_stream(t))
    log = E.click_order_enrich(orders, clicks)
    U.run_stream(log, U.change_log_sink(out), checkpoint)
    return E.settled_orders(U.open_change_log(t.spark, out, log)).select("order_id", "plan_id", "creative_id")


def run_with_ticks(t: Tables, label: str, made):
    """Runs the stream ``made(ticks)`` to the end of the tables; then time goes on, and the query with it from its checkpoint."""
    out, checkpoint = stored(t, label)
    pause = scratch_path(t.spark, f"{label}-ticks")
    for tick in (t.spark.sql("SELECT timestamp'1970-01-01 00:00:00Z' AS ts"), static_events(t).agg((F.max("ts") + F.expr("interval 2 hours")).alias("ts"))):
        tick.coalesce(1).write.mode("append").parquet(pause)
        stream = made(U.read_files(t.spark, pause, "ts timestamp"))
        with K.rocksdb_state(t.spark):
            U.run_stream(stream, U.change_log_sink(out), checkpoint)
    return U.open_change_log(t.spark, out, stream)


@query("click_order_timers_stream", WAIT_SQL)
def _(t: Tables):
    def made(ticks):
        return K.orders_on_time(orders_and_clicks(event_stream(t))[0], orders_and_clicks(event_stream(t))[1], ticks=ticks)

    return run_with_ticks(t, "timers", made).select("order_id", "plan_id", "creative_id")


@query("latest_view_per_click_stream", f"""WITH {EVENTS_CTE} SELECT c.event_id AS click_id, v.event_id AS view_id FROM ev c LEFT JOIN ev v ON v.user_id = c.user_id AND v.event_type = 'view' AND v.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts
WHERE c.event_type = 'click' QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id) = 1""")
def _(t: Tables):
    def made(ticks):
        side = lambda kind, name: event_stream(t).where(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name), "ts")
        return K.latest_before(side("click", "click_id"), side("view", "view_id"), "user_id", "ts", "ts", ["view_id"], "30 minutes", ticks=ticks)

    return run_with_ticks(t, "latest", made).select("click_id", "view_id")


LINES_CTE = EVENTS_CTE + ", ol AS (SELECT event_id, sec, user_id, k, event_type FROM ev)"


def order_lines(t: Tables):
    """Tab lines of the order stream: orders for purchases, details for signups, clicks for clicks, visits for views."""
    e = events(t)
    u, k = F.col("user_id").cast("string"), F.col("k")

    def line(code: str, n: int, **fields):
        by_pos = {int(p[1:]): v for p, v in fields.items()}
        cols = [F.lit(code) if i == 0 else F.col("sec").cast("string") if i == 1 else by_pos.get(i, F.lit("")) for i in range(n)]
        return F.concat_ws("\t", *cols)

    order = line("316", 48, f3=F.when(k % 9 > 0, F.concat(F.lit("o"), F.col("event_id"))).otherwise(""), f12=F.when(k % 3 == 0, F.concat(F.lit("p"), k)).otherwise(""), f24=F.concat(F.lit("10.0.0."), u), f37=F.concat(F.lit("c"), u))
    detail = line("317", 19, f2=F.concat(F.lit("o"), u), f4=F.when(k % 2 == 0, "AC002").otherwise("AC001"), f7=F.when(k % 5 == 0, "10").otherwise("20"), f11=F.when(k % 3 == 0, "1").otherwise("0"), f17=F.lit("2024-03-03 00:00:00"), f18=F.when(k % 4 == 0, "1").otherwise("2"))
    click = line("319", 23, f9=F.when(k % 6 > 0, F.concat(F.lit("c"), u)).otherwise(""), f11=F.when(k % 5 > 0, F.concat(F.lit("p"), k)).otherwise(""))
    visit = line("314", 34, f2=F.concat(F.lit("s"), k % 3), f3=F.lit("ok"), f4=F.concat(F.lit("t"), k % 5), f33=F.lit("1"))
    kind = F.col("event_type")
    return e.select(F.when(kind == "purchase", order).when(kind == "signup", detail).when(kind == "click", click).when(kind == "view", visit).otherwise("bad line").alias("value"))


@query("order_lines", f"WITH {LINES_CTE} SELECT 'o' || event_id AS order_id, sec AS time, CASE WHEN k % 3 = 0 THEN 'p' || k END AS plan_id, '10.0.0.' || user_id AS ip, 'c' || user_id AS click_id FROM ol WHERE event_type = 'purchase' AND k % 9 > 0")
def _(t: Tables):
    return O.parse_orders(order_lines(t)).select("order_id", "time", "plan_id", "ip", "click_id")


@query("order_detail_lines", f"""WITH {LINES_CTE}, x AS (SELECT *, strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') AS w FROM ol WHERE event_type = 'signup') SELECT 'o' || user_id AS order_id,
 CASE WHEN k % 4 = 0 THEN '2024-03-03 00:00:00' WHEN k % 2 = 0 THEN w END AS active_time, CASE WHEN k % 3 = 0 THEN w END AS invest_time, CASE WHEN k % 5 = 0 THEN w END AS sign_time FROM x""")
def _(t: Tables):
    return O.parse_details(order_lines(t)).select("order_id", "active_time", "invest_time", "sign_time")


@query("click_lines", f"WITH {LINES_CTE} SELECT 'c' || user_id AS click_id, 'p' || k AS plan_id FROM ol WHERE event_type = 'click' AND k % 6 > 0 AND k % 5 > 0")
def _(t: Tables):
    return O.parse_clicks(order_lines(t)).select("click_id", "plan_id")


@query("visit_lines_per_hour", f"WITH {LINES_CTE} SELECT strftime(date_trunc('hour', make_timestamp(sec * 1000000)), '%Y-%m-%d %H') AS hour, 't' || (k % 5) AS template_id, 's' || (k % 3) AS code, 'ok' AS msg, '1' AS carrier, count(*) AS pv FROM ol WHERE event_type = 'view' GROUP BY ALL")
def _(t: Tables):
    return W.tumbling_pv(O.parse_visits(order_lines(t)), "ts").drop("window_start", "window_end")


@query("blank_preserving_updates", f"""WITH {EVENTS_CTE} SELECT user_id, (list(event_type ORDER BY event_id DESC) FILTER (WHERE event_type <> 'error'))[1] AS status, (list('n' || k ORDER BY event_id DESC) FILTER (WHERE k % 5 = 0))[1] AS note, max(event_id) AS event_id FROM ev GROUP BY user_id""")
def _(t: Tables):
    from ..sinks.snapshots import merge_rows

    rows = events(t).select("user_id", "event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("status"), F.when(F.col("k") % 5 == 0, F.concat(F.lit("n"), F.col("k"))).alias("note"))
    middle = F.col("event_id") < 5000
    first, second = (O.blank_preserving_updates(rows.where(c), "user_id", "event_id") for c in (middle, ~middle))
    return merge_rows(first, second, ["user_id"], default="keep_blank")
