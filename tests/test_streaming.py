"""Streams fed file by file, against their batch twins and hand-made cases."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from clickstrata.sinks.snapshots import read_snapshot
from clickstrata.streaming import enrich as E
from clickstrata.streaming import orders as O
from clickstrata.streaming import run as U
from clickstrata.streaming import windows as W

BASE = dt.datetime(2024, 1, 1)


def feed(spark, path, batches, schema):
    """Write each batch as one file, in modification order, and open them as a one-file-per-batch stream."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(path))
    return U.read_files(spark, str(path), schema, max_files=1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


EVENT = "ts timestamp, key string, item string"


def test_tumbling_stream_equals_batch_with_late_rows(spark, rows, tmp_path, out):
    rnd = random.Random(5)
    batches = [[(at(3600 * b + rnd.randrange(-100, 3600)), f"k{rnd.randrange(3)}", "i") for _ in range(40)] for b in range(1, 5)]
    stream = feed(spark, tmp_path / "in", batches, EVENT)
    U.run_stream(W.tumbling_counts(stream, "ts", ["key"], "1 hour", "2 minutes 5 seconds"), U.change_log_sink(out[0]), out[1], "update")
    got = U.read_change_log(spark, out[0], ["window_start", "window_end", "key"])
    want = W.tumbling_counts(spark.read.parquet(str(tmp_path / "in")), "ts", ["key"])
    assert rows(got, "window_start", "key", "n") == rows(want, "window_start", "key", "n")


def test_sliding_counts_by_panes_equal_plain_windows(spark, rows):
    rnd = random.Random(6)
    df = spark.createDataFrame([(at(rnd.randrange(40_000)), f"k{rnd.randrange(3)}", "i") for _ in range(300)], EVENT)
    plain = df.groupBy(F.window("ts", "2 hours", "10 minutes").alias("w"), "key").count().select(F.col("w.start").alias("window_start"), "key", F.col("count").alias("n"))
    assert rows(W.sliding_counts(df, "ts", ["key"], "2 hours", "10 minutes"), "window_start", "key", "n") == rows(plain)


def test_blacklist_threshold(spark, rows):
    data = [(at(86400 * d), "listed", "i") for d in (0, 1, 2, 6)] + [(at(86400 * d), "free", "i") for d in (0, 1, 2)]
    got = W.sliding_blacklist(spark.createDataFrame(data, EVENT), "ts", "key")
    assert rows(got, "key", "n", "list_key") == [("listed", 4, "bl:ip:listed")]


def test_top_items_stream_ranks_closed_windows(spark, rows, tmp_path, out):
    rnd = random.Random(7)
    batches = [[(at(600 * b + rnd.randrange(600)), "c", f"i{rnd.randrange(6)}") for _ in range(60)] for b in range(4)]
    stream = feed(spark, tmp_path / "in", batches, EVENT)
    counts = W.sliding_counts(stream, "ts", ["item"], "10 minutes", "5 minutes", delay="0 seconds")
    U.run_stream(counts, U.change_log_sink(out[0], lambda b: W.rank_windows(b, "item", 2)), out[1])
    static = spark.read.parquet(str(tmp_path / "in"))
    last = static.agg(F.max("ts")).first()[0]
    want = W.sliding_topn(static, "ts", "item", "10 minutes", "5 minutes", 2).where(F.col("window_end") <= F.lit(last))
    assert rows(spark.read.parquet(out[0]), "window_start", "item", "n", "rn") == rows(want, "window_start", "item", "n", "rn")


ORDER = "order_id string, click_id string, ts timestamp, plan_id string, creative_id string"
CLICK = "click_id string, ts timestamp, plan_id string, creative_id string"


def test_orders_meet_clicks_in_either_order(spark, rows, tmp_path, out):
    m = 60
    orders = [
        [("late-click", "c1", at(0), None, None), ("has-plan", "c9", at(10), "p0", None), ("no-click-id", None, at(20), None, None), ("too-late", "c2", at(30), None, None)],
        [("click-first", "c3", at(30 * m), None, None)], [("closer", None, at(300 * m), None, None)], [("end", "zz", at(400 * m), None, None)],
    ]
    clicks = [[("c3", at(25 * m), "p3", "k3"), ("c9", at(5), "p9", "k9")], [("c1", at(5 * m), "p1", "k1"), ("c1", at(6 * m), "dup", "dup"), ("c2", at(21 * m), "p2", "k2"), ("c5", at(9), "", None)],
              [("x", at(300 * m), "p", "k")], [("y", at(400 * m), "p", "k")]]
    o = feed(spark, tmp_path / "o", orders, ORDER)
    c = feed(spark, tmp_path / "c", clicks, CLICK)
    U.run_stream(E.click_order_enrich(o, c), U.change_log_sink(out[0]), out[1])
    settled = E.settled_orders(spark.read.parquet(out[0]))
    assert settled.columns == o.columns
    got = {r.order_id: (r.plan_id, r.creative_id) for r in settled.collect()}
    want = {"late-click": ("p1", "k1"), "has-plan": ("p0", None), "no-click-id": (None, None), "too-late": (None, None), "click-first": ("p3", "k3"), "closer": (None, None), "end": (None, None)}
    # No order waits: those without a click are in the log as they came.
    assert got == want
    batch = E.enrich_orders(spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "c")))
    assert {r.order_id: (r.plan_id, r.creative_id) for r in batch.collect()} == want


@pytest.mark.parametrize(("clicks", "order", "plan"), [((0, 15), 34, "p15"), ((0, 15), 10, "p0"), ((0, 15), 15, "p15"), ((30, 25), 10, "p25"), ((5, 9), 40, None), ((0,), 20, "p0")])
def test_an_order_takes_the_latest_click_before_it_else_the_first_after(spark, tmp_path, out, clicks, order, plan):
    made = [[("c", at(60 * m), f"p{m}", None)] for m in clicks]
    o = feed(spark, tmp_path / "o", [[("o", "c", at(60 * order), None, None)]], ORDER)
    c = feed(spark, tmp_path / "c", made, CLICK)
    U.run_stream(E.click_order_enrich(o, c, delay="1 hour"), U.change_log_sink(out[0]), out[1])
    assert [r.plan_id for r in E.settled_orders(spark.read.parquet(out[0])).collect()] == [plan]
    assert [r.plan_id for r in E.enrich_orders(spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "c"))).collect()] == [plan]


def test_late_halves_meet_at_the_default_delay(spark, tmp_path, out):
    far = [("zz", at(60 * 30), "p", "k")]
    orders = [[("click-late", "c", at(60 * 24), None, None), ("far", None, at(60 * 30), None, None)], [("none", None, at(60 * 30), None, None)], [("none2", None, at(60 * 30), None, None)], [("order-late", "d", at(60 * 11), None, None)]]
    clicks = [[*far, ("d", at(60 * 12), "pd", "kd")], far, far, [("c", at(60 * 25), "pc", "kc")]]
    o = feed(spark, tmp_path / "o", orders, ORDER)
    c = feed(spark, tmp_path / "c", clicks, CLICK)
    U.run_stream(E.click_order_enrich(o, c), U.change_log_sink(out[0]), out[1])
    got = {r.order_id: r.plan_id for r in E.settled_orders(spark.read.parquet(out[0])).collect()}
    assert got == {"click-late": "pc", "order-late": "pd", "far": None, "none": None, "none2": None}


@pytest.mark.parametrize(("size", "slide", "n"), [("2 hours", "5 seconds", 10), ("120 minutes", "1 minute", 100), ("120 minutes", "1 minute", 1000)])
def test_panes_give_every_window_also_open_ones(spark, rows, tmp_path, out, size, slide, n):
    rnd = random.Random(9)
    batches = [[(at(400 * b + rnd.randrange(400)), "c", f"i{rnd.randrange(6)}") for _ in range(3)] for b in range(2)]
    stream = feed(spark, tmp_path / "in", batches, EVENT)
    panes = W.pane_counts(stream, "ts", ["item"], slide, delay="10 minutes")
    U.run_stream(panes, U.change_log_sink(out[0]), out[1], "update")
    read = U.read_change_log(spark, out[0], ["pane_start", "item"])
    got = W.rank_windows(W.slide_panes(read, ["item"], size, slide), "item", n)
    static = spark.read.parquet(str(tmp_path / "in"))
    plain = static.groupBy(F.window("ts", size, slide).alias("w"), "item").count().selectExpr("w.start as window_start", "item", "count as n")
    assert rows(got, "window_start", "item", "n") == rows(plain, "window_start", "item", "n")
    assert "WindowGroupLimit" in got._jdf.queryExecution().optimizedPlan().toString()


def test_streams_read_tables_stored_as_folders(spark, rows, tmp_path):
    from clickstrata import catalog

    source = "/root/testdata/sf0.001/events.parquet"
    if not os.path.exists(source):
        pytest.skip("tables not present")
    spark.read.parquet(source).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    queries = catalog.queries()
    for stream, static in (("tumbling_page_views_stream", "tumbling_page_views"), ("sliding_top_items_stream", "sliding_top_items")):
        assert rows(queries[stream](spark, str(tmp_path))) == rows(queries[static](spark, str(tmp_path))) != []


def test_a_change_log_without_a_batch_is_empty(spark, tmp_path):
    like = spark.createDataFrame([], "key string, n bigint")
    assert U.read_change_log(spark, str(tmp_path / "none"), ["key"], like=like).collect() == []


def test_joined_streams_meet_across_cells(spark, rows, tmp_path, out):
    left = [("u", at(60 * m), f"l{m}") for m in (0, 29, 31, 60, 95)]
    right = [("u", at(60 * m), f"r{m}") for m in (0, 30, 59, 61, 125)]
    l = feed(spark, tmp_path / "l", [left], "user string, ts timestamp, lid string")
    r = feed(spark, tmp_path / "r", [right], "user string, ts timestamp, rid string")
    U.run_stream(W.join_streams(l, r, "user", "ts", "ts", "30 minutes", delay="3 hours"), U.change_log_sink(out[0]), out[1])
    want = sorted((a[2], b[2]) for a in left for b in right if abs((a[1] - b[1]).total_seconds()) <= 1800)
    assert rows(spark.read.parquet(out[0]), "lid", "rid") == want


def test_counters_add_up_and_a_replayed_batch_counts_once(spark, rows, tmp_path, out):
    schema = "key string, event string"
    stream = feed(spark, tmp_path / "in", [[("a", "0"), ("a", "3")], [("a", "0"), ("b", "2")]], schema)
    sink = U.change_log_sink(out[0], lambda b: W.event_counters(b, ["key"]))
    U.run_stream(stream, sink, out[1])
    sink(spark.createDataFrame([("a", "0"), ("b", "2")], schema), 1)
    cols = ["key", "req_num", "success_num", "fail_num", "imp_cnt"]
    want = [("a", 2, 0, 0, 1), ("b", 0, 0, 1, 0)]
    assert rows(U.read_change_log(spark, out[0], ["key"], default="add"), *cols) == want
    # Folding in two steps, the second one twice, counts every batch once.
    for upto in (0, 1, 1):
        U.fold_change_log(spark, out[0], str(tmp_path / "snap"), ["key"], upto, default="add")
    assert rows(read_snapshot(spark, str(tmp_path / "snap")), *cols) == want


def test_run_resumes_from_its_checkpoint_and_stops_on_the_marker(spark, rows, tmp_path, out):
    schema = "value string"
    stream = feed(spark, tmp_path / "in", [[("a b",)], [("a",)]], schema)
    U.run_stream(W.words(stream), U.change_log_sink(out[0]), out[1])
    spark.createDataFrame([("c",)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    marker = tmp_path / "stop"
    marker.write_text("")
    again = U.read_files(spark, str(tmp_path / "in"), schema, max_files=1)
    query = U.run_stream(W.words(again), U.change_log_sink(out[0]), out[1], interval="0 seconds", stop_marker=str(marker), poll_seconds=8)
    assert not query.isActive
    assert rows(spark.read.parquet(out[0]), "word") == [("a",), ("a",), ("b",), ("c",)]


def test_order_line_rules(spark):
    def line(code, n, **f):
        cols = [code] + [""] * (n - 1)
        for k, v in f.items():
            cols[int(k[1:])] = v
        return "\t".join(cols)

    t = "1704067200"
    df = spark.createDataFrame([(v,) for v in (
        line("317", 19, f1=t, f2="o1", f4="AC002", f7="10", f10="1", f17="2024-02-02", f18="2"), line("317", 19, f1=t, f2="o2", f4="AC002", f11="1", f17="2024-02-02", f18="1"),
        line("317", 19, f1=t), line("317", 18, f1=t, f2="short"), line("316", 48, f1=t, f3="o3", f37="c", f12=" "), line("319", 23, f1=t, f9="c"), line("319x", 23, f1=t, f9="c", f13="k"),
        line("314", 34, f1=t, f4="tpl"), "junk",
    )], "value string")
    got = {r.order_id: (r.active_time, r.sign_time, r.last_invest_time, r.invest_time) for r in O.parse_details(df).collect()}
    now = "2024-01-01 00:00:00"
    assert got == {"o1": (now, now, now, None), "o2": ("2024-02-02", None, None, now)}
    assert [(r.order_id, r.click_id, r.plan_id, r.time) for r in O.parse_orders(df).collect()] == [("o3", "c", None, int(t))]
    assert [(r.click_id, r.creative_id) for r in O.parse_clicks(df).collect()] == [("c", "k")]
    assert [r.template_id for r in O.parse_visits(df).collect()] == ["tpl"]
