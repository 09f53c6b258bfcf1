"""Orders with timers and rankings by differences, against their batch twins and plain windows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickstrata.streaming import differences as D
from clickstrata.streaming import enrich as E
from clickstrata.streaming import run as U
from clickstrata.streaming import timers as K
from clickstrata.streaming import windows as W
from tests.test_streaming import CLICK, ORDER, at, feed

TICK = "ts timestamp"


def test_an_order_is_settled_when_the_watermark_has_passed_what_decides_it(spark):
    from pyspark.sql.types import StructType

    m = 60_000_000
    p = K.OrderClicks(StructType.fromDDL("order_id string, plan_id string, creative_id string"), ["plan_id", "creative_id"], 20 * m)
    order = (30 * m, "o", None, None)
    early, late = (15 * m, "p15", None), (35 * m, "p35", "k")
    assert p.settled([order], [early, late], 29 * m) == ([], [order], [30 * m])
    done, waiting, wake = p.settled([order], [late, early], 30 * m)
    assert [tuple(r) for r in done] == [("o", "p15", None)] and not waiting and not wake
    assert p.settled([order], [late], 31 * m) == ([], [order], [35 * m])
    assert [tuple(r) for r in p.settled([order], [late, (9 * m, "x", "x")], 35 * m)[0]] == [("o", "p35", "k")]
    assert p.settled([order], [], 49 * m) == ([], [order], [50 * m])
    assert [tuple(r) for r in p.settled([order], [(51 * m, "x", "x")], 50 * m)[0]] == [("o", None, None)]
    ties = [(20 * m, "b", None), (20 * m, "a", "z"), (20 * m, "a", None)]
    assert [tuple(r) for r in p.settled([order], ties, 40 * m)[0]] == [("o", "a", None)]


def run_orders(spark, tmp_path, out, delay=None):
    o = U.read_files(spark, str(tmp_path / "o"), ORDER, max_files=1)
    c = U.read_files(spark, str(tmp_path / "c"), CLICK, max_files=1)
    ticks = U.read_files(spark, str(tmp_path / "t"), TICK, max_files=1)
    with K.rocksdb_state(spark):
        U.run_stream(K.orders_on_time(o, c, ticks=ticks, delay=delay), U.change_log_sink(out[0]), out[1])
    return {r.order_id: (r.plan_id, r.creative_id) for r in spark.read.parquet(out[0]).select("order_id", "plan_id", "creative_id").collect()}


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


def test_orders_come_once_on_time_and_after_a_restart(spark, tmp_path, out):
    rnd = random.Random(4)
    ids = [f"c{i}" for i in range(6)]
    moments = sorted(rnd.randrange(0, 6 * 3600) for _ in range(120))
    made = {"o": [], "c": []}
    for i, t in enumerate(moments):
        if rnd.random() < 0.5:
            made["o"].append((f"o{i}", rnd.choice([*ids, None]), at(t), rnd.choice([None, None, None, "own"]), None))
        else:
            made["c"].append((rnd.choice(ids), at(t), rnd.choice([f"p{i}", None]), f"k{i}"))
    third = lambda rows, i: rows[len(rows) * i // 3 : len(rows) * (i + 1) // 3]
    feed(spark, tmp_path / "t", [[(at(0),)]], TICK)
    # rows are shuffled within a part of the stream, and the second run goes on from the checkpoint of the first
    for i in (0, 1):
        for kind, schema in (("o", ORDER), ("c", CLICK)):
            part = third(made[kind], i)
            rnd.shuffle(part)
            feed(spark, tmp_path / kind, [part], schema)
    first = run_orders(spark, tmp_path, out, delay="6 hours")
    for kind, schema in (("o", ORDER), ("c", CLICK)):
        feed(spark, tmp_path / kind, [third(made[kind], 2)], schema)
    feed(spark, tmp_path / "t", [[(at(20 * 3600),)]], TICK)
    got = run_orders(spark, tmp_path, out, delay="6 hours")
    assert len(first) < len(got) == len(made["o"]) == spark.read.parquet(out[0]).count()
    batch = E.enrich_orders(spark.createDataFrame(made["o"], ORDER), spark.createDataFrame(made["c"], CLICK))
    assert got == {r.order_id: (r.plan_id, r.creative_id) for r in batch.collect()}
    assert sum(p is not None for p, _ in got.values()) > 10


def test_orders_that_share_a_group_take_clicks_of_their_own_id(spark, tmp_path):
    rnd = random.Random(8)
    ids = [f"c{i}" for i in range(60)]
    orders = [(f"o{i}", rnd.choice(ids), at(rnd.randrange(4 * 3600)), None, None) for i in range(200)]
    clicks = [(rnd.choice(ids), at(rnd.randrange(4 * 3600)), f"p{i}", None) for i in range(400)]
    want = {r.order_id: r.plan_id for r in E.enrich_orders(spark.createDataFrame(orders, ORDER), spark.createDataFrame(clicks, CLICK)).collect()}
    feed(spark, tmp_path / "o", [orders[::2], orders[1::2]], ORDER)
    feed(spark, tmp_path / "c", [clicks[::2], clicks[1::2]], CLICK)
    feed(spark, tmp_path / "t", [[(at(0),)], [(at(7 * 3600),)], [(at(20 * 3600),)]], TICK)
    for groups in (1, 3):
        out, read = str(tmp_path / f"out{groups}"), lambda name, schema: U.read_files(spark, str(tmp_path / name), schema, max_files=1)
        with K.rocksdb_state(spark):
            made = K.orders_on_time(read("o", ORDER), read("c", CLICK), delay="5 hours", ticks=read("t", TICK), groups=groups)
            query = U.run_stream(made, U.change_log_sink(out), str(tmp_path / f"checkpoint{groups}"))
        got = [(r.order_id, r.plan_id) for r in spark.read.parquet(out).collect()]
        assert len(got) == len(orders) and dict(got) == want
        assert max(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress) <= 2 * groups
    assert 10 < sum(p is not None for p in want.values()) < len(want)


WIDE = "order_id bigint, click_id string, ts timestamp, n bigint, f float, d double, b boolean, m decimal(30,5), day date, x binary, plain timestamp_ntz"
MANY = "click_id string, ts timestamp, n bigint, f float, m decimal(30,5), x binary"


@pytest.mark.parametrize("nested", [False, True])
def test_values_of_any_type_pass_the_state_unchanged(spark, tmp_path, nested):
    from decimal import Decimal

    big, day = 2**60 + 1, dt.date(9999, 12, 31)
    full = (1.1, -0.0, True, Decimal("123456789012345678901234.00001"), day, b"\x00\xff", dt.datetime(9999, 12, 31, 23, 59, 59, 999999))
    far = lambda s: dt.datetime(2300, 1, 1) + dt.timedelta(seconds=s)
    orders = [(big, "c0", at(600), None, None, *full[1:3], None, day, None, full[6]), (big + 2, "c1", at(600), None, None, None, None, None, None, None, None)]
    orders += [(i, "none", at(600), None, None, float("nan"), False, None, day, None, None) for i in range(2)] + [(5, "c5", at(600), big, *full), (6, "far", far(60), None, None, *full[1:3], None, day, None, None)]
    clicks = [("c0", at(500), big + 4, 0.1, full[3], b"\xfe"), ("c0", at(400), 1, None, None, None), ("c1", at(600), 10, None, None, None), ("c1", at(600), 9, None, None, None)]
    clicks += [("far", far(0), None, 2.5, Decimal("0.00010"), None), ("far", far(90), 7, None, None, None)]
    feed(spark, tmp_path / "o", [orders], WIDE)
    feed(spark, tmp_path / "c", [clicks], MANY)
    feed(spark, tmp_path / "t", [[(at(0),)], [(far(7200),)]], TICK)
    wide = lambda df: df.withColumn("deep", F.array(F.struct("n", "order_id"))) if nested else df
    o, c = (U.read_files(spark, str(tmp_path / name), schema) for name, schema in (("o", WIDE), ("c", MANY)))
    out, fill = str(tmp_path / "out"), ["n", "f", "m", "x"]
    with K.rocksdb_state(spark):
        U.run_stream(K.orders_on_time(wide(o), c, fill=fill, ticks=U.read_files(spark, str(tmp_path / "t"), TICK)), U.change_log_sink(out), str(tmp_path / "checkpoint"))
    batch = E.enrich_orders(wide(spark.createDataFrame(orders, WIDE)), spark.createDataFrame(clicks, MANY), fill=fill)
    got, want = spark.read.parquet(out).drop("batch"), batch
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.where("n is not null or f is not null").count() == 4


def test_rows_come_and_go_in_frames(spark):
    import pandas as pd
    from pyspark.sql.types import StructType

    m = 60_000_000
    p, kept = K.OrderClickFrames(StructType.fromDDL("order_id bigint, n bigint"), ["n"], 20 * m, True, 20 * m), Kept()
    rows = [(1, None, 2, "", f"{31 * m}", None, None)]
    for i in range(0, 6000, 2):
        rows += [(1, None, 0, f"c{i}", f"{31 * m}", f"{i}", None), (1, None, 1, f"c{i}", f"{30 * m}", None, f"{2**60 + i + 1}")]
    p.init(kept)
    assert not [*p.handleInputRows((1,), iter([pd.DataFrame(rows[i : i + 2000]) for i in range(0, len(rows), 2000)]), Now(0))]
    assert kept.calls < 20
    p.init(kept)
    frames = [*p.handleExpiredTimer((1,), Now(31 * m), None)]
    assert len(frames) == 1 and sorted(map(tuple, frames[0].values)) == sorted((f"{i}", f"{2**60 + i + 1}") for i in range(0, 6000, 2))


def test_the_state_has_few_partitions_and_commits_changes(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "600")
        with K.rocksdb_state(spark):
            assert int(spark.conf.get("spark.sql.shuffle.partitions")) <= max(32, 3 * spark.sparkContext.defaultParallelism)
            assert spark.conf.get(K.CHANGES) == "true"
        with K.rocksdb_state(spark, 100):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "600"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_other_columns_pass_through_the_state(spark, tmp_path, out):
    row = [("o", "c", at(60), None, None)]
    feed(spark, tmp_path / "o", [row], ORDER)
    feed(spark, tmp_path / "c", [[("c", at(90), "p", "k")]], CLICK)
    feed(spark, tmp_path / "t", [[(at(9000),)]], TICK)
    run_orders(spark, tmp_path, out)
    assert [tuple(r) for r in spark.read.parquet(out[0]).drop("batch").collect()] == [("o", "c", at(60), "p", "k")]


def windows_by_hand(data, size, slide, n):
    """(group, window) -> ranked (item, count), every window counted anew."""
    base = dt.datetime(1970, 1, 1)
    seconds = [(int((t - base).total_seconds()), g, i) for t, g, i in data]
    starts = {s for t, _, _ in seconds for s in range((t - size) // slide * slide + slide, t // slide * slide + slide, slide)}
    out = {}
    for s in starts:
        counts = {}
        for t, g, i in seconds:
            if s <= t < s + size:
                counts.setdefault(g, {}).setdefault(i, []).append(t)
        for g, items in counts.items():
            out[g, s] = sorted(((i, len(v)) for i, v in items.items()), key=lambda x: (-x[1], x[0]))[:n]
    return out


@pytest.mark.parametrize(("size", "slide", "cut"), [(600, 60, None), (600, 5, "1 hour"), (60, 60, None), (900, 300, "300 seconds")])
def test_rankings_by_differences_equal_those_of_every_window(spark, size, slide, cut):
    rnd = random.Random(size + slide)
    data = [(at(rnd.randrange(3000)), "hot" if i % 3 == 0 else f"g{rnd.randrange(3)}", f"i{rnd.randrange(7)}") for i in range(250)]
    data += [(at(20_000), "g0", "i1"), (at(20_000), "g0", "i0")]
    df = spark.createDataFrame([*data, (at(5), None, "i"), (at(5), "g0", None)], "ts timestamp, key string, item string")
    panes = W.pane_counts(df, "ts", ["key", "item"], f"{slide} seconds")
    got = {}
    for r in D.top_by_changes(panes, "item", f"{size} seconds", f"{slide} seconds", 3, ["key"], cut).collect():
        s = int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp())
        for i in range(r.windows):
            got.setdefault((r.key, s + i * slide), []).append((r.rn, r.item, r.n))
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == windows_by_hand(data, size, slide, 3)


def test_no_row_is_repeated_per_window(spark):
    df = spark.createDataFrame([(at(s), f"i{s % 5}") for s in range(0, 20_000, 10)], "ts timestamp, item string")
    panes = W.pane_counts(df, "ts", ["item"], "5 seconds")
    assert D.pane_changes(panes, ["item"], "2 hours", "5 seconds", "2 hours").count() <= 4 * panes.count()
    top = D.top_by_changes(panes, "item", "2 hours", "5 seconds", 10)
    assert top.agg(F.sum("windows")).first()[0] > 3 * top.count()


def test_each_click_takes_its_latest_view(spark, tmp_path, out):
    rnd = random.Random(12)
    views = [("hot" if i % 3 == 0 else rnd.choice(["u", "v", None]), at(rnd.randrange(4 * 3600)), i) for i in range(60)] + [("u", at(50), 98), ("u", at(50), 97)]
    clicks = [("hot" if i % 3 == 0 else rnd.choice(["u", "v", None]), at(rnd.randrange(4 * 3600)), i) for i in range(60)] + [("u", at(50), 99)]
    feed(spark, tmp_path / "v", [views[::2], views[1::2]], "user string, ts timestamp, view int")
    feed(spark, tmp_path / "c", [clicks[::2], clicks[1::2]], "user string, ts timestamp, click int")
    feed(spark, tmp_path / "t", [[(at(0),)], [(at(9 * 3600),)]], TICK)
    read = lambda name, schema: U.read_files(spark, str(tmp_path / name), schema)
    c, v = read("c", "user string, ts timestamp, click int"), read("v", "user string, ts timestamp, view int")
    with K.rocksdb_state(spark):
        U.run_stream(K.latest_before(c, v, "user", "ts", "ts", ["view"], "30 minutes", delay="5 hours", ticks=read("t", TICK)), U.change_log_sink(out[0]), out[1])
    feed(spark, tmp_path / "t", [[(at(30 * 3600),)]], TICK)
    with K.rocksdb_state(spark):
        U.run_stream(K.latest_before(c, v, "user", "ts", "ts", ["view"], "30 minutes", delay="5 hours", ticks=read("t", TICK)), U.change_log_sink(out[0]), out[1])
    got = sorted((r.click, r.view) for r in spark.read.parquet(out[0]).select("click", "view").collect())
    want = []
    for user, ts, i in clicks:
        before = [(w, -n) for u, w, n in views if u is not None and u == user and ts - dt.timedelta(minutes=30) <= w <= ts]
        want.append((i, -max(before)[1] if before else None))
    assert got == sorted(want) and sum(b is not None for _, b in want) > 10


class Kept:
    """A list state and timers that count the calls."""

    def __init__(self):
        self.lists, self.calls, self.timers = {}, 0, []

    def getListState(self, name, schema):
        return Kept.List(self, name)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    class List:
        def __init__(self, kept, name):
            self.kept, self.values = kept, kept.lists.setdefault(name, [])

        def _called(self, values):
            self.kept.calls += 1
            self.values[:] = values

        def get(self):
            self._called(self.values)
            return iter([*self.values])

        def appendValue(self, value):
            self._called([*self.values, value])

        def appendList(self, values):
            self._called([*self.values, *values])

        def put(self, values):
            self._called(values)

        def clear(self):
            self._called([])


class Now:
    def __init__(self, micros):
        self.getCurrentWatermarkInMs = lambda: micros // 1000


def test_state_is_called_per_group_not_per_key(spark):
    from pyspark.sql import Row
    from pyspark.sql.types import StructType

    m = 60_000_000
    rows = []
    for i in range(3000):
        rows.append(Row(_key=f"c{i}", _at=30 * m, _order={"order_id": f"o{i}", "plan_id": None}, _click=None))
        rows.append(Row(_key=f"c{i}", _at=(25 + i % 10) * m, _order=None, _click={"plan_id": f"p{i}"}))
    p, kept = K.OrderClicks(StructType.fromDDL("order_id string, plan_id string"), ["plan_id"], 20 * m), Kept()
    p.init(kept)
    assert not [*p.handleInputRows((1,), iter(rows), Now(0))]
    assert kept.calls < 10 and max(len(v) for v in kept.lists.values()) < 10
    got, now = {}, 0
    for now in (30 * m, 32 * m, 70 * m):
        p.init(kept)
        for due in [t for t in kept.timers if t * 1000 <= now]:
            kept.timers.remove(due)
            got |= {r.order_id: (r.plan_id, now // m) for r in p.handleExpiredTimer((1,), Now(now), None)}
    # a click before counts at once, one after when the watermark is there
    assert got == {f"o{i}": (f"p{i}", 30 if i % 10 <= 5 else 32 if i % 10 <= 7 else 70) for i in range(3000)}
    assert kept.calls < 40 and not any(kept.lists.values()) and not kept.timers


def test_each_click_takes_its_latest_view_whatever_shares_its_group(spark, tmp_path):
    rnd = random.Random(31)
    users = [f"u{i}" for i in range(40)]
    views = [(rnd.choice(users), at(rnd.randrange(6 * 3600)), i) for i in range(300)]
    clicks = [(rnd.choice(users), at(rnd.randrange(6 * 3600)), i) for i in range(300)]
    feed(spark, tmp_path / "v", [views[::2], views[1::2]], "user string, ts timestamp, view int")
    feed(spark, tmp_path / "c", [clicks[::2], clicks[1::2]], "user string, ts timestamp, click int")
    feed(spark, tmp_path / "t", [[(at(0),)], [(at(9 * 3600),)], [(at(30 * 3600),)]], TICK)
    want = {}
    for user, ts, i in clicks:
        before = [(w, -n) for u, w, n in views if u == user and ts - dt.timedelta(minutes=30) <= w <= ts]
        want[i] = -max(before)[1] if before else None
    for groups in (1, 3):
        read = lambda name, schema: U.read_files(spark, str(tmp_path / name), schema, max_files=1)
        c, v = read("c", "user string, ts timestamp, click int"), read("v", "user string, ts timestamp, view int")
        with K.rocksdb_state(spark):
            joined = K.latest_before(c, v, "user", "ts", "ts", ["view"], "30 minutes", delay="7 hours", ticks=read("t", TICK), groups=groups)
            query = U.run_stream(joined, U.change_log_sink(str(tmp_path / f"out{groups}")), str(tmp_path / f"checkpoint{groups}"))
        got = [(r.click, r.view) for r in spark.read.parquet(str(tmp_path / f"out{groups}")).select("click", "view").collect()]
        assert len(got) == len(clicks) and dict(got) == want
        assert max(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress) <= 2 * groups
    assert sum(b is not None for b in want.values()) > 10
