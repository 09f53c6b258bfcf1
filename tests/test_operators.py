"""Joins, funnels, ranking and rules on small fixtures, several against brute force with one hot key."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickstrata.operators import baskets as K
from clickstrata.operators import dims as O
from clickstrata.operators import features as V
from clickstrata.operators import funnel as N
from clickstrata.operators import quality as Y
from clickstrata.operators import ranking as R
from clickstrata.operators import rules as H


def hot_rows(n=3000, keys=40, seed=1):
    """(key, item, second) rows with a third of them on one key."""
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(keys)}", rnd.randrange(300), 1_700_000_000 + rnd.randrange(20_000)) for i in range(n)]


@pytest.fixture(scope="module")
def hot(spark):
    data = hot_rows()
    return data, spark.createDataFrame(data, "key string, item int, t bigint").repartition(6).cache()


def test_lookup_defaults_duplicates_and_blanks(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "name string, n int")
    dim = spark.createDataFrame([("a", "10"), ("a", "11"), ("b", ""), (None, "9")], "name string, id string")
    assert rows(O.lookup_dims(fact, [O.DimSpec(dim, "name", "name", {"id": "id"})]), "n", "id") == [(1, "11"), (2, "-1"), (3, "-1"), (4, "-1")]
    kept = O.lookup_dims(fact, [O.DimSpec(dim, "name", "name", {"name": "id"}, fallback_to_key=True)])
    assert rows(kept, "n", "name") == [(1, "11"), (2, ""), (3, None), (4, "z")]


def test_keep_known_and_membership(spark, rows):
    fact = spark.createDataFrame([("a",), ("x",), ("-1",), (None,)], "c string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert rows(O.keep_known(fact, dim, "c", "name")) == [("-1",), ("a",)]
    assert rows(O.is_blacklisted(fact, dim.withColumnRenamed("name", "c"), ["c"])) == [("-1", False), ("a", True), ("x", False), (None, False)]


def test_ip_ranges(spark, rows):
    ranges = spark.createDataFrame([(0, 255, "low"), (65536 * 3 - 5, 65536 * 5 + 2, "wide"), (4294967040, 4294967295, "top")], "ip_start bigint, ip_end bigint, place string")
    ips = spark.createDataFrame([("0.0.0.255",), ("0.0.1.0",), ("0.2.255.251",), ("0.4.9.9",), ("0.5.0.2",), ("0.5.0.3",), ("255.255.255.255",), ("bad",), (None,), ("0.4.9.9",)], "ip string")
    for bits in (8, 16, 24):
        got = rows(O.ip_geo_join(ips, ranges, "ip", ["place"], prefix_bits=bits))
        assert got == sorted([("0.0.0.255", "low"), ("0.0.1.0", None), ("0.2.255.251", "wide"), ("0.4.9.9", "wide"), ("0.4.9.9", "wide"), ("0.5.0.2", "wide"), ("0.5.0.3", None),
                              ("255.255.255.255", "top"), ("bad", None), (None, None)], key=repr)


def test_merge_funnel_is_order_independent_and_shuffles_once(spark, rows):
    a = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 3.0)], "k string, p double")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    fa, fb = N.FactSpec(a, {"k": "k"}, {"cost": "p", "shows": F.lit(1)}), N.FactSpec(b, {"k": "k"}, {"clicks": F.lit(1)})
    left, right = N.merge_funnel([fa, fb], ["k"]), N.merge_funnel([fb, fa], ["k"])
    expected = [("x", 3.0, 2, 1), ("y", 3.0, 1, 0), ("z", 0.0, 0, 1)]
    assert rows(left, "k", "cost", "shows", "clicks") == rows(right, "k", "cost", "shows", "clicks") == expected
    assert left._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(N.merge_funnel([fa, fb], ["k"], fill=None), "k", "clicks") == [("x", 1), ("y", None), ("z", 1)]


def test_segment_uv_pv(spark, hot):
    data, df = hot
    even = F.col("item") % 2 == 0
    got = {r.key: (r.u, r.v, r.p) for r in N.segment_uv_pv(df, ["key"], {"u": (even, F.col("item")), "v": (~even, F.col("item"))}, {"p": even}).collect()}
    want = {k: (len({i for kk, i, _ in data if kk == k and i % 2 == 0}), len({i for kk, i, _ in data if kk == k and i % 2}), sum(1 for kk, i, _ in data if kk == k and i % 2 == 0)) for k in {d[0] for d in data}}
    assert got == want


def test_ranking_with_hot_key(spark, hot):
    data, df = hot
    first = {r.key: (r.t, r.item) for r in R.dedup_first(df, ["key"], ["t", "item"]).collect()}
    want = {}
    for k, i, t in data:
        want[k] = min(want.get(k, (t, i)), (t, i))
    assert first == want
    counts = defaultdict(Counter)
    for k, i, _ in data:
        counts[k][i] += 1
    top = defaultdict(list)
    for r in R.top_items_by(df, "key", "item", 5).collect():
        top[r.key].append((r.rn, r.item, r.cnt))
    for k, c in counts.items():
        best = sorted(c.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert sorted(top[k]) == [(n + 1, i, m) for n, (i, m) in enumerate(best)]


def test_rank_filters_cut_groups_before_the_shuffle(spark, hot):
    plan = R.top_items_by(hot[1], "key", "item", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in R.dedup_first(hot[1], ["key"], ["t"])._jdf.queryExecution().executedPlan().toString()


def test_share_of_total_sums_to_one_also_for_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 2), (None, 2), ("z", 0)], "k string, n int")
    for wide in (False, True):
        got = sorted(((r.k, r.n, r.s) for r in R.share_of_total(df, "n", ["k"], "s", wide=wide).collect()), key=repr)
        assert got == sorted([("a", 1, 0.25), ("a", 3, 0.75), (None, 2, 0.5), (None, 2, 0.5), ("z", 0, None)], key=repr)


def test_cookie_items_with_hot_visitor(spark, hot):
    data, df = hot
    items = defaultdict(set)
    for k, i, _ in data:
        items[k].add(i)
    for hi in (45, 60, 250):
        got = {r.key: r["items"] for r in K.cookie_items(df, "key", "item", hi=hi, as_text=False).collect()}
        assert got == {k: sorted(v) for k, v in items.items() if 2 <= len(v) <= hi}
    assert "hot" not in {r.key for r in K.cookie_items(df, "key", "item", hi=45).collect()}


def test_modes_with_hot_key(spark, hot):
    data, df = hot
    want = {}
    for k in {d[0] for d in data}:
        c = Counter(str(i % 17) for kk, i, _ in data if kk == k and i % 17)
        want[k] = min(c.items(), key=lambda x: (-x[1], x[0]))[0] if c else ""
    src = df.withColumn("v", F.when(F.col("item") % 17 != 0, (F.col("item") % 17).cast("string")).otherwise(""))
    assert {r.key: r.v for r in V.modes(src, ["key"], ["v"]).collect()} == want


def timing(times, start):
    s = sorted(times)
    if not s:
        return (0, 0, 0, 0, 0)
    if len(s) == 1:
        return (s[0] - start, s[0] - start, -1, -1, -1)
    gaps = [b - a for a, b in zip(s, s[1:])]
    return (s[0] - start, s[-1] - start, min(gaps), max(gaps), sum(gaps) // len(gaps))


def test_click_timing_hand_values(spark):
    start = 1626926400
    df = spark.createDataFrame([("a", t) for t in (1626926499, 1626926401, 1626926403, 1626926800, 1626929999)] + [("b", start + 7), ("c", None), ("d", start + 5), ("d", start + 5)], "k string, t bigint")
    got = {r.k: tuple(r)[1:] for r in V.click_timing(df, ["k"], "t", start).collect()}
    assert got == {"a": (1, 3599, 2, 3199, 899), "b": (7, 7, -1, -1, -1), "c": (0, 0, 0, 0, 0), "d": (5, 5, 0, 0, 0)}


def test_click_timing_with_hot_key(spark, hot):
    data, df = hot
    times = defaultdict(list)
    for k, _, t in data:
        times[k].append(t)
    got = {r.key: tuple(r)[1:] for r in V.click_timing(df, ["key"], "t", 1_700_000_000).collect()}
    assert got == {k: timing(v, 1_700_000_000) for k, v in times.items()}


def test_behaviour_shares_and_blocks(spark):
    req = spark.createDataFrame([("a", "u1", "s1", "hw", 1.0), ("a", "u1", "s1", "hw", 3.0), ("b", "u1", "s2", "", 5.0), ("a", "u2", "s1", "ap", None)], "app string, id string, slot string, producer string, floor_price double")
    imp = spark.createDataFrame([("a", "u1", "s1", "c1", 2.0), ("a", "u1", "s1", "c2", 4.0), ("a", "u1", "s1", "c2", 6.0)], "app string, id string, slot string, creative_id string, real_price double")
    clk = spark.createDataFrame([("b", "u1", "s2", "c9", 100)], "app string, id string, slot string, creative_id string, time bigint")
    spec = V.BehaviourSpec(mode_cols=("producer",))
    out = {(r.app, r.id): r for r in V.behaviour_features(req, imp, clk, ["app", "id", "slot"], spec, 40).collect()}
    a, b, c = out["a", "u1"], out["b", "u1"], out["a", "u2"]
    assert (a.req_count, a.req_rate, b.req_rate, c.req_rate) == (2, pytest.approx(2 / 3), pytest.approx(1 / 3), 1.0)
    assert (a.req_avg_real_price, a.req_max_real_price, c.req_avg_real_price, a.producer, b.producer) == (2.0, 3.0, None, "hw", "")
    assert (a.imp_cnt, a.imp_rate, a.imp_creative_count, a.imp_max_count_creative, a.imp_avg_real_price) == (3, 1.0, 2, "c2", 4.0)
    assert (b.clk_cnt, b.clk_first_seconds, b.clk_min_interval, b.imp_cnt, a.clk_cnt) == (1, 60, -1, None, None)


def test_conversion_link_has_one_row_per_key(spark):
    keys = ["app", "id"]
    dev = spark.createDataFrame([("a", "u"), ("a", "u"), ("b", "v")], "app string, id string")
    conv = spark.createDataFrame([("a", "u", "p1", "c", "m", "alp_1"), ("a", "u", "p2", "c", "m", "alp_4"), ("z", "z", "p", "c", "m", "alp_2")], "app string, id string, plan_id string, creative_id string, admaster_id string, ocpx_tag string")
    got = V.link_conversions(dev, conv, keys).collect()
    assert len(got) == 1 and (got[0].if_new_enter, got[0].if_live_awaken, got[0].if_pay, got[0].if_mau, got[0].plan_id) == (1, 0, 0, 1, "p2")


def test_heavy_hitters_and_cheat_list(spark, rows):
    df = spark.createDataFrame([("10.0.0.1", "i1")] * 4 + [("10.0.0.2", "000")] * 6 + [("bad", None)] * 9, "ip string, imei string").withColumns({"idfa": F.lit(""), "android_id": F.lit(None).cast("string")})
    assert rows(H.heavy_hitters(df, "ip", 6, exclude=["bad"])) == [("10.0.0.2", 6)]
    limits = {"imei": 3, "ip": 4, "ip3": 9}
    got = rows(H.cheat_list([("a", df), ("b", df.limit(2))], limits))
    assert got == [("imei", "i1", 4), ("ip", "10.0.0.2", 6), ("ip3", "0a0000", 10)]


def test_suspicious_ip_masks(spark, rows):
    data = [("s", "a", "h1", "call")] * 6 + [("s", "a", "h1", "resp")] * 2 + [("s", "b", "h1", "clk")] * 4 + [("s", "c", "h1", "clk")] * 2 + [("s", "c", "h2", "clk")] * 2 + [("s", "d", "h", "call")] * 21 + [("s", "d", "h", "resp")] * 21
    df = spark.createDataFrame(data, "slot string, ip string, hour string, act string")
    got = rows(H.suspicious_ips(df, "slot", "ip"))
    assert got == [("s", "a", 0, 1, 0, 6, 2, None), ("s", "b", 0, 0, 1, None, None, 4), ("s", "d", 1, 0, 0, 21, None, None)]


def test_retention(spark, rows):
    df = spark.createDataFrame([("d1", "t", "a"), ("d2", "t", "a"), ("d2", "t", "b"), ("d2", "t", "b")], "day string, kind string, id string")
    assert rows(Y.retention_overlap(df, "day", "kind", "id")) == [("t", 1, 1, 1), ("t", 2, 1, 1), ("t", 2, 2, 1), ("t", 3, 1, 2)]
    df = spark.createDataFrame([("d1", "t", "a"), ("d3", "t", "a"), ("d1", None, "a"), ("d2", None, "a"), ("d2", "u", "b")], "day string, kind string, id string")
    assert rows(Y.retention_overlap(df, "day", "kind", "id")) == sorted([("t", 1, 1, 1), ("t", 2, 2, 1), ("t", 3, 1, 1), (None, 1, 1, 1), (None, 2, 2, 1), (None, 3, 1, 1), ("u", 1, 1, 1), ("u", 2, 1, 1)], key=repr)


def test_bucket_with_sample_and_labels(spark):
    data = [("r", f"i{n:02d}") for n in range(30)] + [("r", "big")] * 11 + [("r", "mid")] * 7
    df = spark.createDataFrame(data, "region string, id string")
    got = {r.range: (r.cnt, r.sample) for r in Y.bucket_with_sample(df, ["region"], "id").collect()}
    assert got == {"1": (30, ",".join(f"i{n:02d}" for n in range(10))), ">10": (1, "big"), "6,7,8": (1, "mid")}


def test_exact_percentile_matches_sorting(spark):
    rnd = random.Random(3)
    values = [rnd.choice([5.0, rnd.random() * 100]) for _ in range(2001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    s = sorted(values)
    for q in (0.0, 0.25, 0.5, 0.901, 1.0):
        pos = (len(s) - 1) * q
        lo, hi = int(pos), min(int(pos) + 1, len(s) - 1)
        want = s[lo] + (s[hi] - s[lo]) * (pos - lo)
        for accuracy in (50, 10_000):
            assert Y.exact_percentile(df, "v", q, accuracy).first()[0] == pytest.approx(want)


def test_score_histogram_edges(spark, rows):
    df = spark.createDataFrame([(0.3,), (0.29,), (0.5,), (1.0,)], "s double")
    assert rows(Y.score_histogram(df, "s"), "bucket", "cnt", "share_high") == [(0.2, 1, 0.5), (0.3, 1, 0.5), (0.5, 1, 0.5), (1.0, 1, 0.5)]


def test_baskets_of_any_size_are_mined(spark):
    rows = [("big", f"i{n:03d}") for n in range(250)] + [("small", "i000"), ("small", "i001")]
    df = spark.createDataFrame(rows, "o string, i string")
    baskets = K.cookie_items(df, "o", "i", lo=1, hi=None, as_text=False)
    assert {r.o: r.n_items for r in baskets.collect()} == {"big": 250, "small": 2}
    sets, _ = K.freq_itemsets(baskets, "items", 1.0)
    assert {",".join(sorted(r["items"])): r.freq for r in sets.collect()} == {"i000": 2, "i001": 2, "i000,i001": 2}


def test_frequent_items_three_baskets(spark):
    df = spark.createDataFrame([(["1", "2", "5"],), (["1", "2", "3", "5"],), (["1", "2"],)], "items array<string>")
    sets, _ = K.freq_itemsets(df, "items", 0.5, 0.6)
    assert {"".join(sorted(r["items"])): r.freq for r in sets.collect()} == {"1": 3, "2": 3, "5": 2, "12": 3, "15": 2, "25": 2, "125": 2}


@pytest.mark.parametrize("rows_per_range", [20, 1_000_000])
def test_order_statistics_of_a_heavy_tail_and_a_hot_group(spark, rows_per_range):
    rnd = random.Random(8)
    data = [("hot" if i % 3 == 0 else rnd.choice(["a", "b", None]), rnd.paretovariate(0.3)) for i in range(3000)]
    data += [("one", 5.0), ("two", 1.0), ("two", 2.0), ("same", 7.0), ("same", 7.0), ("same", 7.0), ("none", None)] + [("hot", 1.0)] * 500
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    qs = [0.0, 0.1, 0.5, 0.937, 1.0]
    got = {(r.k, r.q): r.percentile for r in Y.order_statistics(df, ["k"], "v", qs, rows_per_range=rows_per_range, most_ranges=8).collect()}
    want = {}
    for k in {k for k, v in data if v is not None}:
        values = sorted(v for kk, v in data if kk == k and v is not None)
        for q in qs:
            p = (len(values) - 1) * q
            lo = values[int(p)]
            want[k, q] = lo + (values[min(int(p) + 1, len(values) - 1)] - lo) * (p - int(p)) if p > int(p) else lo
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], rel=1e-12) for x in want)


def test_order_statistics_without_keys_or_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert [tuple(r) for r in Y.order_statistics(df, [], "v", [0.25], rows_per_range=10).collect()] == [(0.25, 25.0)]
    assert Y.order_statistics(df.limit(0), [], "v", [0.25]).collect() == []


def test_percentile_of_a_crowded_part_takes_further_passes(spark):
    rnd = random.Random(2)
    values = [1e9 + rnd.random() * 1e-3 for _ in range(4000)] + [rnd.random() for _ in range(10)] + [1e15] * 3
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0.5, 0.9):
        s = sorted(values)
        p = (len(s) - 1) * q
        want = s[int(p)] + (s[int(p) + 1] - s[int(p)]) * (p - int(p))
        assert Y.exact_percentile(df, "v", q, accuracy=10, cells=16, rows_at_once=5).first()[0] == pytest.approx(want, rel=1e-15)


def test_apriori_finds_the_sets_of_fp_growth(spark):
    rnd = random.Random(3)
    baskets = [sorted({f"i{min(rnd.randrange(12), rnd.randrange(12))}" for _ in range(rnd.randrange(0, 8))}) for _ in range(400)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    want, _ = K.freq_itemsets(df, "items", 0.03)
    sets = lambda d: sorted((sorted(r.items_), r.freq) for r in d.withColumnRenamed("items", "items_").collect())
    got = sets(K.apriori(df, "items", 0.03))
    assert got == sets(want) and max(len(s) for s, _ in got) >= 3
    assert sets(K.apriori(df, "items", 0.03, longest=2)) == [x for x in got if len(x[0]) <= 2]


def test_apriori_on_hard_baskets(spark):
    df = spark.createDataFrame([(None,), ([],), (["a", "a", None],), (["a", "b"],), (["b", "a"],)], "items array<string>")
    assert sorted((r[0], r.freq) for r in K.apriori(df, "items", 0.5).collect()) == [(["a"], 3), (["a", "b"], 2), (["b"], 2)]
    assert K.apriori(df.limit(0), "items", 0.5).collect() == []


def test_addresses_take_the_range_that_starts_last(spark, rows):
    rnd = random.Random(6)
    bounds = sorted(rnd.sample(range(2**32), 400))
    ranges = [(a, b, f"p{a}") for a, b in zip(bounds[::2], bounds[1::2])]
    numbers = [rnd.randrange(2**32) for _ in range(500)] + [x for a, b, _ in ranges[:40] for x in (a, b, a - 1, b + 1)] + [5] * 200
    ips = [(i, ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))) for i, n in enumerate(numbers)] + [(-1, "bad"), (-2, None)]
    df = spark.createDataFrame(ips, "i int, ip string").repartition(4)
    r = spark.createDataFrame(ranges, "ip_start bigint, ip_end bigint, place string")
    want = sorted([(i, next((p for a, b, p in ranges if a <= n <= b), None)) for i, n in enumerate(numbers)] + [(-1, None), (-2, None)], key=repr)
    assert rows(O.ip_as_of_join(df, r, "ip", ["place"]), "i", "place") == want
    assert rows(O.ip_as_of_join(df.limit(1), r.limit(0), "ip", ["place"]), "place") == [(None,)]


def test_bitmaps_count_distinct_ids_over_days(spark, rows):
    from clickstrata.operators import bitmaps as M

    rnd = random.Random(11)
    data = [(f"2024-01-{rnd.randrange(1, 10):02d}", rnd.choice(["a", "b", None]), f"u{rnd.randrange(60)}" if i % 3 else "hot") for i in range(900)] + [("2024-01-01", "a", None)]
    df = spark.createDataFrame(data, "day string, kind string, id string").repartition(4)
    numbers = M.number_ids(df.where("day < '2024-01-05'"), "kind", "id")
    numbers = M.number_ids(df, "kind", "id", numbers)
    assert numbers.count() == numbers.select("number").distinct().count() == df.where("id IS NOT NULL").select("kind", "id").distinct().count()
    bits = M.daily_bitmaps(df, "day", "kind", "id", numbers).cache()
    ids = lambda kind, days: {i for d, k, i in data if k == kind and d in days and i is not None}
    days = ["2024-01-02", "2024-01-07"]
    assert {r.kind: r.cnt for r in M.distinct_ids(bits, days).collect()} == {k: len(ids(k, days)) for k in ("a", "b", None)}
    assert {r.kind: r.both for r in M.seen_on_both(bits, *days).collect()} == {k: len(ids(k, days[:1]) & ids(k, days[1:])) for k in ("a", "b", None)}
    got = {(r.kind, r.day): r.cnt for r in M.rolling_distinct(bits, 3).collect()}
    assert got == {(k, d): len(ids(k, [f"2024-01-{n:02d}" for n in range(int(d[-2:]) - 2, int(d[-2:]) + 1)])) for k in ("a", "b", None) for d in {x for x, kk, _ in data if kk == k}}


def test_behaviour_from_partials_of_days_equals_the_features_of_their_logs(spark):
    from clickstrata.operators import partials as P

    rnd = random.Random(14)
    pick = lambda *xs: rnd.choice(xs)
    data = [(pick("req", "req", "imp", "clk", "other"), f"2024-01-0{rnd.randrange(1, 4)}", pick("a1", "a2"), "hot" if i % 3 == 0 else pick("u1", "u2", "u3", None), pick("s1", "s2"),
             pick("HUAWEI", "", None, "Redmi"), pick("9", "10", None), rnd.randrange(5, 120), pick("1.5", "2", "x", None), pick("c1", "c2", "", None), 1_704_067_200 + rnd.randrange(9000)) for i in range(700)]
    log = spark.createDataFrame(data, "kind string, day string, app string, id string, slot string, producer string, ip string, level int, price string, creative string, t bigint").repartition(4)
    keys = ["app", "id", "slot"]
    spec = V.BehaviourSpec(mode_cols=["producer"], max_cols=["ip", "level"], req_price="price", price="price", creative="creative", time="t", apps="app")
    parts = [P.behaviour_partials(log.where(F.col("day") == d), "kind", "day", keys, spec) for d in ("2024-01-01", "2024-01-02", "2024-01-03")]
    partials = parts[0].union(parts[1]).union(parts[2])
    day = "day = '2024-01-02'"
    grains = [P.Grain("slot", keys, day, ["producer"], ["ip", "level"], timing=True), P.Grain("id", ["id"], day, timing=True, apps=True), P.Grain("days", keys, "true")]
    got = P.behaviour_of_partials(partials, grains, spec, P.column_types(log, spec.max_cols), 1_704_067_200)
    logs = lambda cond: [log.where(cond).where(F.col("kind") == k) for k in ("req", "imp", "clk")]
    from dataclasses import replace
    plain = replace(spec, mode_cols=(), max_cols=())
    want = {
        "slot": V.behaviour_features(*logs(day), keys, replace(spec, apps=None), 1_704_067_200),
        "id": V.behaviour_features(*logs(day), ["id"], plain, 1_704_067_200), "days": V.behaviour_features(*logs("true"), keys, replace(plain, apps=None)),
    }
    for name, frame in want.items():
        assert set(got[name].columns) == set(frame.columns)
        sort = lambda d: sorted((tuple(r) for r in d.select(sorted(frame.columns)).collect()), key=repr)
        assert sort(got[name]) == sort(frame)
