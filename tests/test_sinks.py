"""Writers, merges and versioned snapshots."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from clickstrata.sinks import buckets as B
from clickstrata.sinks import snapshots as N
from clickstrata.sinks import writers as W


def test_merge_modes(spark, rows):
    base = spark.createDataFrame([("a", 1, "x", 5), ("b", 2, "y", 5)], "k string, n int, s string, m int")
    upd = spark.createDataFrame([("a", 10, "", 3), ("c", 30, "z", None)], "k string, n int, s string, m int")
    got = rows(N.merge_rows(base, upd, ["k"], {"n": "add", "s": "keep_blank", "m": "max"}), "k", "n", "s", "m")
    assert got == [("a", 11, "x", 5), ("b", 2, "y", 5), ("c", 30, "z", None)]
    # Replacing also takes a null from the update.
    assert rows(N.merge_rows(base, upd, ["k"]), "k", "s", "m") == [("a", "", 3), ("b", "y", 5), ("c", "z", None)]


def test_row_changes(spark, rows):
    base = spark.createDataFrame([(1, "zhangsan", 20), (2, "lisi", 30), (3, "wangwu", 40)], "id int, name string, age int")
    new = spark.createDataFrame([(1, "zhangsan", 60), (6, "tom", 30)], "id int, name string, age int")
    assert [r[0] for r in rows(N.insert_rows(base, new, ["id"]))] == [1, 2, 3, 6]
    assert rows(N.update_rows(base, new, ["id"]), "id", "age") == [(1, 60), (2, 30), (3, 40)]
    assert rows(N.delete_rows(base, base.where("age > 30"), ["id"]), "id") == [(1,), (2,)]
    assert rows(N.merge_rows(base, new, ["id"]), "id", "age") == [(1, 60), (2, 30), (3, 40), (6, 30)]


def test_replayed_version_counts_once_and_unfinished_is_ignored(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    part = spark.createDataFrame([("a", 1)], "k string, n int")
    for version in (0, 1, 1, 1):
        N.upsert(spark, path, part, ["k"], version, {"n": "add"})
    assert rows(N.read_snapshot(spark, path)) == [("a", 2)]
    os.makedirs(f"{path}/version=7")
    assert N.complete_versions(spark, path) == [0, 1]
    assert N.read_snapshot(spark, path, before=0) is None
    assert N.read_snapshot(spark, str(tmp_path / "none")) is None


def test_documents_merge_in_steps(spark, rows):
    cols = "device_type string, device_value string, model_type string, imei string, idfa string, ocpx_tag string, ocpx_time bigint, imp_count bigint, clk_time bigint, clk_count bigint"
    first = spark.createDataFrame([("imei_md5", "m1", "a", "86", None, "1", 50, 2, 0, 0), ("oaid", "plain", "a", None, None, None, 0, 1, 0, 0)], cols)
    second = spark.createDataFrame([("imei_md5", "m1", "a", None, None, None, 0, 3, 70, 1)], cols)
    delta = lambda d: N.document_delta(d, models=["a"])
    merged = N.merge_rows(delta(first), delta(second), ["id_kind", "id_md5"], N.document_modes(["a"]), default="keep_blank")
    got = rows(merged, "id_kind", "id_plain", "a_ocpx_tag", "a_ocpx_time", "a_clk_time", "a_imp_count", "a_clk_count")
    assert got == [("imei_md5", "86", "1", 50, 70, 5, 1), ("oaid_md5", "plain", None, None, None, 1, None)]


def test_split_files_stay_small(spark, tmp_path):
    path = tmp_path / "s"
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"), "id")
    W.write_split(df, str(path), ["k"], max_rows=50, salts=3)
    files = [p for p in path.rglob("part-*.csv")]
    assert max(len(p.read_text().splitlines()) for p in files) <= 50
    assert spark.read.csv(str(path)).count() == 1000 and len({p.parent.name for p in files}) == 5


def test_a_hot_key_is_written_by_as_many_tasks_as_its_rows_ask_for(spark, tmp_path):
    path = tmp_path / "s"
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") < 30, None).otherwise(F.concat(F.lit("k"), F.col("id") % 60)).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows end in one task
    try:
        W.write_split(df, str(path), ["k"], max_rows=5000, rows_per_task=300, header="true")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per = {}
    for p in path.rglob("part-*.csv"):
        per.setdefault(p.parent.name, []).append(len(p.read_text().splitlines()) - 1)
    assert len(per["k=hot"]) >= 4 and sum(per["k=hot"]) == 2666 and sum(map(sum, per.values())) == 4000
    assert all(len(n) == 1 for k, n in per.items() if k != "k=hot")


def test_write_partition_constants_and_defaults(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    for day, v in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-01", 3)):
        W.write_partition(spark.createDataFrame([(v,)], "v int"), path, {"etl_date": day})
    assert rows(spark.read.parquet(path).select("v", F.col("etl_date").cast("string"))) == [(2, "2024-01-02"), (3, "2024-01-01")]
    df = spark.createDataFrame([(None, None, None, None)], "i int, d decimal(18,3), s string, b boolean")
    r = W.fill_sink_defaults(df).first()
    assert (r.i, float(r.d), r.s, r.b) == (0, 0.0, None, False)


def test_expiring_keys_and_lists(spark, rows):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    keys = W.ttl_list(spark.createDataFrame([("ip", "1"), ("ip", "1")], "k string, v string"), "k", "v", 60, now)
    assert rows(W.live_keys(keys, now), "key", "value") == [("ct:ip:1", "1")]
    assert rows(W.live_keys(keys, now + F.expr("interval 61 seconds"))) == []
    ranked = spark.createDataFrame([("c", "x", 2), ("c", "y", 1), ("c", "z", 3)], "ch string, item string, rn int")
    assert W.publish_topn(ranked, "ch", "item", "rn", 2).first().asDict() == {"key": "TopN:c", "items": ["y", "x"]}


def data_files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (path / "data").rglob("part-*.parquet")}


def test_a_merge_rewrites_its_buckets_only(spark, rows, tmp_path):
    path = tmp_path / "t"
    frame = lambda pairs: spark.createDataFrame(pairs, "k int, n int, s string")
    assert len(B.merge_buckets(spark, str(path), frame([(i, 1, f"s{i}") for i in range(2000)]), ["k"], 0, 32, {"n": "add", "s": "keep_blank"})) == 32
    before = data_files(path)
    # one per cent of the keys, all in two buckets
    few = [r.k for r in spark.range(2000).selectExpr("cast(id as int) k").where(B.bucket_of(["k"], 32).isin(3, 17)).limit(20).collect()]
    for _ in range(2):  # the second time as after a failure
        assert B.merge_buckets(spark, str(path), frame([(k, 5, "") for k in few]), ["k"], 1, 32, {"n": "add", "s": "keep_blank"}) == [3, 17]
        after = data_files(path)
        assert {f: t for f, t in after.items() if "version=0" in f} == before
        assert {f.rpartition("/")[0].removeprefix("data/") for f in after if "version=1" in f} == {"version=1/bucket=3", "version=1/bucket=17"}
        got = {r.k: (r.n, r.s) for r in B.read_buckets(spark, str(path)).collect()}
        assert got == {i: (6 if i in few else 1, f"s{i}") for i in range(2000)}
    wanted = spark.createDataFrame([(few[0],), (5000,)], "k int")
    assert rows(B.read_buckets(spark, str(path), wanted, ["k"], 32), "k", "n") == [(few[0], 6)]


def test_unused_buckets_are_removed_and_unfinished_merges_do_not_count(spark, rows, tmp_path):
    path = tmp_path / "t"
    frame = lambda pairs: spark.createDataFrame(pairs, "k int, n int")
    for version in range(5):
        B.merge_buckets(spark, str(path), frame([(k, 1) for k in range(40)]), ["k"], version, 4, {"n": "add"})
    assert sorted(p.name for p in (path / "data").iterdir()) == ["version=3", "version=4"]
    assert N.complete_versions(spark, f"{path}/manifest") == [3, 4]
    os.makedirs(path / "data" / "version=5" / "bucket=0")  # a merge that broke off before its manifest
    assert rows(B.read_buckets(spark, str(path)).groupBy("n").count()) == [(5, 40)]
    assert B.merge_buckets(spark, str(path), frame([]), ["k"], 5, 4, {"n": "add"}) == []
    assert rows(B.read_buckets(spark, str(path)).groupBy("n").count()) == [(5, 40)]
    assert B.read_buckets(spark, str(tmp_path / "none")) is None


def test_a_merge_shuffles_its_buckets_once(spark, tmp_path):
    rows_ = spark.range(10).withColumns({"bucket": F.lit(1), "n": F.lit(1)})
    plan = N.merge_rows(rows_, rows_, ["bucket", "id"], together="bucket")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
