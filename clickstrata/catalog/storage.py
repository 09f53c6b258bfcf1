"""Sinks: written below the shared scratch folder, read back and compared with what should be there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import buckets as B
from ..sinks import snapshots as N
from ..sinks import writers as W
from ..sources import scans as S
from ..sources.scans import load_dimensions, read_gz_text, read_named_files
from .devices import CROWD_SQL, crowd
from .registry import Tables, query, r
from .stand_ins import DEVICE_CTE, EVENTS_CTE, events


@query("write_partition_overwrite", f"WITH {EVENTS_CTE} SELECT event_type, event_id FROM ev WHERE event_type <> 'click' OR event_id % 2 = 0")
def _(t: Tables):
    path = scratch_path(t.spark, "partition")
    e = events(t).select("event_type", "event_id")
    W.write_partition(e, path, ["event_type"])
    # Rewriting one partition leaves the others alone.
    W.write_partition(e.where("event_type = 'click' and event_id % 2 = 0"), path, ["event_type"])
    return t.spark.read.parquet(path)


@query("write_dynamic_append", f"WITH {EVENTS_CTE} SELECT event_type, event_id FROM ev")
def _(t: Tables):
    path = scratch_path(t.spark, "dynamic")
    e = events(t).select("event_type", "event_id")
    for kind in ("view", "click", "purchase", "signup", "error"):
        W.write_dynamic(e.where(F.col("event_type") == kind), path, ["event_type"])
    return t.spark.read.parquet(path)


@query("write_split_by_key", f"WITH {EVENTS_CTE} SELECT event_type, event_id FROM ev")
def _(t: Tables):
    path = scratch_path(t.spark, "split")
    W.write_split(events(t).select("event_type", "event_id"), path, ["event_type"], max_rows=700, rows_per_task=500, header="true")
    return t.spark.read.option("header", "true").csv(path).select("event_type", F.col("event_id").cast("bigint").alias("event_id"))


@query("export_gzip_text", "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def _(t: Tables):
    path = scratch_path(t.spark, "gz")
    W.export_gz(t.orders, path, 5000, "o_orderkey")
    return read_gz_text(t.spark, f"{path}/*.gz")


@query("export_csv_named_files", "SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    W.export_csv(t.supplier.select("s_name", "s_nationkey"), path, sep="|")
    lines = read_named_files(t.spark, f"{path}/*.csv")
    return lines.where(F.col("file_name").startswith("part-")).select(F.split_part("value", F.lit("|"), F.lit(1)).alias("name"), F.split_part("value", F.lit("|"), F.lit(2)).alias("nation"))


@query("load_dimension_views", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t: Tables):
    load_dimensions(t.spark, {f"dim_{n}": f"{t.path}/{n}.parquet" for n in ("nation", "region")})
    return t.spark.sql("SELECT n_name, r_name FROM dim_nation JOIN dim_region ON n_regionkey = r_regionkey")


@query("upsert_add_and_replace", f"""WITH {EVENTS_CTE} SELECT user_id, count(*) AS n, {r("coalesce(max(value) FILTER (WHERE day > '2024-01-15'), max(value))")} AS last_max FROM ev GROUP BY user_id""")
def _(t: Tables):
    path = scratch_path(t.spark, "upsert")
    for version, cond in enumerate(["day <= '2024-01-15'", "day > '2024-01-15'"]):
        part = events(t).where(cond).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("last_max"))
        # The second run of version 1 must not count twice.
        for _ in range(1 + version):
            N.upsert(t.spark, path, part, ["user_id"], version, {"n": "add"})
    return N.read_snapshot(t.spark, path)


def late_max(rows):
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("last_max"))


@query("bucket_upsert", f"""WITH {EVENTS_CTE}, a AS (SELECT user_id, count(*) AS n FROM ev WHERE day <= '2024-01-28' OR user_id < 5 GROUP BY user_id),
m AS (SELECT user_id, max(value) FILTER (WHERE day <= '2024-01-15') AS m0, max(value) FILTER (WHERE day > '2024-01-15' AND day <= '2024-01-28') AS m1, max(value) FILTER (WHERE day > '2024-01-28' AND user_id < 5) AS m2 FROM ev GROUP BY user_id)
SELECT a.user_id, n, {r('coalesce(m2, m1, m0)')} AS last_max FROM a JOIN m ON a.user_id = m.user_id""")
def _(t: Tables):
    path = scratch_path(t.spark, "buckets")
    e = events(t)
    # The third merge touches the buckets of a few users only; running the second one twice counts once.
    merges = [(0, "day <= '2024-01-15'"), (1, "day > '2024-01-15' AND day <= '2024-01-28'"), (1, "day > '2024-01-15' AND day <= '2024-01-28'"), (2, "day > '2024-01-28' AND user_id < 5")]
    for version, cond in merges:
        B.merge_buckets(t.spark, path, late_max(e.where(cond)), ["user_id"], version, 16, {"n": "add"})
    return B.read_buckets(t.spark, path)


def stored_log(t: Tables, *parts: str):
    """The events as a table with a folder per day, or per day and hour."""
    path = scratch_path(t.spark, "log")
    e = events(t).select("event_id", "user_id", "event_type", F.col("day").alias("etl_date"), F.col("hour").alias("etl_hour"))
    W.write_dynamic(e.repartition(16, "etl_date"), path, parts)
    return t.spark.read.schema("event_id bigint, user_id bigint, event_type string, etl_date string, etl_hour string").parquet(path)


@query("pruned_hour_range", f"WITH {EVENTS_CTE} SELECT event_id, user_id, hour AS etl_hour FROM ev WHERE day = '2024-01-07' AND hour BETWEEN '03' AND '05'")
def _(t: Tables):
    return S.read_hour_range(stored_log(t, "etl_date", "etl_hour"), "2024-01-07", "03", "05").select("event_id", "user_id", "etl_hour")


@query("pruned_half_open_days", f"WITH {EVENTS_CTE} SELECT day AS etl_date, event_type, count(*) AS n FROM ev WHERE day > '2024-01-26' GROUP BY ALL")
def _(t: Tables):
    days = S.read_date_range(stored_log(t, "etl_date"), "2024-01-28", 2, inclusive=False)
    return days.groupBy("etl_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("pruned_days_of_dimension", f"WITH {EVENTS_CTE}, d AS (SELECT day FROM ev WHERE event_type = 'error' GROUP BY day HAVING count(*) >= (SELECT max(c) FROM (SELECT count(*) AS c FROM ev WHERE event_type = 'error' GROUP BY day))) SELECT ev.day AS etl_date, user_id, count(*) AS n FROM ev JOIN d ON ev.day = d.day GROUP BY ALL")
def _(t: Tables):
    # The days with the most errors, known only when the query runs.
    errors = events(t).where("event_type = 'error'").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    worst = errors.where(F.col("n") >= errors.agg(F.max("n")).scalar())
    return S.read_days_of(stored_log(t, "etl_date"), worst).groupBy("etl_date", "user_id").agg(F.count(F.lit(1)).alias("n"))


@query("multi_day_folders", f"WITH {EVENTS_CTE} SELECT day AS date, 'e' || event_id AS value FROM ev WHERE day BETWEEN '2024-01-09' AND '2024-01-11'")
def _(t: Tables):
    path = scratch_path(t.spark, "days")
    lines = events(t).select(F.concat(F.lit("e"), F.col("event_id")).alias("value"), F.col("day").alias("d"))
    for day in ("2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12"):
        lines.where(F.col("d") == day).select("value").write.text(f"{path}/{day}")
    return S.read_multi_day(t.spark, path, first="2024-01-09", last="2024-01-11").select("date", "value")


@query("archive_members", "SELECT o_orderpriority || '.txt' AS member, o_orderkey || '|' || o_orderstatus AS value FROM orders")
def _(t: Tables):
    path = scratch_path(t.spark, "archives")
    lines = t.orders.select(F.concat("o_orderpriority", F.lit(".txt")).alias("member"), F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value"))
    W.write_targz(lines, path, "member", "value", max_bytes=50_000, member_bytes=20_000).collect()
    return S.read_targz(t.spark, f"{path}/*.tar.gz").select("member", "value")


@query("row_store_changes", """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 'inserted' FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 7 = 0 AND c_custkey % 5 <> 0""")
def _(t: Tables):
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    table = N.insert_rows(c.where("id % 2 = 0"), c.where("id % 7 = 0").withColumn("segment", F.lit("inserted")), ["id"])
    table = N.update_rows(table, c.where("id % 6 = 0").withColumn("segment", F.lit("new")), ["id"])
    return N.delete_rows(table, c.where("id % 5 = 0"), ["id"])


@query("document_delta", f"""WITH {DEVICE_CTE}, {CROWD_SQL}, dd AS (SELECT CASE device_type WHEN 'oaid' THEN 'oaid_md5' ELSE device_type END AS id_kind, CASE device_type WHEN 'oaid' THEN md5(device_value) ELSE device_value END AS id_md5,
 CASE device_type WHEN 'oaid' THEN device_value WHEN 'imei_md5' THEN imei ELSE idfa END AS id_plain, * FROM cp)
SELECT id_kind, id_md5, max(nullif(id_plain, '')) AS id_plain, {', '.join(f"max(nullif(ocpx_tag, '')) FILTER (WHERE model_type = '{m}') AS {m}_ocpx_tag, max(nullif(ocpx_time, 0)) FILTER (WHERE model_type = '{m}') AS {m}_ocpx_time, max(nullif(clk_time, 0)) FILTER (WHERE model_type = '{m}') AS {m}_clk_time, CAST(sum(nullif(imp_count, 0)) FILTER (WHERE model_type = '{m}') AS BIGINT) AS {m}_imp_count, CAST(sum(nullif(clk_count, 0)) FILTER (WHERE model_type = '{m}') AS BIGINT) AS {m}_clk_count" for m in ('m1', 'm2'))}
FROM dd GROUP BY id_kind, id_md5""")
def _(t: Tables):
    return N.document_delta(crowd(t), models=["m1", "m2"])


@query("sink_defaults", f"SELECT c_custkey, CAST(coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END, 0) AS BIGINT) AS nation, {r('coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END, 0)')} AS balance, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS segment FROM customer")
def _(t: Tables):
    k = F.col("c_custkey")
    return W.fill_sink_defaults(t.customer.select("c_custkey", F.when(k % 2 == 0, F.col("c_nationkey")).alias("nation"), F.when(k % 3 == 0, F.col("c_acctbal")).alias("balance"), F.when(k % 5 == 0, F.col("c_mktsegment")).alias("segment")))


@query("expiring_keys", f"WITH {EVENTS_CTE} SELECT DISTINCT 'ct:' || event_type || ':' || user_id AS key, '1' AS value FROM ev WHERE k < 20")
def _(t: Tables):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    e = events(t).withColumn("u", F.col("user_id").cast("string"))
    fresh = W.ttl_list(e.where("k < 20"), "event_type", "u", 86400, now)
    stale = W.ttl_list(e.where("k >= 20"), "event_type", "u", 60, now - F.expr("interval 1 day"))
    return W.live_keys(fresh.unionByName(stale), now).select("key", "value")
