"""Parsers and readers."""

from __future__ import annotations

import io
import tarfile

import pytest

from clickstrata.sources import lines as L
from clickstrata.sources import scans as S


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_tsv_short_rows_blanks_and_bad_numbers(spark, rows):
    layout = {"id": (0, "int"), "name": (1, "string"), "last": (2, "string")}
    df = text(spark, "1\t a \t", "x\tb\tc", "2\tc")
    assert rows(L.parse_tsv(df, layout, min_cols=3)) == [(1, "a", ""), (None, "b", "c")]
    # Trailing empties do not count when they are not kept.
    assert rows(L.parse_tsv(df, layout, min_cols=3, keep_empty=False)) == [(None, "b", "c")]


def test_separators(spark, rows):
    layout = {"a": (0, "string"), "b": (1, "string")}
    for sep in ("|", "#", "\x01"):
        assert rows(L.parse_sep(text(spark, f"x{sep}y", "z"), sep, layout, exact_cols=2)) == [("x", "y")]


def test_marked_kv(spark, rows):
    df = text(spark, "t [[[ts=5&uid=u&cnt=x]]] e", "no marker", "[[[ts=6&uid=v&uid=w&cnt=2]]]")
    assert rows(L.parse_marked_kv(df, {"ts": "bigint", "uid": "string", "cnt": "bigint"})) == [(5, "u", None), (6, "w", 2)]


def test_access_line(spark):
    good = '"1.2.3.4"\t-\t[27/Jul/2020:01:34:19 -0700]"PUT /api/v1/adsync?ad=a1&event=3&msg=&os=android&uid=u1&ver=5.9.0 HTTP/1.1"\t200\t0.000\t32\t"-"\t"Dalvik"\t"-"'
    out = L.parse_access_line(text(spark, good, "a\tb", good.replace("27/Jul", "99/Xyz"))).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.date, row.hour, row.ip, row.resp_code) == ("2020-07-27", "01", '"1.2.3.4"', "200")
    assert row.url.asDict() == {"event": "3", "ad": "a1", "ver": "5.9.0", "uid": "u1", "os": "android", "msg": ""}


def test_date_ranges(spark, rows):
    df = spark.createDataFrame([(f"2024-01-0{i}",) for i in range(1, 8)], "etl_date string")
    assert [r[0][-1] for r in rows(S.read_date_range(df, "2024-01-05", 3))] == ["3", "4", "5"]
    assert [r[0][-1] for r in rows(S.read_date_range(df, "2024-01-05", 2, inclusive=False))] == ["4", "5", "6", "7"]


def test_partition_predicates_prune(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", "01", 1), ("2024-01-01", "02", 2), ("2024-01-02", "01", 3)], "etl_date string, etl_hour string, v int")
    df.write.partitionBy("etl_date", "etl_hour").parquet(str(tmp_path / "t"))
    table = spark.read.option("basePath", str(tmp_path / "t")).schema("v int, etl_date string, etl_hour string").parquet(str(tmp_path / "t"))
    plan = S.read_partition(table, "2024-01-01", "02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(etl_date" in plan and "PushedFilters: []" in plan
    assert [r.v for r in S.read_partition(table, "2024-01-01", "02").collect()] == [2]


def test_multi_day_and_named_files(spark, rows, tmp_path):
    for day, line in (("2024-01-01", "a"), ("2024-01-02", "b")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "part.txt").write_text(line + "\n")
    assert rows(S.read_multi_day(spark, str(tmp_path)), "date", "value") == [("2024-01-01", "a"), ("2024-01-02", "b")]
    assert rows(S.read_named_files(spark, str(tmp_path / "*"))) == [("part.txt", "a"), ("part.txt", "b")]


def test_targz_members_line_by_line(spark, rows, tmp_path):
    path = tmp_path / "logs.tar.gz"
    with tarfile.open(path, "w:gz") as tar:
        for name, body in (("d/a.txt", "l1\nl2\n"), ("b.txt", "l3"), ("empty.txt", "")):
            data = body.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = rows(S.read_targz(spark, str(tmp_path / "*.tar.gz"), batch_lines=1), "member", "value")
    assert got == [("b.txt", "l3"), ("d/a.txt", "l1"), ("d/a.txt", "l2")]


def log_table(spark, path):
    rows = [(f"2024-01-{d:02d}", f"{h:02d}", d * 100 + h) for d in range(1, 8) for h in range(3)]
    spark.createDataFrame(rows, "etl_date string, etl_hour string, v int").write.partitionBy("etl_date", "etl_hour").parquet(path)
    return spark.read.schema("v int, etl_date string, etl_hour string").parquet(path)


def partitions_read(df):
    """Partition folders that the scan of a collected query has read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
        if "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(plan)
    return found


def test_ranges_read_only_their_partitions(spark, tmp_path):
    table = log_table(spark, str(tmp_path / "t"))
    assert partitions_read(S.read_hour_range(table, "2024-01-03", "01", "02")) == [2]
    assert partitions_read(S.read_date_range(table, "2024-01-05", 3)) == [9]
    assert partitions_read(S.read_date_range(table, "2024-01-05", 2, inclusive=False)) == [12]


def test_days_of_another_table_prune_while_the_query_runs(spark, rows, tmp_path):
    table = log_table(spark, str(tmp_path / "t"))
    spark.createDataFrame([("2024-01-02", "x"), ("2024-01-06", "x"), ("2024-01-06", "x"), ("2024-01-04", "y")], "day string, kind string").write.parquet(str(tmp_path / "d"))
    got = S.read_days_of(table, spark.read.parquet(str(tmp_path / "d")).where("kind = 'x'"))
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "v") == [(v,) for v in (200, 201, 202, 600, 601, 602)]


def test_only_wanted_day_folders_are_read(spark, rows, tmp_path):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "other"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "part.txt").write_text(f"of {day}\n")
    (tmp_path / "2024-01-02" / "deeper").mkdir()
    (tmp_path / "2024-01-02" / "deeper" / "part.txt").write_text("deep\n")
    got = S.read_multi_day(spark, str(tmp_path), first="2024-01-02", last="2024-01-09")
    assert rows(got, "date", "value") == [("2024-01-02", "deep"), ("2024-01-02", "of 2024-01-02"), ("2024-01-03", "of 2024-01-03")]
    assert all("2024-01-01" not in f and "other" not in f for f in got.inputFiles())
    with pytest.raises(FileNotFoundError):
        S.read_multi_day(spark, str(tmp_path), first="2025-01-01")


def test_archives_written_in_tasks_are_bounded_and_whole(spark, rows, tmp_path):
    from clickstrata.sinks import writers as W

    path = tmp_path / "a"
    data = [(f"m{i % 3}", f"line {i} é") for i in range(3000)] + [("m1", None), (None, "no name"), ("m0", "")]
    told = W.write_targz(spark.createDataFrame(data, "m string, v string").repartition(3), str(path), "m", "v", max_bytes=4000, member_bytes=1500).collect()
    files = sorted(p.name for p in path.iterdir() if not p.name.endswith(".crc"))
    assert files == sorted(r.archive for r in told) and len(files) > 5
    assert sum(r.lines for r in told) == len(data) and max(r.bytes for r in told) < 6000
    with tarfile.open(path / files[0]) as tar:
        assert all(m.size <= 1500 + 20 for m in tar.getmembers())
    assert rows(S.read_targz(spark, f"{path}/*.tar.gz"), "member", "value") == sorted((m or "", v or "") for m, v in data)
