"""Compare registered queries with their SQL: ``python -m tests.oracle [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = [tuple(None if r[i] is None else (type(r[i]).__name__, r[i]) for i in order) for r in rows]
    return names, sorted(out, key=repr)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return canonical(rel.columns, rel.fetchall())


def difference(left, right) -> str | None:
    """None when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns differ: spark {left[0]} sql {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"row counts differ: spark {len(left[1])} sql {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(left[0], a, b) if x != y]
        return f"{len(bad)} of {len(left[1])} rows differ, first: {cells}"
    return None


def main(argv: list[str]) -> int:
    from clickstrata import catalog
    from clickstrata.session import build_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = argv[1:]
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    spark = build_session("oracle", f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, sf_dir))
            took = time.time() - start
            problem = difference(got, duck_rows(con, sqls[name])) if name in sqls else None
            status = "ok" if problem is None else "DIFF"
            if not got[1]:
                status += " EMPTY"
            note = "" if name in sqls else " (rows only)"
        except Exception as e:  # report and go on with the next query
            took, status, problem, note, got = time.time() - start, "ERROR", str(e)[:700], "", ([], [])
        failed += status.split()[0] != "ok"
        print(f"{status:6} {name:34} rows={len(got[1]):6} {took:6.2f}s{note} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
