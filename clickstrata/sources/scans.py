"""Scans: partition predicates, date ranges, dimensions, named and archived files."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_partition(
    df: DataFrame, date: str, hour: str | None = None, date_col: str = "etl_date", hour_col: str = "etl_hour"
) -> DataFrame:
    """One day, or one hour of it.  The predicates stay on the bare columns so partitions are pruned."""
    df = df.where(F.col(date_col) == date)
    return df if hour is None else df.where(F.col(hour_col) == hour)


def read_hour_range(
    df: DataFrame, date: str, first: str, last: str, date_col: str = "etl_date", hour_col: str = "etl_hour"
) -> DataFrame:
    """Hours ``first``..``last`` of one day, both included."""
    return df.where((F.col(date_col) == date) & F.col(hour_col).between(first, last))


def read_date_range(
    df: DataFrame, end: str, days: int, inclusive: bool = True, date_col: str = "etl_date"
) -> DataFrame:
    """The ``days`` days up to ``end``.  ``inclusive=False`` starts after ``end - days`` and leaves the end open.

    Bounds are literals computed here, hence usable for partition pruning.
    """
    last = dt.date.fromisoformat(end)
    if inclusive:
        first = last - dt.timedelta(days=days - 1)
        return df.where(F.col(date_col).between(first.isoformat(), end))
    return df.where(F.col(date_col) > (last - dt.timedelta(days=days)).isoformat())


def read_days_of(df: DataFrame, days: DataFrame, date_col: str = "etl_date", day_col: str = "day") -> DataFrame:
    """Rows of the days in another table.

    A plain join on the partition column: Spark reads the days first and only then the partitions that they name (dynamic
    partition pruning), as long as ``days`` is itself filtered.
    """
    wanted = days.select(F.col(day_col).alias("_day")).distinct()
    return df.join(wanted, F.col(date_col) == F.col("_day")).drop("_day")


def load_dimensions(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", views: bool = True) -> dict[str, DataFrame]:
    """Dimension tables by name, optionally registered as temp views."""
    tables = {name: spark.read.format(fmt).load(path) for name, path in paths.items()}
    if views:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
    return tables


def read_jdbc_query(spark: SparkSession, url: str, table: str, where: str | None = None, columns: Sequence[str] = ("*",), **options: str) -> DataFrame:
    """A filtered table from a JDBC source; the subquery runs in the database.

    Pass ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` for a
    parallel read of a large table.
    """
    query = f"select {', '.join(columns)} from {table}" + (f" where {where}" if where else "")
    return spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t").options(**options).load()


def day_folders(spark: SparkSession, base: str, first: str | None = None, last: str | None = None, prefix: str = "") -> list[str]:
    """The folders ``base/<prefix><date>`` from ``first`` to ``last``, both included, in order; only ``base`` itself is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if s.isDirectory()]
    days = sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", n.removeprefix(prefix)))
    return [f"{base.rstrip('/')}/{prefix}{d}" for d in days if (first is None or d >= first) and (last is None or d <= last)]


def read_multi_day(
    spark: SparkSession, base: str, fmt: str = "text", date_col: str = "date", pattern: str = r"/(\d{4}-\d{2}-\d{2})(?:/|$)",
    first: str | None = None, last: str | None = None, **options: str,
) -> DataFrame:
    """Every ``base/<date>/`` folder in one read, each row tagged with its date taken from the file path.

    With ``first`` or ``last`` the files of other days are not even listed.  A range without a folder is an error, as a
    missing path is.
    """
    paths = [base] if first is None and last is None else day_folders(spark, base, first, last)
    if not paths:
        raise FileNotFoundError(f"no day from {first} to {last} below {base}")
    df = spark.read.option("recursiveFileLookup", "true").options(**options).format(fmt).load(paths)
    return df.withColumn(date_col, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def read_named_files(spark: SparkSession, path: str, name_col: str = "file_name") -> DataFrame:
    """Lines of text files with the name of the file each came from."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias(name_col), "value")


def read_gz_text(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of gzip files.  Gzip does not split: parallelism is one task per file."""
    return spark.read.text(glob)


def read_targz(spark: SparkSession, glob: str, encoding: str = "utf-8", batch_lines: int = 10_000) -> DataFrame:
    """Lines of the members of ``.tar.gz`` archives: (archive, member, value).

    Only paths travel through Spark; each task opens its archive through the
    Hadoop-visible file system and streams it, so a large archive is never held
    in memory.
    """
    # `length` keeps the scan from reading file contents: the archive itself is streamed below.
    files = spark.read.format("binaryFile").load(glob).select("path", "length")

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tarfile

        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
                filesystem, inner = fs.FileSystem.from_uri(uri)
                with filesystem.open_input_stream(inner, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
                    for member in tar:
                        handle = tar.extractfile(member) if member.isfile() else None
                        if handle is None:
                            continue
                        pending: list[str] = []
                        for line in handle:
                            pending.append(line.decode(encoding).rstrip("\r\n"))
                            if len(pending) == batch_lines:
                                yield pd.DataFrame({"archive": path, "member": member.name, "value": pending})
                                pending = []
                        if pending:
                            yield pd.DataFrame({"archive": path, "member": member.name, "value": pending})

    return files.mapInPandas(lines, "archive string, member string, value string")
