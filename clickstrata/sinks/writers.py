"""File and JDBC writers."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partition(df: DataFrame, path: str, parts: Mapping[str, object] | Sequence[str], fmt: str = "parquet") -> None:
    """Overwrite exactly the partitions present in ``df``; the rest of the table stays.

    ``parts`` names partition columns, or gives them with constant values.
    """
    if isinstance(parts, Mapping):
        df = df.withColumns({k: F.lit(v) for k, v in parts.items()})
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*list(parts)).format(fmt).save(path)


def write_dynamic(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Append into partitions named by column values."""
    df.write.mode("append").partitionBy(*by).format(fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_rows: int = 1000, **options: str) -> None:
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batch_rows).options(**options).save()


def fill_sink_defaults(df: DataFrame) -> DataFrame:
    """Nulls → 0 or false by column type; strings and other types keep their nulls."""
    def filled(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.NumericType, T.DecimalType)):
            return F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return F.coalesce(F.col(f.name), F.lit(False)).alias(f.name)
        return F.col(f.name)

    return df.select(*[filled(f) for f in df.schema.fields])


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def write_split(
    df: DataFrame, path: str, by: Sequence[str], max_rows: int, fmt: str = "csv", salts: int = 0, rows_per_task: int | None = None, **options: str,
) -> None:
    """One folder per key with files of at most ``max_rows`` rows.

    ``rows_per_task`` spreads each key over as many tasks as its own number of rows asks for, so a key with a third of all rows
    is written by many and a small one by a single task; it counts the keys first.  ``salts`` > 0 spreads every key over that many.
    """
    # A hash of the whole row, not a random number: a recomputed task writes the same rows.
    of_row, columns = F.xxhash64(*[F.col(c) for c in df.columns]), df.columns
    if rows_per_task:
        tasks = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_tasks"))
        keyed = tasks.select(*[F.col(k).alias(f"_k_{k}") for k in by], "_tasks")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by])
        spread = df.withColumn("_row", of_row).join(keyed, same).withColumn("_salt", F.pmod("_row", "_tasks"))
        df = spread.repartition(*by, "_salt").select(*columns)
    elif salts:
        df = df.repartition(*by, F.pmod(of_row, F.lit(salts)))
    df.write.mode("overwrite").partitionBy(*by).option("maxRecordsPerFile", max_rows).options(**options).format(fmt).save(path)


def export_gz(df: DataFrame, path: str, max_rows: int, value: str = "value") -> None:
    """Gzip text files of at most ``max_rows`` lines."""
    lines = df.select(F.col(value).cast("string").alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", max_rows).text(path)


def _archive(filesystem, path: str, attempt: str):
    """An open archive under a name of this attempt, and what gives it its name when it is whole."""
    hidden = f"{path.rpartition('/')[0]}/_{attempt}-{path.rpartition('/')[2]}"
    raw = filesystem.open_output_stream(hidden, compression=None)
    tar = tarfile.open(fileobj=raw, mode="w|gz")

    def commit() -> None:
        tar.close()
        raw.close()
        filesystem.move(hidden, path)

    return tar, commit


def write_targz(df: DataFrame, path: str, member: str, value: str, max_bytes: int = 64 << 20, member_bytes: int = 8 << 20, encoding: str = "utf-8") -> DataFrame:
    """Lines as ``.tar.gz`` archives, written where the rows are: (archive, members, lines, bytes), one row per archive.

    Lines of one ``member`` column follow each other in members of that name; one that has ``member_bytes`` goes on in another
    member, and an archive that has ``max_bytes`` of text is closed, so a task holds one member whatever the size
    of the table.  An archive is written under a name of its own attempt and gets its final one when it is whole: a task that
    runs again replaces its archives, and readers of ``*.tar.gz`` never see a part of one.  Null lines are empty.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = target.getFileSystem(spark._jsc.hadoopConfiguration())
    hadoop.mkdirs(target)
    uri = hadoop.makeQualified(target).toString()
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    rows = df.select(F.coalesce(F.col(member).cast("string"), F.lit("")).alias("m"), F.coalesce(F.col(value).cast("string"), F.lit("")).alias("v"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(uri)
        task = TaskContext.get()
        number, held, name, size = 0, io.BytesIO(), None, 0
        tar = commit = None
        counts = [0, 0, 0]
        done: list[tuple] = []

        def close_member() -> None:
            nonlocal held
            if name is not None:
                info = tarfile.TarInfo(name)
                info.size = held.tell()
                held.seek(0)
                tar.addfile(info, held)
                counts[0] += 1
                held = io.BytesIO()

        def close_archive() -> None:
            nonlocal tar, number
            commit()
            done.append((f"part-{task.partitionId():05d}-{number:04d}.tar.gz", *counts))
            counts[:] = [0, 0, 0]
            tar, number = None, number + 1

        for batch in batches:
            for m, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                line = v.encode(encoding) + b"\n"
                if m != name or held.tell() >= member_bytes:
                    if tar is not None:
                        close_member()
                        if counts[2] >= max_bytes:
                            close_archive()
                    name = m
                if tar is None:
                    tar, commit = _archive(filesystem, f"{base}/part-{task.partitionId():05d}-{number:04d}.tar.gz", f"{task.taskAttemptId()}")
                held.write(line)
                counts[1] += 1
                counts[2] += len(line)
        if tar is not None:
            close_member()
            close_archive()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "members", "lines", "bytes"])

    return rows.sortWithinPartitions("m").mapInArrow(write, "archive string, members bigint, lines bigint, bytes bigint")


def ttl_list(df: DataFrame, kind: str, value: str, ttl_seconds: int, now: Column, prefix: str = "ct", payload: Column | None = None) -> DataFrame:
    """Key-value rows ``<prefix>:<kind>:<value>`` with an expiry; one row per key."""
    key = F.concat_ws(":", F.lit(prefix), F.col(kind), F.col(value))
    rows = df.select(key.alias("key"), (payload if payload is not None else F.lit("1")).cast("string").alias("value"))
    return rows.groupBy("key").agg(F.max("value").alias("value")).withColumn("expires_at", now + F.expr(f"interval {int(ttl_seconds)} seconds"))


def live_keys(table: DataFrame, now: Column) -> DataFrame:
    """Keys that have not expired."""
    return table.where(F.col("expires_at") > now)


def publish_topn(df: DataFrame, key: str, item: str, rank: str, n: int, prefix: str = "TopN") -> DataFrame:
    """One ordered list per key, at most ``n`` long: (key, items)."""
    kept = df.where(F.col(rank) <= n)
    lists = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(rank, item))).alias("_l"))
    return lists.select(
        F.concat_ws(":", F.lit(prefix), F.col(key)).alias("key"), F.transform("_l", lambda x: x[item]).alias("items")
    )
