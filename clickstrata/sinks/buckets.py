"""A keyed table in hash buckets: a merge rewrites the buckets that its keys fall into, and no others.

``data/version=N/bucket=B`` holds what merge ``N`` wrote; ``manifest/version=N`` names the version in which each
bucket lies after it and counts once its ``_SUCCESS`` marker exists.  A merge starts from the newest complete manifest below
its own version, so running it again, also after a failure, gives the same table.  The two newest manifests and what they
name are kept, the rest is removed after the commit.  One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import complete_versions, merge_rows

KEPT = 2


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def manifest(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """Bucket → version of the newest complete manifest (below ``before``); at most one entry per bucket."""
    versions = [v for v in complete_versions(spark, f"{path}/manifest") if before is None or v < before]
    if not versions:
        return {}
    return {r["bucket"]: r["at"] for r in spark.read.parquet(f"{path}/manifest/version={versions[-1]}").collect()}


def _folders(spark: SparkSession, path: str, where: Mapping[int, int]) -> DataFrame | None:
    if not where:
        return None
    return spark.read.parquet(*[f"{path}/data/version={v}/bucket={b}" for b, v in sorted(where.items())])


def read_buckets(spark: SparkSession, path: str, keys: DataFrame | None = None, key_cols: Sequence[str] = (), buckets: int = 0) -> DataFrame | None:
    """The table, or with ``keys`` (and the table's number of buckets) only the rows of those keys, read from their buckets."""
    where = manifest(spark, path)
    if keys is None:
        return _folders(spark, path, where)
    wanted = {r[0] for r in keys.select(bucket_of(key_cols, buckets)).distinct().collect()}
    found = _folders(spark, path, {b: v for b, v in where.items() if b in wanted})
    return None if found is None else found.join(keys.select(*key_cols).distinct(), list(key_cols), "left_semi")


def merge_buckets(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], version: int, buckets: int,
    modes: Mapping[str, str] | None = None, default: str = "replace",
) -> list[int]:
    """Merges ``updates`` (one row per key) by the rules of :func:`merge_rows` and commits them as ``version``; returns the buckets written.

    ``buckets`` belongs to the table and stays the same.  Old rows are read from the touched buckets only, and all rows of a
    bucket meet in the shuffle that merges them, so the merge costs one shuffle of the touched buckets.
    """
    fs, committed = _filesystem(spark, f"{path}/manifest/version={version}")
    fs.delete(committed, True)  # a merge that runs again isn't committed until it has ended again
    where = manifest(spark, path, before=version)
    rows = updates.withColumn("bucket", bucket_of(keys, buckets))
    touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())
    base = _folders(spark, path, {b: where[b] for b in touched if b in where})
    if base is not None:
        base = base.withColumn("bucket", bucket_of(keys, buckets))
    if touched:
        folded = merge_rows(rows if base is None else base, rows, ["bucket", *keys], modes, default, together="bucket")
        # sums are wider than what they add; the table keeps the types of its first merge
        types = dict((folded if base is None else base).dtypes)
        merged = (rows.repartition("bucket") if base is None else folded).select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
        merged.write.mode("overwrite").partitionBy("bucket").option("maxRecordsPerFile", 0).parquet(f"{path}/data/version={version}")
    after = {**where, **dict.fromkeys(touched, version)}
    entries = spark.createDataFrame(sorted(after.items()), "bucket int, at int").coalesce(1)
    entries.write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    _remove_unused(spark, path)
    return touched


def _remove_unused(spark: SparkSession, path: str) -> None:
    """Removes manifests but the newest ones, and bucket folders that none of these names."""
    versions = complete_versions(spark, f"{path}/manifest")
    kept = versions[-KEPT:]
    used = {(v, b) for k in kept for b, v in manifest(spark, path, before=k + 1).items()}
    fs, data = _filesystem(spark, f"{path}/data")
    if not fs.exists(data):
        return
    for folder in fs.listStatus(data):
        number = int(folder.getPath().getName().partition("=")[2])
        if number > versions[-1]:
            continue
        inside = [x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("bucket=")]
        unused = [p for p in inside if (number, int(p.getName().partition("=")[2])) not in used]
        if len(unused) == len(inside):
            fs.delete(folder.getPath(), True)
        else:
            for p in unused:
                fs.delete(p, True)
    for v in versions[:-KEPT]:
        fs.delete(_filesystem(spark, f"{path}/manifest/version={v}")[1], True)
