"""Keyed tables on plain files: merge rules and versioned snapshots.

A snapshot is written whole under ``version=N`` and counts only once its
``_SUCCESS`` marker exists.  A merge reads the newest complete version below
``N``, so running batch ``N`` again after a failure gives the same table, also
for additive columns.  One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import is_blank
from ..functions.identity import plain_and_md5


def merge_rows(
    base: DataFrame | None, updates: DataFrame, keys: Sequence[str], modes: Mapping[str, str] | None = None, default: str = "replace",
    together: str | None = None,
) -> DataFrame:
    """``base`` with ``updates`` applied by key, as one union and one aggregation.

    Modes per column: ``replace`` (the update's value, also null), ``keep_blank``
    (the update's value unless blank), ``add``, ``max``.  ``updates`` must have
    one row per key.  ``together`` names one of the keys whose rows shall end in one partition.
    """
    modes = modes or {}
    cols = [c for c in updates.columns if c not in keys]
    if base is None:
        return updates
    extra = [c for c in base.columns if c not in keys and c not in cols]
    rows = base.withColumn("_new", F.lit(False)).unionByName(updates.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    if together is not None:
        rows = rows.repartition(together)
    old, new = ~F.col("_new"), F.col("_new")

    def pick(c: str) -> Column:
        mode = modes.get(c, default)
        old_v, new_v = F.max(F.when(old, F.col(c))), F.max(F.when(new, F.col(c)))
        if mode == "add":
            return F.sum(c)
        if mode == "max":
            return F.max(c)
        if mode == "keep_blank":
            return F.coalesce(F.max(F.when(new & ~is_blank(c), F.col(c))), old_v)
        return F.when(F.max(F.col("_new")), new_v).otherwise(old_v)

    return rows.groupBy(*keys).agg(*[pick(c).alias(c) for c in cols], *[F.max(c).alias(c) for c in extra])


def insert_rows(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` plus those ``rows`` whose key it does not have."""
    return base.unionByName(rows.join(base.select(*keys), list(keys), "left_anti"))


def update_rows(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with matching rows replaced; unknown keys are ignored."""
    known = rows.join(base.select(*keys), list(keys), "left_semi")
    return base.join(known.select(*keys), list(keys), "left_anti").unionByName(known)


def delete_rows(base: DataFrame, keys_to_delete: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(keys_to_delete.select(*keys), list(keys), "left_anti")


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a snapshot whose write has finished, ascending."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    found = []
    for status in fs.listStatus(jvm_path):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def read_snapshot(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """Newest complete version (below ``before``); None when there is none."""
    versions = [v for v in complete_versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/version={versions[-1]}") if versions else None


def upsert(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], version: int,
    modes: Mapping[str, str] | None = None, default: str = "replace",
) -> None:
    """Merge ``updates`` into the snapshot at ``path`` and write it as ``version``."""
    base = read_snapshot(spark, path, before=version)
    merge_rows(base, updates, keys, modes, default).write.mode("overwrite").parquet(f"{path}/version={version}")


def document_delta(df: DataFrame, kind: str = "device_type", value: str = "device_value", model: str = "model_type", models: Sequence[str] = ()) -> DataFrame:
    """Crowd profiles → one flat row per (id kind, md5), one group of columns per model.

    Set-columns (``<model>_clk_time`` …) stay null when there is nothing to set;
    increment columns (``<model>_imp_count`` …) are null instead of 0.  Plain
    oaid values are hashed and kept beside the hash.
    """
    is_oaid = F.col(kind) == "oaid"
    oaid_plain, oaid_md5 = plain_and_md5(value)
    rows = df.select(
        F.when(is_oaid, F.lit("oaid_md5")).otherwise(F.col(kind)).alias("id_kind"),
        F.when(is_oaid, oaid_md5).otherwise(F.col(value)).alias("id_md5"),
        F.when(is_oaid, oaid_plain).when(F.col(kind) == "imei_md5", F.col("imei")).otherwise(F.col("idfa")).alias("id_plain"),
        F.col(model).alias("_m"), "ocpx_tag", "ocpx_time", "imp_count", "clk_time", "clk_count",
    )

    def non_zero(c: str) -> Column:
        return F.when(F.col(c) != 0, F.col(c))

    cols = [F.max(F.when(~is_blank("id_plain"), F.col("id_plain"))).alias("id_plain")]
    for m in models:
        mine = F.col("_m") == m
        cols += [
            F.max(F.when(mine & ~is_blank("ocpx_tag"), F.col("ocpx_tag"))).alias(f"{m}_ocpx_tag"),
            F.max(F.when(mine, non_zero("ocpx_time"))).alias(f"{m}_ocpx_time"),
            F.max(F.when(mine, non_zero("clk_time"))).alias(f"{m}_clk_time"),
            F.sum(F.when(mine, non_zero("imp_count"))).alias(f"{m}_imp_count"),
            F.sum(F.when(mine, non_zero("clk_count"))).alias(f"{m}_clk_count"),
        ]
    return rows.where(F.col("id_md5").isNotNull()).groupBy("id_kind", "id_md5").agg(*cols)


def document_modes(models: Sequence[str]) -> dict[str, str]:
    """Merge modes matching :func:`document_delta`: counts add up, everything else is set when present."""
    return reduce(lambda acc, m: acc | {f"{m}_imp_count": "add", f"{m}_clk_count": "add"}, models, {})
