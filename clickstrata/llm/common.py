"""Table access, scratch tables and text columns shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.session import scratch_path

#: ASCII white space; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of rows that cross between an executor and its Python worker at once; a longer row crosses alone.
BATCH_BYTES, BATCH_SETTING = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

#: Whether a query's shuffle files go when it ends, instead of whenever the driver collects its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Codec of scratch tables that hold whole texts; Spark's own choice takes half as much again.
TEXT_CODEC = "zstd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the folder that all executors share and read again.

    Used where a costly narrow result feeds several later jobs: it is computed
    once, survives the loss of executors, and its size is known to the planner.
    What was shuffled for it is needed by no later job and leaves the disk at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _setting(spark, CLEANUP_SETTING, "true"):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand rows to Python in Arrow batches of :data:`BATCH_BYTES`.

    Spark's own bound is 10,000 rows, which with texts is a whole input partition: both sides
    hold it at once, and executors and workers that live on keep much of what they once held.
    A frame that is returned lazily runs outside, under the caller's setting.
    """
    with _setting(spark, BATCH_SETTING, str(BATCH_BYTES)):
        yield


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
