"""Reading, running and storing streams."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import is_blank
from ..sinks.snapshots import complete_versions, upsert

BatchSink = Callable[[DataFrame, int], None]


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None, **options: str) -> DataFrame:
    """A topic as a ``value`` string column (needs the Kafka connector on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting).options(**options)
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream; a path that is one file is a stream of that file."""
    if is_file(spark, path):
        path, _, glob = path.rpartition("/")
    reader = spark.readStream.format(fmt).schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def run_stream(
    df: DataFrame, sink: BatchSink, checkpoint: str, output_mode: str = "append", interval: str | None = None,
    stop_marker: str | None = None, poll_seconds: float = 5.0,
) -> StreamingQuery:
    """Run a stream into ``sink`` with a resumable checkpoint.

    Without ``interval`` everything available is processed and the query ends.
    With it the query runs in micro-batches until it fails or a file appears at
    ``stop_marker``; a batch cut short by the stop is replayed on restart.
    """
    spark = df.sparkSession
    writer = df.writeStream.foreachBatch(sink).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if interval is None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    query = writer.trigger(processingTime=interval).start()
    while not query.awaitTermination(poll_seconds):
        if stop_marker is not None and path_exists(spark, stop_marker):
            query.stop()
            break
    return query


def change_log_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchSink:
    """Writes each micro-batch as ``path/batch=N``.  A replayed batch overwrites its own folder, so nothing counts twice.

    The cost of a batch is its own rows; merging happens on read or in a
    periodic compaction.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Several outputs from one batch, which is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def open_change_log(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """All rows of a change log with their ``batch``; before the first batch an empty frame with the columns of ``like``."""
    if like is not None and not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([*like.schema.fields, T.StructField("batch", T.IntegerType())]))
    return spark.read.parquet(path)


def read_change_log(
    spark: SparkSession, path: str, keys: Sequence[str], modes: Mapping[str, str] | None = None, default: str = "replace", like: DataFrame | None = None,
) -> DataFrame:
    """Merged view of a change log: per key, ``replace`` (newest batch), ``keep_blank`` (newest non-blank), ``add`` or ``max`` per column."""
    return merge_change_log(open_change_log(spark, path, like), keys, modes, default)


def merge_change_log(log: DataFrame, keys: Sequence[str], modes: Mapping[str, str] | None = None, default: str = "replace") -> DataFrame:
    """The same for an opened log with its ``batch`` column; one aggregation."""
    modes = modes or {}
    cols = [c for c in log.columns if c not in (*keys, "batch")]

    def pick(c: str):
        mode = modes.get(c, default)
        if mode == "add":
            return F.sum(c)
        if mode == "max":
            return F.max(c)
        entry = F.struct(F.col("batch").alias("b"), F.col(c).alias("v"))
        return F.max(F.when(~is_blank(c), entry) if mode == "keep_blank" else entry).getField("v")

    return log.groupBy(*keys).agg(*[pick(c).alias(c) for c in cols])


def fold_change_log(
    spark: SparkSession, log_path: str, snapshot_path: str, keys: Sequence[str], upto: int,
    modes: Mapping[str, str] | None = None, default: str = "replace",
) -> None:
    """Merge the batches after the last fold, up to ``upto``, into a snapshot, which takes ``upto`` as its version.

    Running it again, also after a failure, gives the same snapshot.  Current
    values are then the snapshot merged with the batches above its version.
    """
    done = [v for v in complete_versions(spark, snapshot_path) if v < upto]
    log = spark.read.parquet(log_path).where((F.col("batch") > (done[-1] if done else -1)) & (F.col("batch") <= upto))
    upsert(spark, snapshot_path, merge_change_log(log, keys, modes, default), keys, upto, modes, default)
