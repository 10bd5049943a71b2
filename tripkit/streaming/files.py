"""Structured Streaming: incremental file loads and event-time rollups (L1, L2).

L1: new monthly files arriving in a folder are picked up by the file source;
``trigger(availableNow=True)`` processes what is there and stops, so the same
job serves as a scheduled batch. The stream carries the paths of the files only:
each micro-batch reads its files with the drift-repairing batch reader, so
months of any physical schema load as they do in a batch. A micro-batch is
written with dynamic partition overwrite keyed by file name, so a replayed
batch (after an executor or driver loss) rewrites the same partitions: idempotent.

L2: hourly counts as tumbling event-time windows with a watermark; on the
same files the result equals the batch rollup. The sink holds one row per window:
a micro-batch replaces the days it touches in one commit (``ManagedTables``).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp
from ..session import cut_lineage
from ..sources.managed import ManagedTables
from ..sources.readers import read_trips
from ..sources.writers import replace_by_file


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file source with a declared schema and the file name column."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(source_dir)
    return df.withColumn("filename", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def path_stream(spark: SparkSession, source_dir: str, glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path) of arriving files, whatever their schema; their content is not read."""
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select("path")


def load_available(spark: SparkSession, source_dir: str, schema: T.StructType, table_dir: str,
                   checkpoint: str, normalise: Callable[[DataFrame], DataFrame] | None = None,
                   glob: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """L1: load every file not yet seen, one idempotent replace per file, then stop. Files are conformed to
    ``schema`` by ``read_trips``. A file that yields no rows leaves none behind."""
    def write_batch(batch: DataFrame, _epoch: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # names of this batch's new files
        if paths:
            rows = read_trips(spark, paths, "", schema=schema)
            replace_by_file(normalise(rows) if normalise else rows, table_dir, files=[p.rsplit("/", 1)[-1] for p in paths])

    q = (path_stream(spark, source_dir, glob, max_files_per_trigger).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def as_event_time(ts) -> "F.Column":
    """Naive clock -> instant read as UTC (watermarks need TIMESTAMP); the
    mapping uses no session zone, so hour windows follow the naive clock."""
    return F.timestamp_micros(tp.epoch_micros(ts))


def to_naive(ts) -> "F.Column":
    """Inverse of ``as_event_time``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def stream_counts(stream_df: DataFrame, ts: str, keys: Sequence[str], window: str = "1 hour",
                  watermark: str = "1 hour") -> DataFrame:
    """L2: tumbling event-time window counts with a watermark (append mode safe)."""
    return (stream_df.withColumn("_et", as_event_time(ts))
                     .withWatermark("_et", watermark)
                     .groupBy(F.window("_et", window).alias("w"), *keys)
                     .agg(F.count(F.lit(1)).alias("trips"))
                     .select(to_naive(F.col("w.start")).alias("window_start"), *keys, "trips"))


def upsert_windows(agg: DataFrame, table_dir: str, checkpoint: str, keys: Sequence[str]) -> None:
    """L2 sink: update mode, so only windows that changed arrive, with their count so far; the watermark
    lets state of closed windows go. Each micro-batch replaces the days it touches: their windows that
    did not change, and the new counts. A replayed batch writes the same rows again. Drains what is
    there (availableNow), then stops."""
    def write_batch(batch: DataFrame, _epoch: int) -> None:
        new = cut_lineage(batch.withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd")))
        days = [r[0] for r in new.select("window_day").distinct().collect()]  # bounded by the watermark
        tables = ManagedTables(new.sparkSession, table_dir, "window_day")
        if tables.current("windows").where("kept").isEmpty():
            rows = new
        else:
            old = tables.read("windows").where(F.col("window_day").isin(days))
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
            rows = old.alias("o").join(new.alias("n"), same, "left_anti").unionByName(new)
        if days:
            tables.replace({"windows": rows})

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()


def latest_windows(spark: SparkSession, table_dir: str, keys: Sequence[str], value: str) -> DataFrame:
    """The newest count of every window written by ``upsert_windows``: a row each."""
    return ManagedTables(spark, table_dir, "window_day").read("windows").select(*keys, value)
