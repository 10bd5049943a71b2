"""Scans, load-time repair and streaming over the driver's tables (A1-A7,
A15, L1, L2). Streaming results are drained into fresh folders under the
session's shared checkpoint folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..sources import readers
from ..streaming import files as ST
from .registry import register

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()), T.StructField("l_comment", T.StringType()),
    T.StructField("l_airport_fee", T.DoubleType())])


@register("a1_a3_scan_provenance",
          "SELECT 'events.parquet' AS filename, event_type, count(*) AS trips FROM events GROUP BY ALL")
def a1_a3_scan_provenance(spark, sf_dir):
    """A1/A2/A3: declared-schema Parquet scan with the source file name."""
    df = readers.read_trips(spark, [f"{sf_dir}/events.parquet"], "events", schema=EVENTS)
    return df.groupBy("filename", "event_type").agg(F.count(F.lit(1)).alias("trips"))


@register("a5_a7_conform_drift", """SELECT l_returnflag, count(*) AS n, round(sum(l_tax), 2) AS sum_tax,
  count(CAST(NULL AS VARCHAR)) AS n_comment, count(CAST(NULL AS DOUBLE)) AS n_airport_fee
FROM lineitem GROUP BY l_returnflag""")
def a5_a7_conform_drift(spark, sf_dir):
    """A drifted frame (upper-case column, all-null column of null type,
    stray index column, missing column) conformed to the declared schema."""
    raw = (spark.read.parquet(f"{sf_dir}/lineitem.parquet")
                .withColumnRenamed("l_tax", "L_TAX")
                .withColumn("l_comment", F.lit(None))
                .withColumn("__index_level_0__", F.monotonically_increasing_id()))
    df = readers.conform(raw, LINEITEM)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_tax"), 2).alias("sum_tax"),
                                          F.count("l_comment").alias("n_comment"),
                                          F.count("l_airport_fee").alias("n_airport_fee"))


@register("a15_row_key_unique", "SELECT count(*) AS n, count(*) AS n_keys FROM lineitem")
def a15_row_key_unique(spark, sf_dir):
    """(file, row index) row keys are unique (hash collisions would show here)."""
    df = readers.row_key(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_id").alias("n_keys"))


def _scratch(spark, key):
    root = ensure_checkpoint_dir(spark)
    base = f"{root}/tripkit-streams/{key}-{uuid.uuid4().hex}"
    return f"{base}/table", f"{base}/checkpoint"


@register("l1_stream_file_load",
          "SELECT 'events.parquet' AS filename, event_type, count(*) AS trips FROM events GROUP BY ALL")
def l1_stream_file_load(spark, sf_dir):
    """L1: incremental file load (availableNow) with idempotent per-file replace."""
    table, ckpt = _scratch(spark, "l1")
    ST.load_available(spark, sf_dir, EVENTS, table, ckpt, glob="events.parquet")
    return spark.read.parquet(table).groupBy("filename", "event_type").agg(F.count(F.lit(1)).alias("trips"))


@register("l2_stream_hourly_counts", """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS trips
FROM events GROUP BY ALL""")
def l2_stream_hourly_counts(spark, sf_dir):
    """L2: hourly event-time window counts from the file stream; equals the batch rollup."""
    table, ckpt = _scratch(spark, "l2")
    s = ST.file_stream(spark, sf_dir, EVENTS, glob="events.parquet")
    agg = ST.stream_counts(s, "ts", ["event_type"], "1 hour", "1 hour")
    ST.upsert_windows(agg, table, ckpt, ["window_start", "event_type"])
    return ST.latest_windows(spark, table, ["window_start", "event_type"], "trips")
