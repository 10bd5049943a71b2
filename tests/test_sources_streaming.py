import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.plans.loads import EVENTS
from tripkit.sources import readers, schemas, writers, loaders
from tripkit.streaming import files as ST


def _yellow_rows(spark, n, start_id):
    return spark.createDataFrame(
        [(str(1 + i % 2), "2021-01-01 10:00:00", "2021-01-01 10:10:00", 1, 1.5, "1", "N", 1 + i % 5, 2, "1",
          10.0, 0.5, 0.5, 2.0, 0.0, 0.3, 13.3, 2.5) for i in range(start_id, start_id + n)],
        "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count int, "
        "trip_distance double, RatecodeID string, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
        "payment_type string, fare_amount double, extra double, mta_tax double, tip_amount double, "
        "tolls_amount double, improvement_surcharge double, total_amount double, congestion_surcharge double"
    ).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz")) \
     .withColumn("tpep_dropoff_datetime", F.col("tpep_dropoff_datetime").cast("timestamp_ntz"))


def test_schema_drift_repair(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "raw")
    base = _yellow_rows(spark, 4, 0)
    base.withColumn("airport_fee", F.lit(None)).coalesce(1).write.parquet(f"{d}/yellow_tripdata_2021-01.parquet")
    base.withColumn("Airport_fee", F.lit(1.25)).coalesce(1).write.parquet(f"{d}/yellow_tripdata_2021-02.parquet")
    base.withColumn("__index_level_0__", F.lit(7)).coalesce(1).write.parquet(f"{d}/yellow_tripdata_2021-03.parquet")
    paths = [f"{d}/yellow_tripdata_2021-0{m}.parquet" for m in (1, 2, 3)]
    df = readers.read_trips(spark, paths, "yellow")
    assert df.columns == [f.name for f in schemas.YELLOW.fields] + ["filename"]
    assert df.count() == 12
    fees = [r.s for r in df.groupBy("filename").agg(F.sum("airport_fee").alias("s")).collect()]
    assert len(fees) == 3 and sorted(fees, key=lambda v: (v is not None, v)) == [None, None, 5.0]
    legacy, modern = readers.split_by_era(["x/yellow_tripdata_2010-12.parquet", "x/yellow_tripdata_2011-01.parquet"])
    assert len(legacy) == 1 and len(modern) == 1


def test_reload_is_idempotent(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "raw")
    _yellow_rows(spark, 25, 0).coalesce(1).write.parquet(f"{d}/yellow_tripdata_2021-01.parquet")
    _yellow_rows(spark, 3, 100).coalesce(1).write.parquet(f"{d}/yellow_tripdata_2021-02.parquet")
    zones = spark.createDataFrame([(i, f"z{i}", "Manhattan") for i in range(1, 6)], "location_id int, zone string, borough string")
    table = os.path.join(tmpdir_path, "taxi_trips")
    for name in ("2021-01", "2021-02", "2021-01"):
        raw = readers.read_trips(spark, [f"{d}/yellow_tripdata_{name}.parquet"], "yellow")
        writers.replace_by_file(loaders.taxi_columnstore(raw, "yellow", zones), table)
    out = spark.read.parquet(table)
    assert out.count() == 28                                   # FIXTURES B3
    assert out.filter(F.col("pickup_borough") == "Manhattan").count() == 28


def test_csv_reader_month_first_and_nulls(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "uber.csv")
    with open(p, "w") as f:
        f.write("Date/Time,Lat,Lon,Base\n4/1/2014 0:11:00,40.769,-73.9549,B02512\n4/1/2014 0:17:00,,-73.9,\n")
    df = readers.read_csv(spark, p, schemas.UBER_2014_CSV)
    df = df.withColumn("t", readers.parse_us_timestamp("pickup_datetime"))
    rows = df.collect()
    assert str(rows[0].t) == "2014-04-01 00:11:00" and rows[1].pickup_latitude is None and rows[1].base_code is None


def test_stream_load_and_hourly_counts_equal_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.filter(F.dayofmonth("ts") <= 15).coalesce(1).write.parquet(f"{src}/part_a")
    ev.filter(F.dayofmonth("ts") > 15).coalesce(1).write.parquet(f"{src}/part_b")
    table, ckpt = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "c")
    ST.load_available(spark, src + "/*", EVENTS, table, ckpt)
    ST.load_available(spark, src + "/*", EVENTS, table, ckpt)          # rerun: nothing new, nothing doubled
    assert spark.read.parquet(table).count() == ev.count()
    s = ST.file_stream(spark, src + "/*", EVENTS)
    out = os.path.join(tmpdir_path, "h")

    def write(b, _):
        b.write.mode("overwrite").parquet(out)
    q = (ST.stream_counts(s, "ts", ["event_type"]).writeStream.outputMode("complete").foreachBatch(write)
           .option("checkpointLocation", os.path.join(tmpdir_path, "c2")).trigger(availableNow=True).start())
    q.awaitTermination()
    from tripkit.functions import timeparts as tp
    batch = ev.groupBy(tp.trunc_ts("hour", "ts").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("trips"))
    got = spark.read.parquet(out)
    assert got.exceptAll(batch.select(*got.columns)).count() == 0 and batch.count() == got.count()


def test_stream_of_drifted_months_equals_batch_and_survives_a_killed_batch(spark, tmpdir_path):
    import pytest
    src, table, ckpt = (os.path.join(tmpdir_path, d) for d in ("in", "t", "c"))
    base = _yellow_rows(spark, 6, 0)
    drop = lambda df, m: df.coalesce(1).write.parquet(f"{src}/yellow_tripdata_2021-{m}.parquet")
    drop(base.withColumn("airport_fee", F.lit(None)), "01")
    pattern = f"{src}/yellow_tripdata_*.parquet"
    ST.load_available(spark, pattern, schemas.YELLOW, table, ckpt)
    assert spark.read.parquet(table).count() == 6
    drop(base.withColumn("Airport_fee", F.lit(1.25)).drop("VendorID"), "02")
    drop(base.withColumn("passenger_count", F.lit(2).cast("double")), "03")

    def fails(df):
        raise RuntimeError("killed")

    with pytest.raises(Exception):
        ST.load_available(spark, pattern, schemas.YELLOW, table, ckpt, normalise=fails)
    for _ in range(2):                                     # the batch again, then nothing new
        ST.load_available(spark, pattern, schemas.YELLOW, table, ckpt)
        got = spark.read.parquet(table)
        batch = readers.read_trips(spark, src, "yellow")
        assert got.count() == 18 and got.select(*batch.columns).exceptAll(batch).count() == 0
    assert got.where("airport_fee = 1.25 AND vendor_id IS NULL").count() == 6


def test_window_counts_keep_one_row_a_window(spark, tmpdir_path):
    src, table, ckpt = (os.path.join(tmpdir_path, d) for d in ("in", "t", "c"))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id % 7 = 0")
    for k in range(2):                                     # the second file changes windows of the first
        ev.where(f"event_id % 2 = {k}").coalesce(1).write.parquet(f"{src}/part_{k}")
        s = ST.file_stream(spark, src + "/*", EVENTS)
        ST.upsert_windows(ST.stream_counts(s, "ts", ["event_type"], watermark="60 days"), table, ckpt, ["window_start", "event_type"])
    got = ST.latest_windows(spark, table, ["window_start", "event_type"], "trips")
    from tripkit.functions import timeparts as tp
    want = ev.groupBy(tp.trunc_ts("hour", "ts").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("trips"))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
