"""Loads and sinks over raw-shaped files built from the driver's tables (M1-M7,
A4, A8-A12, A14, A21, B1, B2, B3, B4, B5, B7, B8, B10).

Each query writes raw files (Parquet months or CSV, with the raw spellings and
column names of their era) into a fresh shared folder, runs reader, loader and
sink over them, reads the result back and summarises it. The oracles state what
each raw value must become by its place in the list of spellings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..operators import relational as Rel
from ..session import shared_dir
from ..sources import loaders, readers, schemas, writers
from .bindings import EV_TRIPS_SQL, ZONES_SQL, ev_trips, read, with_ctes, zones
from .cleansing import RAW_BASE, RAW_FLAG, RAW_LICENCE, RAW_PAYMENT, RAW_RATE, RAW_STORE, RAW_VENDOR, _pick
from .market import zone_polygons
from .registry import register

#: Borough names of the region keys, so that the borough rule has names to keep.
BOROUGH_OF = {"AFRICA": "Bronx", "AMERICA": "Manhattan", "ASIA": "Queens", "EUROPE": "Brooklyn", "MIDDLE EAST": "Newark Bay"}


def _folder(spark, name):
    return f"{shared_dir(spark)}/loads-{uuid.uuid4().hex}/{name}"


def _month_file(df, folder, dataset, month):
    """One raw monthly data set named as the publisher names it; returns its path."""
    path = f"{folder}/{dataset}_tripdata_{month}.parquet"
    df.write.parquet(path)
    return path


def _of(values, key="trip_id"):
    """SQL list access: the entry of a row by its key."""
    lit = ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'" for v in values)
    return f"[{lit}][{key} % {len(values)} + 1]"


# What the raw spellings become, in the order of the RAW_* lists.
VENDOR = [1, 2, 1, 2, 3, None, None]
RATE = [1, 6, None, None, 3, None]
STORE = [True, True, False, None, False, False]
PAYMENT = [1, 2, 3, 4, 5, None, 2, 2]
EXACT_YN = [None, None, True, False, None, None, None]
ROWSTORE_FLAG = [None, True, True, False, None, False, None]
ROWSTORE_FLAG_BLANK_FALSE = [False, True, True, False, False, False, None]
COLUMN_FLAG = [None, None, True, False, False, None, None]
BASE = ["B02510", "B02800", "B99999", "B02764", "B02907", None]
COMPANY = ["lyft", "via", "other", "uber", "juno", "other"]
LICENCE_COMPANY = ["uber", "lyft", None, "juno", "via"]


def boroughs(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for kv in BOROUGH_OF.items() for x in kv])
    return zones(spark, sf_dir).withColumn("borough", names[F.col("borough")])


BOROUGH_SQL = "SELECT location_id, CASE borough " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in BOROUGH_OF.items() if v != "Newark Bay") + " END AS borough FROM zones"


def _yellow(spark, sf_dir):
    t = ev_trips(spark, sf_dir)
    pick = lambda v: _pick(v, "trip_id")
    return t.select(
        "trip_id", pick(RAW_VENDOR).alias("VendorID"), F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"), F.lit(1).alias("passenger_count"), "trip_distance",
        pick(RAW_RATE).alias("RatecodeID"), pick(RAW_STORE).alias("store_and_fwd_flag"),
        F.col("pickup_location_id").alias("PULocationID"), F.col("dropoff_location_id").alias("DOLocationID"),
        pick(RAW_PAYMENT).alias("payment_type"), "fare_amount", F.lit(0.5).alias("extra"), F.lit(0.5).alias("mta_tax"),
        "tip_amount", F.lit(0.0).alias("tolls_amount"), (F.col("fare_amount") + 1).alias("total_amount"))


def _yellow_files(spark, sf_dir, name):
    """A modern month, and a legacy month with coordinates in place of zone ids (A4)."""
    folder, y = _folder(spark, name), _yellow(spark, sf_dir)
    k = F.col("trip_id") % 5
    _month_file(y.filter("trip_id % 2 = 0").drop("trip_id").withColumns(
        {"improvement_surcharge": F.lit(0.3), "Airport_fee": F.lit(None), "__index_level_0__": F.lit(1)}), folder, "yellow", "2014-03")
    legacy = y.filter("trip_id % 2 = 1").withColumns({
        # a corner zone's middle; every fifth trip has the zero coordinate of a missing fix
        "pickup_longitude": F.when(k == 0, 0.0).otherwise(k * 2.6 + 1.3), "pickup_latitude": F.when(k == 0, 0.0).otherwise(F.lit(1.3)),
        "dropoff_longitude": F.lit(1.3), "dropoff_latitude": F.lit(500.0)}).drop("trip_id", "PULocationID", "DOLocationID")
    _month_file(legacy, folder, "yellow", "2009-07")
    return folder


@register("m2_yellow_load", with_ctes(f"""
SELECT {_of(VENDOR)} AS vendor_id, {_of(RATE)} AS rate_code_id, {_of(STORE)} AS store_and_fwd_flag, {_of(PAYMENT)} AS payment_type,
  CASE WHEN trip_id % 2 = 0 THEN pickup_location_id WHEN trip_id % 5 > 0 THEN 100 + CAST(trip_id % 5 AS INTEGER) END AS pickup_location_id,
  CASE WHEN trip_id % 2 = 0 THEN dropoff_location_id END AS dropoff_location_id,
  count(*) AS trips, CAST(count(*) FILTER (trip_id % 2 = 1 AND trip_id % 5 > 0) AS BIGINT) AS located, round(sum(fare_amount), 4) AS fare
FROM trips GROUP BY ALL""", trips=EV_TRIPS_SQL))
def m2_yellow_load(spark, sf_dir):
    """M2 / A2 / A4: yellow months of both eras from one folder, cleansed, legacy zones
    filled in from the coordinates (tract = zone rectangle, tract -> zone by adding 100)."""
    raw = readers.read_trips(spark, _yellow_files(spark, sf_dir, "yellow"), "yellow_any")
    tracts = zone_polygons(spark, sf_dir).withColumnRenamed("location_id", "gid")
    to_zone = tracts.select(F.col("gid").alias("tract_id"), (F.col("gid") + 100).alias("taxi_zone_location_id"))
    out = loaders.yellow_rowstore(raw, tracts, to_zone, cell=2.0)
    return out.groupBy("vendor_id", "rate_code_id", "store_and_fwd_flag", "payment_type",
                       F.col("pickup_location_id").cast("int").alias("pickup_location_id"),
                       F.col("dropoff_location_id").cast("int").alias("dropoff_location_id")).agg(
        F.count(F.lit(1)).alias("trips"), F.count("pickup_longitude").alias("located"), F.round(F.sum("fare_amount"), 4).alias("fare"))


@register("m5_yellow_columnstore_load", with_ctes(f"""
SELECT 'yellow' AS car_type, CASE WHEN trip_id % 2 = 0 THEN b.borough END AS pickup_borough, {_of([None, None, None, None, False, None])} AS flag,
  CAST(count(*) AS BIGINT) AS trips, CAST(count(DISTINCT trip_id % 2) AS BIGINT) AS files
FROM trips LEFT JOIN boroughs b ON trips.pickup_location_id = b.location_id
GROUP BY 1, 2, 3""", trips=EV_TRIPS_SQL, zones=ZONES_SQL, boroughs=BOROUGH_SQL))
def m5_yellow_columnstore_load(spark, sf_dir):
    """M5 / A3 / A4: yellow months of both eras into the column-store shape (exact flag rule, boroughs)."""
    raw = readers.read_trips(spark, _yellow_files(spark, sf_dir, "yellow-columns") + "/yellow_tripdata_*.parquet", "yellow_any")
    out = loaders.taxi_columnstore(raw, "yellow", boroughs(spark, sf_dir))
    era = F.col("fare_amount").isNotNull() & F.col("pickup_location_id").isNotNull()
    return out.groupBy("car_type", "pickup_borough", F.col("store_and_fwd_flag").alias("flag")).agg(
        F.count(F.lit(1)).alias("trips"), F.countDistinct(era).alias("files"))


def _green(spark, sf_dir):
    t = ev_trips(spark, sf_dir)
    return t.select(
        (F.col("trip_id") % 2 + 1).cast("int").alias("VendorID"), F.col("pickup_datetime").alias("lpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("lpep_dropoff_datetime"), _pick(RAW_FLAG, "trip_id").alias("store_and_fwd_flag"),
        F.lit(1).alias("RatecodeID"), F.col("pickup_location_id").alias("PULocationID"), F.col("dropoff_location_id").alias("DOLocationID"),
        F.lit(1).alias("passenger_count"), "trip_distance", "fare_amount", "payment_type", F.lit(None).alias("ehail_fee"))


@register("m1_green_load", with_ctes(f"""
SELECT 2 AS cab_type_id, CAST(trip_id % 2 + 1 AS INTEGER) AS vendor_id, {_of(EXACT_YN)} AS store_and_fwd_flag, count(*) AS trips,
  CAST(0 AS BIGINT) AS ehail_fees, round(sum(trip_distance), 4) AS distance
FROM trips GROUP BY ALL""", trips=EV_TRIPS_SQL))
def m1_green_load(spark, sf_dir):
    """M1 / A5 / B1: green month with a null-typed column, loaded and materialised as a table."""
    folder = _folder(spark, "green")
    raw = readers.read_trips(spark, [_month_file(_green(spark, sf_dir), folder, "green", "2015-01")], "green")
    writers.write_table(loaders.green_rowstore(raw), f"{folder}/table")
    return spark.read.parquet(f"{folder}/table").groupBy("cab_type_id", "vendor_id", "store_and_fwd_flag").agg(
        F.count(F.lit(1)).alias("trips"), F.count("ehail_fee").alias("ehail_fees"), F.round(F.sum("trip_distance"), 4).alias("distance"))


@register("m5_green_columnstore_load", with_ctes(f"""
SELECT b.borough AS pickup_borough, d.borough AS dropoff_borough, {_of(EXACT_YN)} AS flag, count(*) AS trips
FROM trips LEFT JOIN boroughs b ON pickup_location_id = b.location_id LEFT JOIN boroughs d ON dropoff_location_id = d.location_id
GROUP BY ALL""", trips=EV_TRIPS_SQL, zones=ZONES_SQL, boroughs=BOROUGH_SQL))
def m5_green_columnstore_load(spark, sf_dir):
    """M5: green month into the column-store shape."""
    raw = readers.read_trips(spark, [_month_file(_green(spark, sf_dir), _folder(spark, "green-columns"), "green", "2015-01")], "green")
    out = loaders.taxi_columnstore(raw, "green", boroughs(spark, sf_dir))
    return out.groupBy("pickup_borough", "dropoff_borough", F.col("store_and_fwd_flag").alias("flag")).agg(F.count(F.lit(1)).alias("trips"))


def _fhv(spark, sf_dir):
    return ev_trips(spark, sf_dir).select(
        _pick(RAW_BASE, "trip_id").alias("dispatching_base_num"), "pickup_datetime", F.col("dropoff_datetime").alias("dropOff_datetime"),
        F.col("pickup_location_id").alias("PUlocationID"), F.col("dropoff_location_id").alias("DOlocationID"),
        F.when(F.col("trip_id") % 3 == 0, " 1 ").alias("SR_Flag"), F.lit(" b00001 ").alias("Affiliated_base_number"))


@register("m6_fhv_columnstore_load", with_ctes(f"""
SELECT {_of(COMPANY)} AS company, {_of(BASE)} AS dispatching_base_num, CASE WHEN trip_id % 3 = 0 THEN 1 END AS legacy_shared_ride,
  b.borough AS pickup_borough, count(*) AS trips
FROM trips LEFT JOIN boroughs b ON pickup_location_id = b.location_id GROUP BY ALL""", trips=EV_TRIPS_SQL, zones=ZONES_SQL, boroughs=BOROUGH_SQL))
def m6_fhv_columnstore_load(spark, sf_dir):
    """M6: FHV month (raw header spellings) with licence and company from the base number."""
    raw = readers.read_trips(spark, [_month_file(_fhv(spark, sf_dir), _folder(spark, "fhv"), "fhv", "2018-05")], "fhv")
    return loaders.fhv_columnstore(raw, boroughs(spark, sf_dir)).groupBy(
        "company", "dispatching_base_num", "legacy_shared_ride", "pickup_borough").agg(F.count(F.lit(1)).alias("trips"))


def _fhvhv(spark, sf_dir):
    flag = _pick(RAW_FLAG, "trip_id")
    return ev_trips(spark, sf_dir).select(
        _pick(RAW_LICENCE, "trip_id").alias("hvfhs_license_num"), _pick(RAW_BASE, "trip_id").alias("dispatching_base_num"),
        "pickup_datetime", "dropoff_datetime", F.col("pickup_location_id").alias("PULocationID"),
        F.col("dropoff_location_id").alias("DOLocationID"), F.col("trip_distance").alias("trip_miles"),
        F.round("duration_s").cast("long").alias("trip_time"), F.col("fare_amount").alias("base_passenger_fare"), F.lit(0.25).alias("bcf"),
        *[flag.alias(f"{c}_flag") for c in ("shared_request", "shared_match", "access_a_ride", "wav_request", "wav_match")])


@register("m3_fhv_load", with_ctes(f"""
SELECT {_of(BASE)} AS dispatching_base_num, {_of(ROWSTORE_FLAG)} AS shared_request, {_of(ROWSTORE_FLAG_BLANK_FALSE)} AS access_a_ride, count(*) AS trips
FROM trips GROUP BY ALL""", trips=EV_TRIPS_SQL))
def m3_fhv_load(spark, sf_dir):
    """High-volume FHV month by the row-store rules, loaded twice into a table by file: the
    second load replaces the first; a reload of another file that now has no rows leaves none."""
    folder = _folder(spark, "fhvhv-rows")
    raw = readers.read_trips(spark, [_month_file(_fhvhv(spark, sf_dir), folder, "fhvhv", "2020-01")], "fhvhv")
    out = loaders.fhv_rowstore(raw).withColumn("filename", F.lit("fhvhv_tripdata_2020-01.parquet"))
    gone = out.limit(1).withColumn("filename", F.lit("fhvhv_tripdata_2020-02.parquet"))
    for rows in (out, out, gone):
        writers.replace_by_file(rows, f"{folder}/table")
    writers.replace_by_file(gone.filter("false"), f"{folder}/table", files=["fhvhv_tripdata_2020-02.parquet"])
    return spark.read.parquet(f"{folder}/table").groupBy("dispatching_base_num", "shared_request", "access_a_ride").agg(F.count(F.lit(1)).alias("trips"))


@register("m7_fhvhv_columnstore_load", with_ctes(f"""
SELECT {_of(LICENCE_COMPANY)} AS company, {_of(COLUMN_FLAG)} AS shared_match, {_of(EXACT_YN)} AS wav_match, b.borough AS dropoff_borough,
  count(*) AS trips, round(sum(0.25), 2) AS black_car_fund
FROM trips LEFT JOIN boroughs b ON dropoff_location_id = b.location_id GROUP BY ALL""", trips=EV_TRIPS_SQL, zones=ZONES_SQL, boroughs=BOROUGH_SQL))
def m7_fhvhv_columnstore_load(spark, sf_dir):
    """M7: high-volume FHV month by the column-store rules, written clustered by (company, time)."""
    folder = _folder(spark, "fhvhv-columns")
    raw = readers.read_trips(spark, [_month_file(_fhvhv(spark, sf_dir), folder, "fhvhv", "2020-01")], "fhvhv")
    out = loaders.fhvhv_columnstore(raw, boroughs(spark, sf_dir))
    writers.write_table(writers.cluster_layout(out, ["company"], ["pickup_datetime"], 4), f"{folder}/table")
    return spark.read.parquet(f"{folder}/table").groupBy("company", "shared_match", "wav_match", "dropoff_borough").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("black_car_fund"), 2).cast("double").alias("black_car_fund"))


@register("m4_ridehail_csv_load", with_ctes("""
SELECT CASE WHEN trip_id % 6 < 5 THEN 100 + CAST(trip_id % 6 AS INTEGER) END AS pickup_location_id,
  date_trunc('hour', pickup_datetime) AS pickup_hour, count(*) AS trips
FROM trips GROUP BY ALL""", trips=EV_TRIPS_SQL))
def m4_ridehail_csv_load(spark, sf_dir):
    """CSV with month-first timestamps and its own header names, points to tracts to zones."""
    path = _folder(spark, "ridehail-csv")
    k = (F.col("trip_id") % 6).cast("double")
    raw = ev_trips(spark, sf_dir).select(
        F.date_format("pickup_datetime", "M/d/yyyy H:mm:ss").alias("Date/Time"), F.lit(1.3).alias("Lat"), (k * 2.6 + 1.3).alias("Lon"), F.lit("B1").alias("Base"))
    writers.write_csv(raw, path)
    back = readers.read_csv(spark, path, schemas.UBER_2014_CSV)
    tracts = zone_polygons(spark, sf_dir).withColumnRenamed("location_id", "gid").filter("gid < 5")
    to_zone = tracts.select(F.col("gid").alias("tract_id"), (F.col("gid") + 100).cast("int").alias("taxi_zone_location_id"))
    out = loaders.uber_2014(back, tracts, to_zone, cell=2.0)
    return out.groupBy("pickup_location_id", F.date_trunc("hour", "pickup_datetime").cast("timestamp_ntz").alias("pickup_hour")).agg(F.count(F.lit(1)).alias("trips"))


@register("a11_weather_csv", """
SELECT CAST(ts AS DATE) AS date, round(min(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END), 6) AS wind,
  CAST(count(*) AS BIGINT) AS observations, CAST(count(*) FILTER (event_id % 4 = 0) AS BIGINT) AS unnamed
FROM events GROUP BY 1""")
def a11_weather_csv(spark, sf_dir):
    """Weather CSV: -9999 is a missing wind speed, '' a missing name."""
    path = _folder(spark, "weather")
    e = read(spark, sf_dir, "events")
    raw = e.select(F.lit("S1").alias("STATION"), F.when(F.col("event_id") % 4 == 0, "").otherwise("park").alias("NAME"), F.to_date("ts").alias("DATE"),
                   F.when(F.col("event_id") % 3 == 0, -9999.0).otherwise(F.col("value")).alias("AWND"), *[F.lit(0.0).alias(c) for c in ("P", "S", "SD", "MX", "MN")])
    writers.write_csv(raw, path)
    back = readers.read_csv(spark, path, schemas.WEATHER_CSV).withColumn("wind", C.sentinel_to_null("average_wind_speed", -9999.0))
    return back.groupBy("date").agg(F.round(F.min("wind"), 6).alias("wind"), F.count(F.lit(1)).alias("observations"),
                                    F.count_if(F.col("station_name").isNull()).alias("unnamed"))


@register("a14_zone_csv_with_airport", with_ctes("""
SELECT location_id, zone, borough FROM zones UNION ALL SELECT 99, 'Newark Airport', borough FROM zones WHERE location_id = 7""", zones=ZONES_SQL))
def a14_zone_csv_with_airport(spark, sf_dir):
    """Headerless zone CSV (one file) read back, with one synthetic row derived from another."""
    path = _folder(spark, "zones")
    z = zones(spark, sf_dir).select(F.col("location_id").cast("int").alias("location_id"), "zone", "borough", F.lit("x").alias("subregion"))
    z.repartition(1).write.option("header", False).csv(path)
    back = readers.read_csv(spark, path, schemas.ZONES_CSV, header=False)
    return readers.append_row_from(back, F.col("location_id") == 7, {"location_id": 99, "zone": "Newark Airport"}).select("location_id", "zone", "borough")


@register("a21_election_csv", """
SELECT CAST('6' || lpad(CAST(l_suppkey % 90 AS VARCHAR), 2, '0') || '001' AS INTEGER) AS election_district, l_returnflag AS candidate,
  CAST(sum(CAST(l_quantity AS BIGINT) * 1000) AS BIGINT) AS votes
FROM lineitem GROUP BY ALL""")
def a21_election_csv(spark, sf_dir):
    """All-text election CSV with quoted thousands separators and party names in parentheses."""
    path = _folder(spark, "election")
    li = read(spark, sf_dir, "lineitem")
    raw = li.select(F.concat(F.lit("6"), F.lpad((F.col("l_suppkey") % 90).cast("string"), 2, "0")).alias("AD"), F.lit("001").alias("ED"),
                    *[F.lit("x").alias(c) for c in ("County", "Status", "Event", "Party", "Office", "Key")], F.lit(1).alias("For"),
                    F.concat("l_returnflag", F.lit(" (Party)")).alias("Unit"), F.format_number(F.col("l_quantity") * 1000, 0).alias("Tally"))
    writers.write_csv(raw, path)
    back = readers.read_election_results(spark, path)
    return back.groupBy("election_district", "candidate").agg(F.sum("tally").cast("bigint").alias("votes"))


@register("b2_append_twice", "SELECT n_regionkey, CAST(2 * count(*) AS BIGINT) AS n FROM nation GROUP BY 1")
def b2_append_twice(spark, sf_dir):
    """A table made and appended to by column list, read through a view."""
    path = _folder(spark, "append")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    writers.write_table(n, path)
    writers.append(n.withColumn("more", F.lit(1)), path, ["n_nationkey", "n_regionkey"])
    v = writers.create_view(spark.read.parquet(path), f"appended_{uuid.uuid4().hex}")
    return v.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@register("b5_csv_by_zone", with_ctes("""
SELECT pickup_location_id, car_type, count(*) AS trips, round(sum(trip_distance), 4) AS distance FROM trips GROUP BY ALL""", trips=EV_TRIPS_SQL))
def b5_csv_by_zone(spark, sf_dir):
    """One CSV folder per start zone, read back and joined on all shared columns to its own counts."""
    path = _folder(spark, "by-zone")
    t = ev_trips(spark, sf_dir).select("pickup_location_id", "car_type", "trip_distance")
    writers.write_partitioned_csv(t, "pickup_location_id", path)
    back = spark.read.option("header", True).schema("car_type string, trip_distance double, pickup_location_id int").csv(path)
    n = back.groupBy("pickup_location_id", "car_type").agg(F.count(F.lit(1)).alias("trips"))
    d = back.groupBy("pickup_location_id", "car_type").agg(F.round(F.sum("trip_distance"), 4).alias("distance"))
    return Rel.natural_join(n, d)
