"""Load pipelines: raw monthly files -> normalised trip facts (M1-M7).

Each loader is a pure DataFrame -> DataFrame transformation of the repaired
raw frame (``readers.read_trips``); writing with ``writers.replace_by_file``
makes a reload of the same file idempotent (B3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleanse as C
from ..operators import relational as Rel
from ..operators import spatial as SP
from .readers import conform
from .schemas import YELLOW_ANY

# Cab type ids of the row-store schema.
CAB_TYPES = {"yellow": 1, "green": 2}


def _zone_boroughs(df: DataFrame, zones: DataFrame) -> DataFrame:
    """pickup/dropoff borough via one role-playing zone lookup; only the
    six listed boroughs are kept, anything else stays null."""
    z = zones.filter(F.col("borough").isin(*C.BOROUGHS)).select("location_id", "borough").dropDuplicates(["location_id"])
    return Rel.lookup_twice(df, z, "location_id", "pickup_location_id", "dropoff_location_id", ["borough"],
                            "pickup_", "dropoff_")


def _either_era(raw: DataFrame) -> DataFrame:
    """Yellow rows of any era with the columns of both (and the file name, null if unknown)."""
    name = F.col("filename") if "filename" in raw.columns else F.lit(None).cast("string")
    return conform(raw.withColumn("filename", name),
                   T.StructType([*YELLOW_ANY.fields, T.StructField("filename", T.StringType())]))


def yellow_rowstore(raw: DataFrame, tracts: DataFrame | None = None, tract_zone: DataFrame | None = None,
                    cell: float = 0.01) -> DataFrame:
    """M2: yellow cleansing (C1-C5) with the tract lookup for legacy files that
    carry coordinates: points -> tract polygons (J3), tract -> zone (E3), and
    the supplied zone back-filled from it (C14). ``raw`` is of either era (A4)."""
    raw = _either_era(raw)
    df = raw.select(
        F.lit(CAB_TYPES["yellow"]).alias("cab_type_id"), C.vendor_code("vendor_id").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"), F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        "passenger_count", "trip_distance",
        C.zero_to_null("pickup_longitude").alias("pickup_longitude"), C.zero_to_null("pickup_latitude").alias("pickup_latitude"),
        C.rate_code("rate_code_id").alias("rate_code_id"), C.store_flag("store_and_fwd_flag").alias("store_and_fwd_flag"),
        C.zero_to_null("dropoff_longitude").alias("dropoff_longitude"),
        C.zero_to_null("dropoff_latitude").alias("dropoff_latitude"),
        C.payment_code("payment_type").alias("payment_type"),
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        "congestion_surcharge", "airport_fee", "total_amount", "pickup_location_id", "dropoff_location_id",
        "filename")
    if tracts is None:
        return df
    for role in ("pickup", "dropoff"):
        df = SP.spatial_join(df, tracts.select(F.col("gid").alias(f"{role}_gid"), "rings"),
                             f"{role}_longitude", f"{role}_latitude", cell=cell, how="left")
        if tract_zone is not None:
            m = tract_zone.select(F.col("tract_id").alias(f"_{role}_t"), F.col("taxi_zone_location_id").alias(f"_{role}_z"))
            df = df.join(m, F.col(f"{role}_gid") == F.col(f"_{role}_t"), "left")
            df = df.withColumn(f"{role}_location_id", C.coalesce_cols(f"{role}_location_id", f"_{role}_z")) \
                   .drop(f"_{role}_t", f"_{role}_z")
    return df


def green_rowstore(raw: DataFrame) -> DataFrame:
    """M1: green load: cab type (E2 as a literal), simple Y/N flag."""
    return raw.select(F.lit(CAB_TYPES["green"]).alias("cab_type_id"), "vendor_id",
                      F.col("lpep_pickup_datetime").alias("pickup_datetime"),
                      F.col("lpep_dropoff_datetime").alias("dropoff_datetime"),
                      C.simple_yn("store_and_fwd_flag").alias("store_and_fwd_flag"),
                      *[c for c in raw.columns if c not in ("lpep_pickup_datetime", "lpep_dropoff_datetime",
                                                             "store_and_fwd_flag", "vendor_id")])


def fhv_rowstore(raw: DataFrame) -> DataFrame:
    """M3: FHV / high-volume FHV row-store rules: trim+upper codes (C9),
    flags with the row-store rule (C7; '' is false only for access-a-ride),
    legacy shared flag as integer (try_cast, T6)."""
    out = raw
    for c in ("dispatching_base_num", "affiliated_base_num", "hvfhs_license_num", "originating_base_num"):
        if c in raw.columns:
            out = out.withColumn(c, C.norm_code(c))
    flags = {"shared_request_flag": "shared_request", "shared_match_flag": "shared_match",
             "access_a_ride_flag": "access_a_ride", "wav_request_flag": "wav_request", "wav_match_flag": "wav_match"}
    for src, dst in flags.items():
        if src in raw.columns:
            out = out.withColumn(dst, C.fhv_flag_rowstore(src, empty_is_false=(dst == "access_a_ride"))).drop(src)
    if "legacy_shared_ride_flag" in raw.columns:
        out = out.withColumn("legacy_shared_ride", F.trim("legacy_shared_ride_flag").try_cast("int")) \
                 .drop("legacy_shared_ride_flag")
    return out


def uber_2014(raw: DataFrame, tracts: DataFrame, tract_zone: DataFrame | None = None, cell: float = 0.01) -> DataFrame:
    """M4: 2014 ride-hail CSV: month-first timestamps (A10), point-in-tract."""
    df = raw.withColumn("pickup_datetime", F.to_timestamp_ntz("pickup_datetime", F.lit("M/d/yyyy H:mm:ss")))
    df = SP.spatial_join(df, tracts.select(F.col("gid").alias("pickup_gid"), "rings"), "pickup_longitude",
                         "pickup_latitude", cell=cell, how="left")
    if tract_zone is not None:
        m = tract_zone.select(F.col("tract_id").alias("_t"), F.col("taxi_zone_location_id").alias("pickup_location_id"))
        df = df.join(m, F.col("pickup_gid") == F.col("_t"), "left").drop("_t")
    return df


def taxi_columnstore(raw: DataFrame, car_type: str, zones: DataFrame) -> DataFrame:
    """M5: yellow/green column-store load: type literal (C13), boroughs (C12),
    exact Y/N flag (C6), provenance file name (A3). Yellow input is of either era (A4)."""
    pick = "tpep" if car_type == "yellow" else "lpep"
    if car_type == "yellow":
        raw = _either_era(raw)
    df = raw.select(
        F.lit(car_type).alias("car_type"), F.col("vendor_id").cast("string").alias("vendor_id"),
        F.col(f"{pick}_pickup_datetime").alias("pickup_datetime"),
        F.col(f"{pick}_dropoff_datetime").alias("dropoff_datetime"),
        "pickup_location_id", "dropoff_location_id", "passenger_count", "trip_distance",
        F.col("rate_code_id").cast("string").alias("rate_code_id"),
        C.simple_yn("store_and_fwd_flag").alias("store_and_fwd_flag"),
        F.col("payment_type").cast("string").alias("payment_type"),
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
        "congestion_surcharge",
        *[F.col(c) if c in raw.columns else F.lit(None).cast("double").alias(c) for c in ("airport_fee", "ehail_fee")],
        *[F.col(c) if c in raw.columns else F.lit(None).cast("int").alias(c) for c in ("trip_type",)],
        "filename")
    return _zone_boroughs(df, zones)


def fhv_columnstore(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """M6: FHV column-store load: licence and company from the base number
    (C10), trimmed base number (C9), boroughs (C12)."""
    df = raw.select(C.base_licence("dispatching_base_num").alias("hvfhs_license_num"),
                    C.base_company("dispatching_base_num").alias("company"),
                    C.norm_code("dispatching_base_num").alias("dispatching_base_num"),
                    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
                    F.trim("legacy_shared_ride_flag").try_cast("int").alias("legacy_shared_ride"), "filename")
    return _zone_boroughs(df, zones)


def fhvhv_columnstore(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """M7: high-volume FHV column-store load: company from licence (C11, null
    when unmapped, T28), column-store flag rule (C8; wav_match 'N' only)."""
    df = raw.select(
        "hvfhs_license_num", C.licence_company("hvfhs_license_num").alias("company"),
        C.norm_code("dispatching_base_num").alias("dispatching_base_num"),
        C.norm_code("originating_base_num").alias("originating_base_num"),
        "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime",
        "pickup_location_id", "dropoff_location_id", "trip_miles", "trip_time", "base_passenger_fare", "tolls",
        "black_car_fund", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay",
        C.fhv_flag_columnstore("shared_request_flag").alias("shared_request"),
        C.fhv_flag_columnstore("shared_match_flag").alias("shared_match"),
        C.fhv_flag_columnstore("access_a_ride_flag").alias("access_a_ride"),
        C.fhv_flag_columnstore("wav_request_flag").alias("wav_request"),
        C.fhv_flag_columnstore("wav_match_flag", blank_is_false=False).alias("wav_match"),
        "filename")
    return _zone_boroughs(df, zones)


def unmapped_company_count(df: DataFrame) -> DataFrame:
    """T28 data-quality count: rows whose company is null."""
    return df.agg(F.count_if(F.col("company").isNull()).alias("unmapped_company"))
