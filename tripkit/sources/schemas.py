"""Declared schemas of the raw monthly trip files and lookup files.

Field names follow the normalised snake_case spelling; ``SOURCE_NAMES``
gives the header spellings found in the raw files (A6 name mapping).
"""

from __future__ import annotations

from pyspark.sql import types as T

D, I, S, TS, L = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType(), T.LongType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


YELLOW = _schema(
    ("vendor_id", S), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS), ("passenger_count", I),
    ("trip_distance", D), ("rate_code_id", S), ("store_and_fwd_flag", S), ("pickup_location_id", I),
    ("dropoff_location_id", I), ("payment_type", S), ("fare_amount", D), ("extra", D), ("mta_tax", D),
    ("tip_amount", D), ("tolls_amount", D), ("improvement_surcharge", D), ("total_amount", D),
    ("congestion_surcharge", D), ("airport_fee", D))

YELLOW_LEGACY = _schema(
    ("vendor_id", S), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS), ("passenger_count", I),
    ("trip_distance", D), ("pickup_longitude", D), ("pickup_latitude", D), ("rate_code_id", S),
    ("store_and_fwd_flag", S), ("dropoff_longitude", D), ("dropoff_latitude", D), ("payment_type", S),
    ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D), ("tolls_amount", D), ("total_amount", D))

# Both yellow eras at once: what a loader can rely on, absent columns being typed nulls.
YELLOW_ANY = T.StructType([*YELLOW.fields, *[f for f in YELLOW_LEGACY.fields if f.name not in YELLOW.names]])

GREEN = _schema(
    ("vendor_id", I), ("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS), ("store_and_fwd_flag", S),
    ("rate_code_id", I), ("pickup_location_id", I), ("dropoff_location_id", I), ("passenger_count", I),
    ("trip_distance", D), ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D), ("tolls_amount", D),
    ("ehail_fee", D), ("improvement_surcharge", D), ("total_amount", D), ("payment_type", I), ("trip_type", I),
    ("congestion_surcharge", D))

FHV = _schema(
    ("dispatching_base_num", S), ("pickup_datetime", TS), ("dropoff_datetime", TS), ("pickup_location_id", I),
    ("dropoff_location_id", I), ("legacy_shared_ride_flag", S), ("affiliated_base_num", S))

FHVHV = _schema(
    ("hvfhs_license_num", S), ("dispatching_base_num", S), ("originating_base_num", S), ("request_datetime", TS),
    ("on_scene_datetime", TS), ("pickup_datetime", TS), ("dropoff_datetime", TS), ("pickup_location_id", I),
    ("dropoff_location_id", I), ("trip_miles", D), ("trip_time", L), ("base_passenger_fare", D), ("tolls", D),
    ("black_car_fund", D), ("sales_tax", D), ("congestion_surcharge", D), ("airport_fee", D), ("tips", D),
    ("driver_pay", D), ("shared_request_flag", S), ("shared_match_flag", S), ("access_a_ride_flag", S),
    ("wav_request_flag", S), ("wav_match_flag", S))

UBER_2014_CSV = _schema(("pickup_datetime", S), ("pickup_latitude", D), ("pickup_longitude", D), ("base_code", S))

WEATHER_CSV = _schema(
    ("station_id", S), ("station_name", S), ("date", T.DateType()), ("average_wind_speed", D), ("precipitation", D),
    ("snowfall", D), ("snow_depth", D), ("max_temperature", D), ("min_temperature", D))

ZONES_CSV = _schema(("location_id", I), ("zone", S), ("borough", S), ("subregion", S))

FHV_BASES = _schema(("base_number", S), ("base_name", S), ("dba", S), ("dba_category", S))

ELECTION_CSV = _schema(
    ("ad", S), ("ed", S), ("county", S), ("edad_status", S), ("event", S), ("party", S), ("office", S),
    ("district_key", S), ("vote_for", I), ("unit_name", S), ("tally_as_text", S))

DATASETS = {"yellow": YELLOW, "yellow_any": YELLOW_ANY, "yellow_legacy": YELLOW_LEGACY, "green": GREEN, "fhv": FHV, "fhvhv": FHVHV}

# Raw header spellings -> normalised names.
SOURCE_NAMES = {
    "VendorID": "vendor_id", "RatecodeID": "rate_code_id", "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id", "PUlocationID": "pickup_location_id", "DOlocationID": "dropoff_location_id",
    "dropOff_datetime": "dropoff_datetime", "SR_Flag": "legacy_shared_ride_flag", "Affiliated_base_number":
    "affiliated_base_num", "bcf": "black_car_fund", "Airport_fee": "airport_fee",
}
