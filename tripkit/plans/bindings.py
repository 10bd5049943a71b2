"""Bindings from the reference's roles (trip, zone, borough, fare, ...) to the
driver's tables, each given twice: as a Spark DataFrame and as the same
relation in SQL (used by the oracle queries).

* ``ev_trips`` (events): a short-range trip table with real clock times.
  car_type = event_type; pickup = ts; duration = value minutes; pickup zone =
  user_id mod 25; dropoff zone = k mod 25 where k is the props counter;
  distance = k / 10; fare = value.
* ``li_trips`` (lineitem x supplier): a multi-year daily trip table.
  car_type from l_returnflag; date = l_shipdate; zone = supplier nation.
* ``zones``: nation x region (location_id, zone, borough); 25 rows, a
  fixed-size dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("zone"),
                     F.col("r_name").alias("borough")))


ZONES_SQL = """SELECT n_nationkey AS location_id, n_name AS zone, r_name AS borough
FROM nation JOIN region ON n_regionkey = r_regionkey"""


def _k():
    """The counter in props, parsed as JSON (any spacing, key order or further keys)."""
    return F.get_json_object("props", "$.k").cast("int")


def ev_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", _k())
    k = F.col("k")
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("car_type"),
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("MICROSECOND", F.round(F.col("value") * 60_000_000).cast("long"),
                        F.col("ts")).alias("dropoff_datetime"),
        (F.col("user_id") % 25).cast("int").alias("pickup_location_id"),
        (k % 25).cast("int").alias("dropoff_location_id"),
        k.alias("k"),
        (k.cast("double") / 10).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("value") * 60).alias("duration_s"),
        F.when(k < 60, 1).when(k < 95, 2).when(k < 98, 3).otherwise(4).alias("payment_type"),
        F.when(k % 3 == 0, F.lit(0.0)).otherwise(F.col("value") * 0.15).alias("tip_amount"),
        F.col("user_id"),
    )


_K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

EV_TRIPS_SQL = f"""SELECT
  event_id AS trip_id,
  event_type AS car_type,
  ts AS pickup_datetime,
  ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS dropoff_datetime,
  CAST(user_id % 25 AS INTEGER) AS pickup_location_id,
  CAST({_K_SQL} % 25 AS INTEGER) AS dropoff_location_id,
  {_K_SQL} AS k,
  CAST({_K_SQL} AS DOUBLE) / 10 AS trip_distance,
  value AS fare_amount,
  value * 60 AS duration_s,
  CASE WHEN {_K_SQL} < 60 THEN 1 WHEN {_K_SQL} < 95 THEN 2 WHEN {_K_SQL} < 98 THEN 3 ELSE 4 END AS payment_type,
  CASE WHEN {_K_SQL} % 3 = 0 THEN 0.0 ELSE value * 0.15 END AS tip_amount,
  user_id
FROM events"""


def li_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"),
        F.when(F.col("l_returnflag") == "A", "yellow").when(F.col("l_returnflag") == "N", "green")
         .otherwise("uber").alias("car_type"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.col("s_nationkey").alias("pickup_location_id"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("payment_type"),
    )


LI_TRIPS_SQL = """SELECT
  l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN l_returnflag = 'A' THEN 'yellow' WHEN l_returnflag = 'N' THEN 'green' ELSE 'uber' END AS car_type,
  CAST(l_shipdate AS DATE) AS date,
  l_shipdate AS pickup_datetime,
  s_nationkey AS pickup_location_id,
  l_quantity AS trip_distance,
  l_extendedprice / 1000 AS fare_amount,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS payment_type
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def with_ctes(body: str, **ctes: str) -> str:
    """Prefix an oracle query with named CTEs, each placed after the CTEs it references."""
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    if not ctes:
        return body
    import re
    names = list(ctes)
    deps = {n: {m for m in names if m != n and re.search(rf"\b{m}\b", ctes[n])} for n in names}
    ordered, done = [], set()
    while len(ordered) < len(names):
        progress = False
        for n in names:
            if n not in done and deps[n] <= done:
                ordered.append(n)
                done.add(n)
                progress = True
        if not progress:
            raise ValueError(f"cyclic CTE references among {sorted(set(names) - done)}")
    parts = ",\n".join(f"{k} AS (\n{ctes[k]}\n)" for k in ordered)
    return f"WITH {parts}\n{body}"


__all__ = ["read", "zones", "ev_trips", "li_trips", "ZONES_SQL", "EV_TRIPS_SQL", "LI_TRIPS_SQL",
           "with_ctes", "tp"]
