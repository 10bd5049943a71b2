"""Loads that follow their files: many drifted months, drifted months in a stream, atomic
reloads, roll-ups kept in step, dense row ids, distinct counts that merge (A1, A2, A15, B1, B3, F10, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import rollups as R
from ..sources import readers, schemas
from ..sources.managed import ManagedTables, replace_with_rollups
from ..streaming import files as ST
from .bindings import EV_TRIPS_SQL, ev_trips, read, with_ctes
from .load_queries import _folder, _month_file, _yellow, _yellow_files
from .registry import register

#: Months written for the drifted folder; the physical schema changes from month to month.
MONTHS = 8


@register("a2_many_drifted_files", with_ctes(f"""
SELECT CAST(trip_id % {MONTHS} + 1 AS INTEGER) AS month, count(*) AS trips, CAST(sum(CASE WHEN trip_id % {MONTHS} % 4 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fees,
  round(sum(fare_amount), 4) AS fare, CAST(sum(1) AS BIGINT) AS passengers
FROM trips GROUP BY 1""", trips=EV_TRIPS_SQL))
def a2_many_drifted_files(spark, sf_dir):
    """A folder of months in four physical schemas (null-typed column, other case and
    type, stray index column, wider integer), grouped by their footers in one job."""
    folder, y = _folder(spark, "drifted"), _yellow(spark, sf_dir)
    drift = [lambda d: d.withColumn("airport_fee", F.lit(None)), lambda d: d.withColumn("Airport_fee", F.lit(1.25)),
             lambda d: d.withColumn("__index_level_0__", F.lit(7)), lambda d: d.withColumn("passenger_count", F.lit(1).cast("double"))]
    for m in range(MONTHS):
        month = drift[m % 4](y.filter(F.col("trip_id") % MONTHS == m).drop("trip_id"))
        _month_file(month, folder, "yellow", f"2021-{m + 1:02d}")
    raw = readers.read_trips(spark, folder, "yellow", name=readers.data_set_name)
    return raw.groupBy(F.regexp_extract("filename", r"tripdata_2021-(\d\d)", 1).cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), F.count("airport_fee").alias("fees"), F.round(F.sum("fare_amount"), 4).alias("fare"),
        F.sum("passenger_count").alias("passengers"))


@register("l1_stream_drifted_months", with_ctes("""
SELECT CASE WHEN trip_id % 2 = 0 THEN pickup_location_id END AS pickup_location_id, count(*) AS trips,
  CAST(count(*) FILTER (trip_id % 2 = 1) AS BIGINT) AS with_coordinates, round(sum(fare_amount), 4) AS fare, CAST(count(DISTINCT trip_id % 2) AS BIGINT) AS eras
FROM trips GROUP BY 1""", trips=EV_TRIPS_SQL))
def l1_stream_drifted_months(spark, sf_dir):
    """Months of two eras dropped one after the other into a watched folder; the stream carries
    their paths and each micro-batch repairs the schema; a third run over both adds nothing."""
    source = _yellow_files(spark, sf_dir, "stream-yellow")
    table, ckpt = _folder(spark, "stream-table"), _folder(spark, "stream-checkpoint")
    for months in ("2014-03", "2009-07", "*"):
        ST.load_available(spark, f"{source}/yellow_tripdata_{months}.parquet", schemas.YELLOW_ANY, table, f"{ckpt}/{months.replace('*', '2009-07')}")
    t = spark.read.parquet(table)
    return t.groupBy("pickup_location_id").agg(
        F.count(F.lit(1)).alias("trips"), F.count("pickup_longitude").alias("with_coordinates"), F.round(F.sum("fare_amount"), 4).alias("fare"),
        F.countDistinct(F.col("pickup_longitude").isNull()).alias("eras"))


def _by_file(spark, sf_dir):
    """Trips under the name of a monthly file (event day of the month in three files)."""
    t = ev_trips(spark, sf_dir).select("trip_id", "pickup_datetime", "car_type", "pickup_location_id", "fare_amount")
    return t.withColumn("filename", F.concat(F.lit("trips_"), (F.col("trip_id") % 3).cast("string"), F.lit(".parquet")))


_ROLLUPS = {
    "hourly": lambda d: d.groupBy("filename", tp.trunc_ts("hour", "pickup_datetime").alias("hour"), "car_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fare")),
    "daily": lambda d: d.groupBy("filename", F.to_date("pickup_datetime").alias("day"), "pickup_location_id").agg(F.count(F.lit(1)).alias("trips")),
}


def _reloaded(spark, sf_dir, name):
    """Three files loaded, then the second reloaded with fewer trips and the third without any."""
    tables, trips = ManagedTables(spark, _folder(spark, name)), _by_file(spark, sf_dir)
    replace_with_rollups(tables, "trips", trips, _ROLLUPS)
    again = trips.where("filename = 'trips_1.parquet' AND trip_id % 2 = 1")
    replace_with_rollups(tables, "trips", again, _ROLLUPS, files=["trips_1.parquet", "trips_2.parquet"])
    return tables


_KEPT = "(SELECT * FROM trips WHERE trip_id % 3 = 0 OR (trip_id % 3 = 1 AND trip_id % 2 = 1))"


@register("b1_incremental_hourly_rollup", with_ctes(f"""
SELECT date_trunc('hour', pickup_datetime) AS hour, car_type, count(*) AS trips, round(sum(fare_amount), 4) AS fare
FROM {_KEPT} GROUP BY ALL""", trips=EV_TRIPS_SQL))
def b1_incremental_hourly_rollup(spark, sf_dir):
    """The stored hourly roll-up after reloads equals one made anew from the facts."""
    return _reloaded(spark, sf_dir, "rollup-hourly").read("hourly").groupBy("hour", "car_type").agg(
        F.sum("trips").alias("trips"), F.round(F.sum("fare"), 4).alias("fare"))


@register("b1_incremental_daily_rollup", with_ctes(f"""
SELECT CAST(pickup_datetime AS DATE) AS day, pickup_location_id, count(*) AS trips FROM {_KEPT} GROUP BY ALL""", trips=EV_TRIPS_SQL))
def b1_incremental_daily_rollup(spark, sf_dir):
    """The stored daily roll-up, in the same commit as facts and hours."""
    return _reloaded(spark, sf_dir, "rollup-daily").read("daily").groupBy("day", "pickup_location_id").agg(F.sum("trips").alias("trips"))


@register("b3_atomic_reload", with_ctes("""
SELECT 'before' AS seen, car_type, count(*) AS trips FROM trips GROUP BY ALL
UNION ALL SELECT 'after', car_type, count(*) FROM trips WHERE trip_id % 3 <> 1 OR trip_id % 2 = 1 GROUP BY ALL""", trips=EV_TRIPS_SQL))
def b3_atomic_reload(spark, sf_dir):
    """A reload that dies after writing its rows leaves the old ones; the repeated reload shows the new ones, never both."""
    tables, trips = ManagedTables(spark, _folder(spark, "atomic")), _by_file(spark, sf_dir)
    tables.replace({"trips": trips})
    again = trips.where("filename = 'trips_1.parquet' AND trip_id % 2 = 1")
    tables.write({"trips": again})  # not committed
    seen = []
    for name in ("before", "after"):
        seen.append(tables.read("trips").groupBy("car_type").agg(F.count(F.lit(1)).alias("trips")).select(F.lit(name).alias("seen"), "car_type", "trips"))
        if name == "before":
            tables.replace({"trips": again})
    return seen[0].unionByName(seen[1])


@register("a15_dense_row_id", """
SELECT l_returnflag, count(*) AS n, min(id) AS first_id, max(id) AS last_id, CAST(sum(id) AS BIGINT) AS id_sum, CAST(sum(id * l_linenumber) AS BIGINT) AS id_check
FROM (SELECT row_number() OVER () AS id, l_returnflag, l_linenumber FROM lineitem) GROUP BY 1""")
def a15_dense_row_id(spark, sf_dir):
    """Serial numbers 1 to n in file order, without a gap or a global window over rows."""
    d = readers.dense_row_id(read(spark, sf_dir, "lineitem"))
    return d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                                         F.sum("id").alias("id_sum"), F.sum(F.col("id") * F.col("l_linenumber")).alias("id_check"))


@register("f10_distinct_users_by_week", """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL""")
def f10_distinct_users_by_week(spark, sf_dir):
    """weekly distinct users merged from stored daily bitmaps, without a second scan of the events."""
    return R.count_bitmaps(_daily_users(spark, sf_dir).withColumn("week", F.date_trunc("week", "day").cast("date")), ["week", "event_type"], "users")


@register("f10_distinct_users_by_month", """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS users, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS days FROM events GROUP BY 1""")
def f10_distinct_users_by_month(spark, sf_dir):
    """monthly distinct users over all event types from the same daily bitmaps."""
    daily = _daily_users(spark, sf_dir).withColumn("month", F.trunc("day", "month"))
    days = daily.groupBy("month").agg(F.countDistinct("day").alias("days"))
    return R.count_bitmaps(daily, ["month"], "users").join(days, "month")


def _daily_users(spark, sf_dir):
    """The daily bitmaps as a stored table."""
    e, path = read(spark, sf_dir, "events"), _folder(spark, "daily-users")
    R.distinct_bitmaps(e.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id").write.parquet(path)
    return spark.read.parquet(path)
