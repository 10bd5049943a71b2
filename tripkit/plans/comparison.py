"""Taxi versus bike travel times and win rates.

Bindings: taxi trips are 'click' events; bike trips are 'view' events whose
start and end stations (user id, props counter) map to zones through the
customer table used as a station dimension (joined twice, E5). Durations
are event values in minutes, times 60 (whole tenths of seconds).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..functions import timeparts as tp
from ..operators import relational as Rel
from ..operators import rollups as R
from ..operators import series as S
from ..operators import stats as K
from ..operators.margins import median_margins
from .bindings import EV_TRIPS_SQL, ZONES_SQL, ev_trips, read, with_ctes, zones
from .daily import WEATHER_SQL, daily_weather
from .registry import register

# Holiday dates of the bound period and comparison parameters.
HOLIDAYS = ["2024-01-01", "2024-01-15"]
MIN_DUR, MAX_DUR = 120, 7200
# Reference thresholds, and those the registered queries pass: the bound tables hold few trips.
QUALIFY_MIN, BOUND_QUALIFY_MIN = 100, 30
MIN_OBS, BOUND_MIN_OBS = 5, 1
# Zones from this id on have no bike station, so that some zones are unserved.
FIRST_UNSERVED_ZONE = 20
RAIN = 0.1


def taxi_arm(spark, sf_dir):
    """Taxi arm of the comparison fact."""
    t = ev_trips(spark, sf_dir).filter(F.col("car_type") == "click")
    secs = tp.seconds_between("pickup_datetime", "dropoff_datetime")
    t = t.filter(F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull()
                 & secs.between(MIN_DUR, MAX_DUR))
    return t.select(F.lit("taxi").alias("type"), F.col("trip_id").alias("external_id"),
                    F.col("pickup_location_id").alias("start_zone"), F.col("dropoff_location_id").alias("end_zone"),
                    F.col("pickup_datetime").alias("start_time"), F.col("dropoff_datetime").alias("end_time"),
                    secs.alias("duration_in_seconds"), F.to_date("pickup_datetime").alias("date"),
                    tp.dow0("pickup_datetime").alias("day_of_week"), F.hour("pickup_datetime").alias("hour_of_day"),
                    "trip_distance")


def stations(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.filter(F.col("c_nationkey") < FIRST_UNSERVED_ZONE).select(
        F.col("c_custkey").alias("station_id"), F.col("c_nationkey").alias("taxi_zone_id"))


def bike_arm(spark, sf_dir):
    """Bike arm; start and end stations mapped to zones by one station
    dimension joined twice (E5); same-station trips dropped (D11)."""
    e = ev_trips(spark, sf_dir).filter(F.col("car_type") == "view")
    e = e.select("trip_id", F.col("user_id").alias("start_station_id"), F.col("k").cast("long").alias("end_station_id"),
                 "pickup_datetime", "dropoff_datetime")
    secs = tp.seconds_between("pickup_datetime", "dropoff_datetime")
    e = e.filter((F.col("start_station_id") != F.col("end_station_id")) & secs.between(MIN_DUR, MAX_DUR))
    j = Rel.lookup_twice(e, stations(spark, sf_dir), "station_id", "start_station_id", "end_station_id",
                         ["taxi_zone_id"], "start_", "end_")
    j = j.filter(F.col("start_taxi_zone_id").isNotNull() & F.col("end_taxi_zone_id").isNotNull())
    return j.select(F.lit("bike").alias("type"), F.col("trip_id").alias("external_id"),
                    F.col("start_taxi_zone_id").alias("start_zone"), F.col("end_taxi_zone_id").alias("end_zone"),
                    F.col("pickup_datetime").alias("start_time"), F.col("dropoff_datetime").alias("end_time"),
                    secs.alias("duration_in_seconds"), F.to_date("pickup_datetime").alias("date"),
                    tp.dow0("pickup_datetime").alias("day_of_week"), F.hour("pickup_datetime").alias("hour_of_day"),
                    F.lit(None).cast("double").alias("trip_distance"))


def comparison_fact(spark, sf_dir):
    """The two arms in one long table with a type discriminator."""
    return taxi_arm(spark, sf_dir).unionByName(bike_arm(spark, sf_dir))


SECS = "(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 1000000.0"
COMP_SQL = f"""
SELECT 'taxi' AS type, trip_id AS external_id, pickup_location_id AS start_zone, dropoff_location_id AS end_zone,
  pickup_datetime AS start_time, dropoff_datetime AS end_time, {SECS} AS duration_in_seconds,
  CAST(pickup_datetime AS DATE) AS date, CAST(dayofweek(pickup_datetime) AS INTEGER) AS day_of_week,
  CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, trip_distance
FROM trips WHERE car_type = 'click' AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
  AND {SECS} BETWEEN {MIN_DUR} AND {MAX_DUR}
UNION ALL
SELECT 'bike', trip_id, s1.c_nationkey, s2.c_nationkey, pickup_datetime, dropoff_datetime, {SECS},
  CAST(pickup_datetime AS DATE), CAST(dayofweek(pickup_datetime) AS INTEGER), CAST(hour(pickup_datetime) AS INTEGER),
  CAST(NULL AS DOUBLE)
FROM trips JOIN customer s1 ON user_id = s1.c_custkey JOIN customer s2 ON k = s2.c_custkey
WHERE greatest(s1.c_nationkey, s2.c_nationkey) < {FIRST_UNSERVED_ZONE} AND car_type = 'view' AND user_id <> k AND {SECS} BETWEEN {MIN_DUR} AND {MAX_DUR}"""

CTES = dict(trips=EV_TRIPS_SQL, comp=COMP_SQL)


@register("m60_m61_comparison_fact_summary", with_ctes("""
SELECT type, date, start_zone, count(*) AS trips, round(sum(duration_in_seconds), 4) AS total_seconds
FROM comp GROUP BY ALL""", **CTES))
def m60_m61_comparison_fact_summary(spark, sf_dir):
    """M60 + M61: the comparison fact, summarised per type, date and start zone."""
    c = comparison_fact(spark, sf_dir)
    return c.groupBy("type", "date", "start_zone").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("duration_in_seconds"), 4).alias("total_seconds"))


def qualifying_zones(spark, sf_dir, min_trips: int = QUALIFY_MIN):
    """Trips by start zone per mode (F1, F3), zones with enough of both."""
    c = comparison_fact(spark, sf_dir)
    by_zone = c.groupBy("start_zone").agg(
        R.cond_sum(F.col("type") == "taxi").cast("bigint").alias("taxi_trips"),
        R.cond_sum(F.col("type") == "bike").cast("bigint").alias("bike_trips"))
    return by_zone.filter((F.col("taxi_trips") >= min_trips) & (F.col("bike_trips") >= min_trips))


QZ_SQL = f"""SELECT start_zone, CAST(sum(CASE WHEN type = 'taxi' THEN 1 ELSE 0 END) AS BIGINT) AS taxi_trips,
  CAST(sum(CASE WHEN type = 'bike' THEN 1 ELSE 0 END) AS BIGINT) AS bike_trips
FROM comp GROUP BY start_zone
HAVING sum(CASE WHEN type = 'taxi' THEN 1 ELSE 0 END) >= {BOUND_QUALIFY_MIN}
   AND sum(CASE WHEN type = 'bike' THEN 1 ELSE 0 END) >= {BOUND_QUALIFY_MIN}"""


@register("m62_qualifying_zones", with_ctes("SELECT * FROM qz", qz=QZ_SQL, **CTES))
def m62_qualifying_zones(spark, sf_dir):
    return qualifying_zones(spark, sf_dir, BOUND_QUALIFY_MIN)


def holidays(spark):
    """Literal holiday dates (a seed table)."""
    return spark.createDataFrame([(d,) for d in HOLIDAYS], "date string").select(F.col("date").cast("date"))


HOL_SQL = "SELECT CAST(d AS DATE) AS date FROM (VALUES " + ", ".join(f"('{d}')" for d in HOLIDAYS) + ") v(d)"


def weekday_extract(spark, sf_dir, min_trips: int = QUALIFY_MIN):
    """Weekday, non-holiday (D5 null-aware NOT IN), different-zone
    trips starting in qualifying zones (D4 semi join); the partitioned CSV sink
    (B5) writes this frame partitioned by start zone."""
    c = comparison_fact(spark, sf_dir)
    c = c.filter(F.col("day_of_week").between(1, 5) & (F.col("start_zone") != F.col("end_zone")))
    c = Rel.not_in_set(c, "date", holidays(spark))
    return Rel.in_set(c, "start_zone", qualifying_zones(spark, sf_dir, min_trips))


WE_SQL = """SELECT * FROM comp WHERE day_of_week BETWEEN 1 AND 5 AND start_zone <> end_zone
  AND date NOT IN (SELECT date FROM hol) AND start_zone IN (SELECT start_zone FROM qz)"""


@register("m63_weekday_extract", with_ctes("""
SELECT type, external_id, start_zone, end_zone, start_time, round(duration_in_seconds, 4) AS duration_in_seconds,
  date, day_of_week, hour_of_day FROM we""", qz=QZ_SQL, hol=HOL_SQL, we=WE_SQL, **CTES))
def m63_weekday_extract(spark, sf_dir):
    w = weekday_extract(spark, sf_dir, BOUND_QUALIFY_MIN)
    return w.select("type", "external_id", "start_zone", "end_zone", "start_time",
                    F.round("duration_in_seconds", 4).alias("duration_in_seconds"), "date", "day_of_week",
                    "hour_of_day")


def travel_times(spark, sf_dir, mode: str):
    """Monthly travel times by zone pair, weekday flag, rain flag and
    time bucket (E6 join by day, C23, F7, F8 ratio of sums, D5)."""
    c = comparison_fact(spark, sf_dir).filter(F.col("type") == mode)
    if mode == "taxi":
        c = c.filter(F.col("trip_distance").between(0.1, 100))
    c = Rel.not_in_set(c, "date", holidays(spark))
    w = daily_weather(spark, sf_dir).select("date", "precipitation")
    c = c.join(w, "date")
    g = c.groupBy("start_zone", "end_zone", F.to_date(tp.trunc_ts("month", "start_time")).alias("month"),
                  F.col("day_of_week").isin(1, 2, 3, 4, 5).alias("weekday"),
                  (F.col("precipitation") > RAIN).alias("date_with_precipitation"),
                  C.time_bucket("hour_of_day").alias("time_bucket"))
    aggs = [F.count(F.lit(1)).alias("trips"), F.round(F.avg("duration_in_seconds"), 6).alias("avg_duration")]
    if mode == "taxi":
        aggs += [F.round(F.avg("trip_distance"), 6).alias("avg_distance"),
                 F.round(R.share(F.sum("trip_distance"), F.sum("duration_in_seconds") / 3600), 6).alias("avg_mph")]
    return g.agg(*aggs)


def _tt_sql(mode):
    """Oracle: totals per (day, hour) cell first, then labels from small tables and ratios of totals."""
    taxi = mode == "taxi"
    means = """, round(sum(dist) / sum(n), 6) AS avg_distance,
  round(3600 * sum(dist) / nullif(sum(secs), 0), 6) AS avg_mph""" if taxi else ""
    return f"""WITH cells AS (
  SELECT start_zone, end_zone, date, day_of_week, hour_of_day, count(*) AS n, sum(duration_in_seconds) AS secs, sum(trip_distance) AS dist
  FROM comp WHERE type = '{mode}'{" AND trip_distance >= 0.1 AND trip_distance <= 100" if taxi else ""} GROUP BY ALL)
SELECT x.start_zone, x.end_zone, make_date(year(x.date), month(x.date), 1) AS month, x.day_of_week % 6 <> 0 AS weekday,
  w.precipitation > {RAIN} AS date_with_precipitation, coalesce(b.label, 'other') AS time_bucket,
  CAST(sum(n) AS BIGINT) AS trips, round(sum(secs) / sum(n), 6) AS avg_duration{means}
FROM cells x JOIN w USING (date) ANTI JOIN hol USING (date)
LEFT JOIN (VALUES (8, 10, 'morning'), (11, 15, 'midday'), (16, 18, 'afternoon'), (19, 21, 'evening')) b(lo, hi, label)
  ON x.hour_of_day BETWEEN b.lo AND b.hi
GROUP BY ALL"""


@register("m64_taxi_travel_times", with_ctes(_tt_sql("taxi"), hol=HOL_SQL, w=WEATHER_SQL, **CTES))
def m64_taxi_travel_times(spark, sf_dir):
    return travel_times(spark, sf_dir, "taxi")


@register("m65_bike_travel_times", with_ctes(_tt_sql("bike"), hol=HOL_SQL, w=WEATHER_SQL, **CTES))
def m65_bike_travel_times(spark, sf_dir):
    return travel_times(spark, sf_dir, "bike")


@register("m66_avg_distance_by_pair", with_ctes("""
SELECT start_zone, end_zone, round(avg(trip_distance), 6) AS avg_distance, count(*) AS trips
FROM comp WHERE type = 'taxi' GROUP BY ALL""", **CTES))
def m66_avg_distance_by_pair(spark, sf_dir):
    """Average trip distance by zone pair."""
    c = comparison_fact(spark, sf_dir).filter(F.col("type") == "taxi")
    return c.groupBy("start_zone", "end_zone").agg(F.round(F.avg("trip_distance"), 6).alias("avg_distance"),
                                                   F.count(F.lit(1)).alias("trips"))


AIRPORT_ZONES = [1, 2, 3]


def served_flags(spark, sf_dir):
    """Weekday taxi trips by zone pair, flagged whether both zones are
    bike-served (distinct served zones, F11; IN-subquery as a value, D6)."""
    c = comparison_fact(spark, sf_dir)
    served = c.filter(F.col("type") == "bike").select(F.col("start_zone").alias("zone")).distinct()
    t = c.filter((F.col("type") == "taxi") & F.col("day_of_week").between(1, 5))
    pairs = R.count_by(t, ["start_zone", "end_zone"])
    pairs = Rel.flag_in_set(pairs, "start_zone", served, "start_served", "zone")
    return Rel.flag_in_set(pairs, "end_zone", served, "end_served", "zone")


SERVED_SQL = """SELECT start_zone, end_zone, count(*) AS trips,
  start_zone IN (SELECT DISTINCT start_zone FROM comp WHERE type = 'bike') AS start_served,
  end_zone IN (SELECT DISTINCT start_zone FROM comp WHERE type = 'bike') AS end_served
FROM comp WHERE type = 'taxi' AND day_of_week BETWEEN 1 AND 5 GROUP BY start_zone, end_zone"""


@register("m67_served_share", with_ctes(f"""
SELECT CAST(sum(trips) AS BIGINT) AS total_trips,
  round(CAST(sum(CASE WHEN start_served AND end_served THEN trips ELSE 0 END) AS DOUBLE) / sum(trips), 9) AS served_share,
  round(CAST(sum(CASE WHEN NOT (start_served AND end_served) AND (start_zone IN ({", ".join(map(str, AIRPORT_ZONES))})
      OR end_zone IN ({", ".join(map(str, AIRPORT_ZONES))})) THEN trips ELSE 0 END) AS DOUBLE)
    / nullif(sum(CASE WHEN NOT (start_served AND end_served) THEN trips ELSE 0 END), 0), 9) AS airport_share_outside
FROM served""", served=SERVED_SQL, **CTES))
def m67_served_share(spark, sf_dir):
    """Share of taxi trips inside the served area and the airport share
    outside it, as one grand-total aggregate (F12)."""
    s = served_flags(spark, sf_dir)
    both = F.col("start_served") & F.col("end_served")
    air = F.col("start_zone").isin(*AIRPORT_ZONES) | F.col("end_zone").isin(*AIRPORT_ZONES)
    return s.agg(F.sum("trips").cast("bigint").alias("total_trips"),
                 F.round(R.share(R.cond_sum(both, "trips"), F.sum("trips")), 9).alias("served_share"),
                 F.round(R.share(R.cond_sum(~both & air, "trips"), R.cond_sum(~both, "trips")), 9)
                  .alias("airport_share_outside"))


@register("m68_outside_zone_ranking", with_ctes("""
WITH unserved AS (SELECT location_id FROM zones ANTI JOIN (SELECT start_zone AS location_id FROM comp WHERE type = 'bike') USING (location_id)),
outside AS (
  SELECT start_zone, end_zone FROM comp
  WHERE type = 'taxi' AND day_of_week % 6 <> 0 AND len(list_intersect([start_zone, end_zone], (SELECT list(location_id) FROM unserved))) > 0),
ends AS (SELECT 'pickup' AS role, start_zone AS zone_id FROM outside UNION ALL SELECT 'dropoff', end_zone FROM outside)
SELECT e.role, e.zone_id, z.zone, z.borough, count(*) AS trips
FROM ends e LEFT JOIN zones z ON e.zone_id = z.location_id GROUP BY ALL""", zones=ZONES_SQL, **CTES))
def m68_outside_zone_ranking(spark, sf_dir):
    """Weekday taxi trips with either end outside the served area, ranked by
    pickup zone and by drop-off zone, with names (D5, D10, E4; H1/H2 sort at the sink)."""
    s = served_flags(spark, sf_dir).filter(~F.col("start_served") | ~F.col("end_served"))
    ends = s.select("trips", F.explode(F.create_map(F.lit("pickup"), F.col("start_zone"), F.lit("dropoff"), F.col("end_zone")))
                    .alias("role", "zone_id"))
    agg = ends.groupBy("role", "zone_id").agg(F.sum("trips").cast("bigint").alias("trips"))
    z = zones(spark, sf_dir)
    return (agg.join(F.broadcast(z), agg.zone_id == z.location_id, "left")
               .select("role", "zone_id", "zone", "borough", "trips").orderBy("role", F.desc("trips")))


# ---------------------------------------------------------------------------
# K5 - K10
# ---------------------------------------------------------------------------
WR_COLS = ["win_rate", "mean_margin_a_wins", "mean_margin_b_wins", "mean_a", "mean_b"]


def _wr(df, dims):
    r = K.win_rate(df, dims, "type", "taxi", "bike", "duration_in_seconds", min_obs=MIN_OBS)
    return r.select(*dims, "n_a", "n_b", *[F.round(c, 9).alias(c) for c in WR_COLS])


def _wr_parts(dims, src="comp"):
    """Oracle for K5: the brute-force pair join within each bucket (CTE
    definitions, final SELECT)."""
    d = ", ".join(dims)
    on = " AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in dims)
    ad = ", ".join(f"a.{x}" for x in dims)
    ctes = {
        "src": f"SELECT {d}, type, duration_in_seconds AS v FROM {src}",
        "cnt": f"""SELECT {d}, CAST(count_if(type = 'taxi') AS BIGINT) AS n_a, CAST(count_if(type = 'bike') AS BIGINT) AS n_b,
  sum(CASE WHEN type = 'taxi' THEN v END) AS s_a, sum(CASE WHEN type = 'bike' THEN v END) AS s_b
FROM src GROUP BY ALL HAVING count_if(type = 'taxi') >= {MIN_OBS} AND count_if(type = 'bike') >= {MIN_OBS}""",
        "pairs": f"""SELECT {ad}, count_if(a.v < b.v) AS a_wins, sum(CASE WHEN a.v < b.v THEN b.v - a.v END) AS a_margin,
  sum(CASE WHEN a.v >= b.v THEN a.v - b.v END) AS b_margin, count(*) AS n_pairs
FROM (SELECT * FROM src WHERE type = 'taxi') a JOIN (SELECT * FROM src WHERE type = 'bike') b ON {on}
GROUP BY ALL""",
        "wr": f"""SELECT {", ".join(f"c.{x}" for x in dims)}, c.n_a, c.n_b,
  CAST(p.a_wins AS DOUBLE) / (c.n_a * c.n_b) AS win_rate,
  p.a_margin / nullif(p.a_wins, 0) AS mean_margin_a_wins,
  p.b_margin / nullif(p.n_pairs - p.a_wins, 0) AS mean_margin_b_wins,
  c.s_a / c.n_a AS mean_a, c.s_b / c.n_b AS mean_b
FROM cnt c JOIN pairs p ON {" AND ".join(f"c.{x} IS NOT DISTINCT FROM p.{x}" for x in dims)}""",
    }
    final = f"SELECT {d}, n_a, n_b, " + ", ".join(f"round({c}, 9) AS {c}" for c in WR_COLS) + " FROM wr"
    return ctes, final


def _wr_sql(dims, src="comp", **extra):
    ctes, final = _wr_parts(dims, src)
    return with_ctes(final, **CTES, **extra, **ctes)


def _with_bucket(c):
    return c.withColumn("time_bucket", C.time_bucket("hour_of_day"))


BUCKET_SQL = """SELECT *, CASE WHEN hour_of_day BETWEEN 8 AND 10 THEN 'morning' WHEN hour_of_day BETWEEN 11 AND 15 THEN 'midday'
  WHEN hour_of_day BETWEEN 16 AND 18 THEN 'afternoon' WHEN hour_of_day BETWEEN 19 AND 21 THEN 'evening' ELSE 'other' END AS time_bucket
FROM comp"""


@register("k5_win_rate_by_day", _wr_sql(["date"]))
def k5_win_rate_by_day(spark, sf_dir):
    """K5: exact taxi win rate per day bucket (no cross product)."""
    return _wr(comparison_fact(spark, sf_dir), ["date"])


@register("m70_win_rate_zone_time_bucket", _wr_sql(["start_zone", "time_bucket"], src="cb", cb=BUCKET_SQL))
def m70_win_rate_zone_time_bucket(spark, sf_dir):
    """M70 / K9 variant 1: start zone x time bucket."""
    return _wr(_with_bucket(comparison_fact(spark, sf_dir)), ["start_zone", "time_bucket"])


@register("m70_win_rate_zone_hour", _wr_sql(["start_zone", "hour_of_day"]))
def m70_win_rate_zone_hour(spark, sf_dir):
    """M70 / K9 variant 2: start zone x hour."""
    return _wr(comparison_fact(spark, sf_dir), ["start_zone", "hour_of_day"])


@register("m70_win_rate_zone_weekday", _wr_sql(["start_zone", "day_of_week"]))
def m70_win_rate_zone_weekday(spark, sf_dir):
    """M70 / K9 variant 3: start zone x day of week."""
    return _wr(comparison_fact(spark, sf_dir), ["start_zone", "day_of_week"])


RAINY_SQL = f"SELECT c.* FROM comp c JOIN w ON c.date = w.date WHERE w.precipitation >= {RAIN}"


@register("m70_win_rate_rainy_days", _wr_sql(["start_zone"], src="rainy", w=WEATHER_SQL, rainy=RAINY_SQL))
def m70_win_rate_rainy_days(spark, sf_dir):
    """M70 / K9 variant 4: rainy days only (precipitation >= threshold, T20), by start zone."""
    w = daily_weather(spark, sf_dir).select("date", "precipitation")
    c = comparison_fact(spark, sf_dir).join(w, "date")
    r = K.compare(c, ["start_zone"], "type", "taxi", "bike", "duration_in_seconds",
                  filters=[F.col("precipitation") >= RAIN], min_obs=MIN_OBS)
    return r.select("start_zone", "n_a", "n_b", *[F.round(c, 9).alias(c) for c in WR_COLS])


@register("m70_mode_summaries", with_ctes(f"""
SELECT date, round(avg(CASE WHEN type = 'taxi' THEN duration_in_seconds END), 6) AS mean_a,
  round(avg(CASE WHEN type = 'bike' THEN duration_in_seconds END), 6) AS mean_b,
  round(median(CASE WHEN type = 'taxi' THEN duration_in_seconds END), 6) AS median_a,
  round(median(CASE WHEN type = 'bike' THEN duration_in_seconds END), 6) AS median_b
FROM comp GROUP BY date""", **CTES))
def m70_mode_summaries(spark, sf_dir):
    """K8: per-bucket mean and exact median duration by mode."""
    m = K.medians_by_mode(comparison_fact(spark, sf_dir), ["date"], "type", "taxi", "bike",
                          "duration_in_seconds")
    return m.select("date", *[F.round(c, 6).alias(c) for c in ["mean_a", "mean_b", "median_a", "median_b"]])


@register("k7_median_margins_by_day", with_ctes(f"""
SELECT a.date, any_value(a.n) AS n_a, any_value(b.n) AS n_b,
  round(median(b.v - a.v) FILTER (b.v > a.v), 6) AS median_margin_a_wins,
  round(median(a.v - b.v) FILTER (b.v <= a.v), 6) AS median_margin_b_wins
FROM (SELECT date, duration_in_seconds AS v, count(*) OVER (PARTITION BY date) AS n FROM comp WHERE type = 'taxi') a
JOIN (SELECT date, duration_in_seconds AS v, count(*) OVER (PARTITION BY date) AS n FROM comp WHERE type = 'bike') b USING (date)
WHERE least(a.n, b.n) >= {MIN_OBS} GROUP BY a.date""", **CTES))
def k7_median_margins_by_day(spark, sf_dir):
    """K7: exact median margin over all taxi-bike pairs of a day, by winner."""
    m = median_margins(comparison_fact(spark, sf_dir), ["date"], "type", "taxi", "bike", "duration_in_seconds", min_obs=MIN_OBS)
    return m.select("date", "n_a", "n_b", *[F.round(c, 6).alias(c) for c in ("median_margin_a_wins", "median_margin_b_wins")])


@register("k7_median_margins_by_zone_hour", with_ctes(f"""
WITH s AS (SELECT start_zone, hour_of_day, type, duration_in_seconds AS v, count(*) OVER (PARTITION BY start_zone, hour_of_day, type) AS n FROM comp)
SELECT a.start_zone, a.hour_of_day, any_value(a.n) AS n_a, any_value(b.n) AS n_b,
  round(median(b.v - a.v) FILTER (b.v > a.v), 6) AS median_margin_a_wins,
  round(median(a.v - b.v) FILTER (b.v <= a.v), 6) AS median_margin_b_wins
FROM s a JOIN s b ON a.start_zone IS NOT DISTINCT FROM b.start_zone AND a.hour_of_day IS NOT DISTINCT FROM b.hour_of_day
WHERE a.type = 'taxi' AND b.type = 'bike' AND least(a.n, b.n) >= {MIN_OBS} GROUP BY ALL""", **CTES))
def k7_median_margins_by_zone_hour(spark, sf_dir):
    """K7: exact median margins by start zone and hour: many small buckets in the same jobs."""
    m = median_margins(comparison_fact(spark, sf_dir), ["start_zone", "hour_of_day"], "type", "taxi", "bike", "duration_in_seconds", min_obs=MIN_OBS)
    return m.select("start_zone", "hour_of_day", "n_a", "n_b", *[F.round(c, 6).alias(c) for c in ("median_margin_a_wins", "median_margin_b_wins")])


DRAWS = 10_000


@register("k6_bootstrap_win_rate", with_ctes(f"""
WITH side AS (
  SELECT date, type, duration_in_seconds AS v, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY date, type) AS n
  FROM comp WINDOW w AS (PARTITION BY date, type ORDER BY duration_in_seconds)),
cells AS (SELECT a.date, a.n AS n_a, b.n AS n_b FROM (SELECT DISTINCT date, n FROM side WHERE type = 'taxi') a
          JOIN (SELECT DISTINCT date, n FROM side WHERE type = 'bike') b USING (date) WHERE least(a.n, b.n) >= {MIN_OBS}),
draws AS (
  SELECT date, n_a, n_b, ('0x' || substr(md5('1|' || date || '|' || draw || '|a'), 1, 15))::BIGINT % n_a AS ia,
    ('0x' || substr(md5('1|' || date || '|' || draw || '|b'), 1, 15))::BIGINT % n_b AS ib
  FROM cells, range(1, {DRAWS + 1}) r(draw)),
met AS (
  SELECT d.date, d.n_a, d.n_b, b.v - a.v AS diff FROM draws d
  JOIN side a ON a.type = 'taxi' AND a.date = d.date AND a.i = d.ia
  JOIN side b ON b.type = 'bike' AND b.date = d.date AND b.i = d.ib),
exact AS (
  SELECT a.date, avg(CASE WHEN a.v < b.v THEN 1.0 ELSE 0 END) AS win_rate FROM side a JOIN side b ON a.date = b.date
  WHERE a.type = 'taxi' AND b.type = 'bike' GROUP BY a.date)
SELECT date, count(*) AS draws, round(avg(CASE WHEN diff > 0 THEN 1.0 ELSE 0 END), 6) AS sampled_win_rate,
  round(avg(diff) FILTER (diff > 0), 6) AS mean_margin_a_wins, round(median(diff) FILTER (diff > 0), 6) AS median_margin_a_wins,
  round(-avg(diff) FILTER (diff <= 0), 6) AS mean_margin_b_wins, round(-median(diff) FILTER (diff <= 0), 6) AS median_margin_b_wins,
  round(any_value(win_rate), 6) AS win_rate, any_value(n_a) AS n_a, any_value(n_b) AS n_b
FROM met JOIN exact USING (date) GROUP BY date""", **CTES))
def k6_bootstrap_win_rate(spark, sf_dir):
    """K6/K7: seeded bootstrap (10,000 draws per day bucket), sampled win rate
    and winning margins (mean and median) next to the exact K5 rate."""
    c = comparison_fact(spark, sf_dir)
    draws = K.bootstrap_pairs(c, ["date"], "type", "taxi", "bike", "duration_in_seconds", n=DRAWS, seed=1,
                              min_obs=MIN_OBS)
    m = K.winning_margins(draws, ["date"])
    exact = K.win_rate(c, ["date"], "type", "taxi", "bike", "duration_in_seconds", min_obs=MIN_OBS)
    j = m.join(exact.select("date", "win_rate", "n_a", "n_b"), "date")
    return j.select("date", "draws", *[F.round(c, 6).alias(c) for c in m.columns if c not in ("date", "draws")],
                    F.round("win_rate", 6).alias("win_rate"), "n_a", "n_b")


# The extract's variants, each with the end zone in the bucket.
def extract_rates(spark, sf_dir, dims, where=None):
    w = _with_bucket(weekday_extract(spark, sf_dir, BOUND_QUALIFY_MIN)).withColumn("month", F.to_date(tp.trunc_ts("month", "start_time")))
    if where is not None:
        w = where(w)
    dims = ["start_zone", "end_zone", *dims]
    r = K.win_rate(w, dims, "type", "taxi", "bike", "duration_in_seconds", min_obs=BOUND_MIN_OBS)
    return r.select(*dims, "n_a", "n_b", *[F.round(c, 9).alias(c) for c in WR_COLS])


def _extract_parts(dims, where=""):
    """Oracle CTEs for ``extract_rates``: every pair of the bucket, counted."""
    ctes, final = _wr_parts(["start_zone", "end_zone", *dims], src="ex")
    ctes = {k: v.replace(f">= {MIN_OBS}", f">= {BOUND_MIN_OBS}") for k, v in ctes.items()}
    ex = f"""SELECT we.*, make_date(year(date), month(date), 1) AS month, coalesce(b.label, 'other') AS time_bucket
FROM we LEFT JOIN (VALUES (8, 10, 'morning'), (11, 15, 'midday'), (16, 18, 'afternoon'), (19, 21, 'evening')) b(lo, hi, label)
  ON we.hour_of_day BETWEEN b.lo AND b.hi {where}"""
    return {**CTES, "qz": QZ_SQL, "hol": HOL_SQL, "we": WE_SQL, "w": WEATHER_SQL, "ex": ex, **ctes}, final


def _rainy(w, spark, sf_dir):
    days = daily_weather(spark, sf_dir).filter(F.col("precipitation") >= RAIN).select("date")
    return w.join(days, "date", "left_semi")


_VARIANTS = {
    "m70_pair_time_bucket": (["time_bucket"], "", None),
    "m70_pair_hour": (["hour_of_day"], "", None),
    "m70_pair_bucket_date": (["time_bucket", "date"], "", None),
    "m70_pair_bucket_month": (["time_bucket", "month"], "WHERE hour_of_day BETWEEN 8 AND 18",
                              lambda w, spark, sf_dir: w.filter(F.col("hour_of_day").between(8, 18))),
    "m70_pair_rainy_days": (["time_bucket"], f"SEMI JOIN (SELECT date FROM w WHERE precipitation >= {RAIN}) r ON r.date = we.date", _rainy),
}


def _register_variants():
    for key, (dims, where, pick) in _VARIANTS.items():
        ctes, final = _extract_parts(dims, where)

        def q(spark, sf_dir, dims=dims, pick=pick):
            return extract_rates(spark, sf_dir, dims, pick and (lambda w: pick(w, spark, sf_dir)))
        q.__doc__ = f"M70 / K9: win rates of the weekday extract by start zone, end zone, {', '.join(dims)}."
        register(key, with_ctes(final, **ctes))(q)


# Called below, once the oracle helpers exist.


def zone_hour_rates(spark, sf_dir):
    c = comparison_fact(spark, sf_dir)
    return K.win_rate(c, ["start_zone", "hour_of_day"], "type", "taxi", "bike", "duration_in_seconds",
                      min_obs=MIN_OBS)


_M71_CTES, _ = _wr_parts(["start_zone", "hour_of_day"])


@register("m71_weighted_win_rate_by_hour", with_ctes(
    "SELECT hour_of_day, round(sum(win_rate * n_a) / sum(CASE WHEN win_rate IS NOT NULL THEN n_a END), 9) AS weighted_rate, "
    "CAST(sum(n_a) AS BIGINT) AS n_a FROM wr GROUP BY hour_of_day", **CTES, **_M71_CTES))
def m71_weighted_win_rate_by_hour(spark, sf_dir):
    """Taxi-trip-weighted win rate by hour over zone-hour buckets."""
    r = K.weighted_rate(zone_hour_rates(spark, sf_dir), ["hour_of_day"], "win_rate", "n_a")
    return r.select("hour_of_day", F.round("weighted_rate", 9).alias("weighted_rate"),
                    F.col("n_a").cast("bigint").alias("n_a"))


@register("m72_median_series_long", with_ctes("""
SELECT date, mode, round(value, 6) AS value FROM (
  SELECT date, median(CASE WHEN type = 'taxi' THEN duration_in_seconds END) AS taxi,
         median(CASE WHEN type = 'bike' THEN duration_in_seconds END) AS bike
  FROM comp WHERE start_zone = 7 GROUP BY date)
UNPIVOT (value FOR mode IN (taxi, bike))""", **CTES))
def m72_median_series_long(spark, sf_dir):
    """One start zone's daily median durations by mode, wide -> long."""
    c = comparison_fact(spark, sf_dir).filter(F.col("start_zone") == 7)
    med = K.exact_percentiles(c, ["date", "type"], "duration_in_seconds", [0.5], ["median"])
    days = c.select("date").distinct()
    w = K.join_null_safe(days, med.filter(F.col("type") == "taxi").select("date", F.col("median").alias("taxi")),
                         ["date"], "left")
    w = K.join_null_safe(w, med.filter(F.col("type") == "bike").select("date", F.col("median").alias("bike")),
                         ["date"], "left")
    long = Rel.unpivot(w, ["date"], ["taxi", "bike"], "mode", "value")
    return long.filter(F.col("value").isNotNull()).select("date", "mode", F.round("value", 6).alias("value"))


@register("m72_route_median_series", with_ctes("""
SELECT date, type AS mode, round(quantile_cont(duration_in_seconds, 0.5) / 60, 6) AS minutes
FROM comp WHERE start_zone = 7 AND end_zone = 12 GROUP BY ALL""", **CTES))
def m72_route_median_series(spark, sf_dir):
    """One route's (zone pair's) daily median minutes by mode, long format."""
    c = comparison_fact(spark, sf_dir).filter((F.col("start_zone") == 7) & (F.col("end_zone") == 12))
    med = K.exact_percentiles(c, ["date", "type"], "duration_in_seconds", [0.5], ["median"])
    return med.select("date", F.col("type").alias("mode"), F.round(F.col("median") / 60, 6).alias("minutes"))


@register("m73_slow_day_ratio", with_ctes("""
WITH t AS (
  SELECT zs.borough AS a, ze.borough AS b, x.label, we.date, we.type, we.duration_in_seconds AS v
  FROM we JOIN zones zs ON we.start_zone = zs.location_id JOIN zones ze ON we.end_zone = ze.location_id
  JOIN (VALUES (8, 10, 'morning'), (11, 15, 'midday'), (16, 18, 'afternoon')) x(lo, hi, label) ON we.hour_of_day BETWEEN x.lo AND x.hi),
days AS (SELECT a, b, label, date, median(v) FILTER (type = 'taxi') AS taxi, median(v) FILTER (type = 'bike') AS bike
         FROM t GROUP BY ALL HAVING count(DISTINCT type) = 2),
usual AS (SELECT a, b, label, median(taxi) AS taxi, median(bike) AS bike FROM days GROUP BY ALL),
late AS (SELECT d.taxi - u.taxi AS taxi, d.bike - u.bike AS bike FROM days d JOIN usual u ON d.a = u.a AND d.b = u.b AND d.label = u.label)
SELECT count(*) FILTER (taxi >= 300) AS taxi_over_300, count(*) FILTER (bike >= 300) AS bike_over_300,
  count(*) FILTER (taxi >= 600) AS taxi_over_600, count(*) FILTER (bike >= 600) AS bike_over_600,
  round(count(*) FILTER (taxi >= 300) / nullif(CAST(count(*) FILTER (bike >= 300) AS DOUBLE), 0), 9) AS ratio_300,
  round(count(*) FILTER (taxi >= 600) / nullif(CAST(count(*) FILTER (bike >= 600) AS DOUBLE), 0), 9) AS ratio_600
FROM late""", zones=ZONES_SQL, qz=QZ_SQL, hol=HOL_SQL, we=WE_SQL, **CTES))
def m73_slow_day_ratio(spark, sf_dir):
    """Days on which a route's daily median is 5 and 10 minutes or more above its
    usual (median) day, taxi against bike, over daytime buckets. Routes are borough pairs
    here: zone pairs of the bound tables rarely have both modes on one day."""
    w = _with_bucket(weekday_extract(spark, sf_dir, BOUND_QUALIFY_MIN)).filter(F.col("time_bucket").isin("morning", "midday", "afternoon"))
    w = Rel.lookup_twice(w, zones(spark, sf_dir), "location_id", "start_zone", "end_zone", ["borough"], "s_", "e_")
    route = ["s_borough", "e_borough", "time_bucket"]
    days = K.medians_by_mode(w, [*route, "date"], "type", "taxi", "bike", "duration_in_seconds")
    days = days.filter(F.col("median_a").isNotNull() & F.col("median_b").isNotNull())
    r = S.delay_vs_median(days.withColumnsRenamed({"median_a": "taxi", "median_b": "bike"}), route, ["taxi", "bike"], (300, 600))
    return r.select("taxi_over_300", "bike_over_300", "taxi_over_600", "bike_over_600",
                    F.round("ratio_300", 9).alias("ratio_300"), F.round("ratio_600", 9).alias("ratio_600"))


def ols_sql(src: str, terms: list[tuple[str, str]], y: str, weight: str) -> str:
    """Oracle of a weighted regression: Gauss-Jordan steps over the cross-products in SQL.

    ``terms`` are (name, expression) in order, the intercept first; a term whose
    pivot vanishes is aliased: null estimate and error."""
    k = len(terms)
    values = ", ".join(f"CAST({e} AS DOUBLE)" for _, e in [*terms, ("", y)])
    steps = [f"""x AS MATERIALIZED (SELECT CAST({weight} AS DOUBLE) AS w, [{values}] AS v FROM {src}),
ok AS MATERIALIZED (SELECT * FROM x WHERE list_aggregate(v, 'count') = {k + 1} AND w IS NOT NULL),
m0 AS MATERIALIZED (
  SELECT i, j, CASE WHEN j <= {k + 1} THEN s ELSE CASE WHEN j = i + {k + 1} THEN 1.0 ELSE 0 END END AS a
  FROM (SELECT i, j, (SELECT sum(w * v[i] * v[least(j, {k + 1})]) FROM ok) AS s
        FROM range(1, {k + 2}) r(i), range(1, {2 * k + 2}) c(j)))"""]
    for p in range(1, k + 1):
        q = p - 1
        steps.append(f"""m{p} AS MATERIALIZED (
  SELECT m.i, m.j, CASE WHEN o.a <= 0 OR v.a <= 1e-9 * o.a THEN m.a WHEN m.i = {p} THEN m.a / v.a ELSE m.a - c.a * r.a / v.a END AS a
  FROM m{q} m JOIN m{q} c ON c.i = m.i AND c.j = {p} JOIN m{q} r ON r.i = {p} AND r.j = m.j,
    (SELECT a FROM m{q} WHERE i = {p} AND j = {p}) v, (SELECT a FROM m0 WHERE i = {p} AND j = {p}) o)""")
    names = ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(terms, 1))
    kept = " UNION ALL ".join(f"""SELECT {p} AS i, (SELECT a FROM m0 WHERE i = {p} AND j = {p}) > 0
  AND (SELECT a FROM m{p - 1} WHERE i = {p} AND j = {p}) > 1e-9 * (SELECT a FROM m0 WHERE i = {p} AND j = {p}) AS kept""" for p in range(1, k + 1))
    return "WITH " + ",\n".join(steps) + f""",
kept AS MATERIALIZED ({kept}),
sigma AS (SELECT (SELECT a FROM m{k} WHERE i = {k + 1} AND j = {k + 1})
  / ((SELECT count(*) FROM ok) - (SELECT count(*) FROM kept WHERE kept)) AS s2)
SELECT n.term, CASE WHEN q.kept THEN round(e.a, 6) END AS estimate, CASE WHEN q.kept THEN round(sqrt(s2 * d.a), 6) END AS std_error,
  CASE WHEN q.kept THEN round(exp(e.a), 6) END AS multiplier
FROM (VALUES {names}) n(i, term) JOIN kept q USING (i) JOIN m{k} e ON e.i = n.i AND e.j = {k + 1}
JOIN m{k} d ON d.i = n.i AND d.j = n.i + {k + 1}, sigma"""


YEARS, MONTHS = ["2024", "2025"], [str(m) for m in range(1, 13)]
BUCKETS = ["morning", "midday", "afternoon", "evening", "other"]


def _factors(routes):
    return {"time_bucket": BUCKETS, "rain": ["false", "true"], "route_type": routes, "year": YEARS, "month_of_year": MONTHS}


def _terms(distance, routes):
    out = [("(Intercept)", "1"), ("sqrt_distance", f"sqrt({distance})")]
    for f, levels in _factors(routes).items():
        out += [(f"{f}{v}", f"CASE WHEN {f} = '{v}' THEN 1 WHEN {f} IS NOT NULL THEN 0 END") for v in levels[1:]]
    return out


def _reg_src(more="", join=""):
    """Travel-time cells with their factors; the oracle's route class comes from a small table."""
    return f"""(SELECT tt.*{more}, CAST(tt.date_with_precipitation AS VARCHAR) AS rain, CAST(year(tt.month) AS VARCHAR) AS year,
    CAST(month(tt.month) AS VARCHAR) AS month_of_year, c.route_type
  FROM tt {join} JOIN zones ps ON tt.start_zone = ps.location_id JOIN zones ds ON tt.end_zone = ds.location_id
  JOIN (VALUES (true, true, 'within_manhattan'), (true, false, 'manhattan_to_outer_boroughs'),
               (false, true, 'outer_boroughs_to_manhattan'), (false, false, 'within_outer_boroughs')) c(p, d, route_type)
    ON c.p = (ps.borough = 'AMERICA') AND c.d = (ds.borough = 'AMERICA')
  WHERE tt.avg_duration > 0)"""


def _regression(tt, spark, sf_dir, distance):
    z = zones(spark, sf_dir)
    tt = Rel.lookup_twice(tt, z, "location_id", "start_zone", "end_zone", ["borough"], "pickup_", "dropoff_")
    tt = tt.withColumns({"route_type": C.route_type("pickup_borough", "dropoff_borough", core="AMERICA"),
                         "rain": F.col("date_with_precipitation").cast("string"), "year": F.year("month").cast("string"),
                         "month_of_year": F.month("month").cast("string")})
    coef, _ = K.weighted_ols(tt, F.log("avg_duration"), {"sqrt_distance": F.sqrt(distance)}, _factors(list(C.ROUTE_LABELS)), "trips")
    return coef


def _tidy(coef):
    return coef.select("term", F.round("estimate", 6).alias("estimate"), F.round("std_error", 6).alias("std_error"),
                       F.round(F.exp("estimate"), 6).alias("multiplier"))


_REG = dict(zones=ZONES_SQL, hol=HOL_SQL, w=WEATHER_SQL, **CTES)
_TAXI_OLS = ols_sql(_reg_src(), _terms("avg_distance", list(C.ROUTE_LABELS)), "ln(avg_duration)", "trips")


@register("m75_travel_time_regression", with_ctes(_TAXI_OLS, tt=_tt_sql("taxi"), **_REG))
def m75_travel_time_regression(spark, sf_dir):
    """Weighted OLS of log(avg duration) on sqrt(avg distance)
    and factor dummies (time bucket, rain, route type, year, month; first level =
    baseline), weight = trips. Tidy coefficients with exp(estimate) multipliers;
    aliased terms (levels that do not occur) have none."""
    tt = travel_times(spark, sf_dir, "taxi").filter(F.col("avg_duration") > 0)
    return _tidy(_regression(tt, spark, sf_dir, "avg_distance"))


@register("k4_time_bucket_multipliers", with_ctes(f"""
SELECT substr(term, 12) AS level, multiplier FROM ({_TAXI_OLS}) WHERE starts_with(term, 'time_bucket')
UNION ALL SELECT 'morning', 1.0""", tt=_tt_sql("taxi"), **_REG))
def k4_time_bucket_multipliers(spark, sf_dir):
    """K4: multipliers of the time buckets against their baseline (1.0)."""
    tt = travel_times(spark, sf_dir, "taxi").filter(F.col("avg_duration") > 0)
    m = K.multipliers(_regression(tt, spark, sf_dir, "avg_distance"), "time_bucket", "morning")
    return m.select("level", F.round("multiplier", 6).alias("multiplier"))


@register("k2_weighted_ols_single", with_ctes("""
SELECT round(sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)), 6) AS slope,
  round(any_value(my) - any_value(mx) * sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)), 6) AS intercept
FROM (SELECT *, sum(w * x) OVER () / sum(w) OVER () AS mx, sum(w * y) OVER () / sum(w) OVER () AS my
      FROM (SELECT CAST(trips AS DOUBLE) AS w, sqrt(avg_distance) AS x, ln(avg_duration) AS y FROM tt
            WHERE avg_duration > 0 AND avg_distance IS NOT NULL))""", tt=_tt_sql("taxi"), hol=HOL_SQL, w=WEATHER_SQL,
                                                     **CTES))
def k2_weighted_ols_single(spark, sf_dir):
    """K2 single-regressor case: weighted least squares from the cross-products,
    checked against the closed form."""
    tt = travel_times(spark, sf_dir, "taxi").filter((F.col("avg_duration") > 0) & F.col("avg_distance").isNotNull())
    coef, _ = K.weighted_ols(tt, F.log("avg_duration"), {"sqrt_distance": F.sqrt("avg_distance")}, {}, "trips")
    wide = coef.groupBy().pivot("term", ["sqrt_distance", "(Intercept)"]).agg(F.first("estimate"))
    return wide.select(F.round("sqrt_distance", 6).alias("slope"), F.round("(Intercept)", 6).alias("intercept"))


# ---------------------------------------------------------------------------
# M71 (route type) and M74 (crosstown / uptown regions)
# ---------------------------------------------------------------------------
# Fixed parameters: thresholds on rotated coordinates, relative to the core
# borough's centroid (feet).
UPTOWN_X = [-8000.0, 0.0, 8000.0]
CROSSTOWN_Y = [-15000.0, -10000.0, -5000.0, 0.0, 5000.0, 10000.0, 15000.0]
PAIR_DIMS = ["start_zone", "end_zone"]
_PAIR_CTES, _ = _wr_parts(PAIR_DIMS)


def pair_rates(spark, sf_dir):
    return K.win_rate(comparison_fact(spark, sf_dir), PAIR_DIMS, "type", "taxi", "bike",
                      "duration_in_seconds", min_obs=MIN_OBS)


def region_buckets(spark, sf_dir):
    """Zone -> uptown bucket (rotated x) and crosstown bucket
    (rotated y), thresholds relative to the rotation origin."""
    from .spatial_queries import rotated_zones
    r = rotated_zones(spark, sf_dir)
    return r.select("gid", C.threshold_bucket(F.col("rotated_x") - F.col("ox"), UPTOWN_X).alias("uptown_bucket"),
                    C.threshold_bucket(F.col("rotated_y") - F.col("oy"), CROSSTOWN_Y).alias("crosstown_bucket"))


def _bucket_sql(expr, thresholds):
    return "CASE " + " ".join(f"WHEN {expr} < {t} THEN {i}" for i, t in enumerate(thresholds)) + f" ELSE {len(thresholds)} END"


def _region_ctes():
    from .spatial_queries import ROT
    rb = (f"SELECT gid, {_bucket_sql('rotated_x - ox', UPTOWN_X)} AS uptown_bucket, "
          f"{_bucket_sql('rotated_y - oy', CROSSTOWN_Y)} AS crosstown_bucket FROM rot")
    return dict(zones=ZONES_SQL, **ROT, rb=rb)


def _region_rates(spark, sf_dir, bucket: str):
    r = pair_rates(spark, sf_dir)
    b = region_buckets(spark, sf_dir)
    s = b.select(F.col("gid").alias("start_zone"), F.col(bucket).alias("sb"))
    e = b.select(F.col("gid").alias("end_zone"), F.col(bucket).alias("eb"))
    j = r.join(F.broadcast(s), "start_zone").join(F.broadcast(e), "end_zone").filter(F.col("sb") == F.col("eb"))
    out = K.weighted_rate(j.withColumnRenamed("sb", bucket), [bucket], "win_rate", "n_a")
    return out.select(bucket, F.round("weighted_rate", 9).alias("weighted_rate"),
                      F.round(1 - F.col("weighted_rate"), 9).alias("loss_rate"), F.col("n_a").cast("bigint").alias("n_a"))


def _region_sql(bucket):
    return with_ctes(f"""
SELECT s.{bucket}, round(sum(w.win_rate * w.n_a) / sum(w.n_a), 9) AS weighted_rate,
  round(1 - sum(w.win_rate * w.n_a) / sum(w.n_a), 9) AS loss_rate, CAST(sum(w.n_a) AS BIGINT) AS n_a
FROM wr w JOIN rb s ON w.start_zone = s.gid JOIN rb e ON w.end_zone = e.gid
WHERE s.{bucket} = e.{bucket} GROUP BY s.{bucket}""", **CTES, **_PAIR_CTES, **_region_ctes())


@register("m74_uptown_win_rates", _region_sql("uptown_bucket"))
def m74_uptown_win_rates(spark, sf_dir):
    """Taxi-weighted win and loss rates for trips within one uptown bucket."""
    return _region_rates(spark, sf_dir, "uptown_bucket")


@register("m74_crosstown_win_rates", _region_sql("crosstown_bucket"))
def m74_crosstown_win_rates(spark, sf_dir):
    """The same within one crosstown bucket."""
    return _region_rates(spark, sf_dir, "crosstown_bucket")


@register("m71_weighted_win_rate_by_route", with_ctes("""
SELECT route_type, round(sum(win_rate * n_a) / sum(n_a), 9) AS weighted_rate, CAST(sum(n_a) AS BIGINT) AS n_a
FROM (SELECT w.*, CASE WHEN ps.borough = 'AMERICA' AND ds.borough = 'AMERICA' THEN 'within_manhattan'
                       WHEN ps.borough = 'AMERICA' AND ds.borough <> 'AMERICA' THEN 'manhattan_to_outer_boroughs'
                       WHEN ps.borough <> 'AMERICA' AND ds.borough = 'AMERICA' THEN 'outer_boroughs_to_manhattan'
                       WHEN ps.borough <> 'AMERICA' AND ds.borough <> 'AMERICA' THEN 'within_outer_boroughs' END AS route_type
      FROM wr w JOIN zones ps ON w.start_zone = ps.location_id JOIN zones ds ON w.end_zone = ds.location_id)
GROUP BY route_type""", zones=ZONES_SQL, **CTES, **_PAIR_CTES))
def m71_weighted_win_rate_by_route(spark, sf_dir):
    """Weighted win rate by route class (C27, summary variant without a catch-all)."""
    r = pair_rates(spark, sf_dir)
    z = zones(spark, sf_dir)
    r = Rel.lookup_twice(r, z, "location_id", "start_zone", "end_zone", ["borough"], "s_", "e_", broadcast=True)
    r = r.withColumn("route_type", C.route_type("s_borough", "e_borough", core="AMERICA", catch_all=False))
    out = K.weighted_rate(r, ["route_type"], "win_rate", "n_a")
    return out.select("route_type", F.round("weighted_rate", 9).alias("weighted_rate"),
                      F.col("n_a").cast("bigint").alias("n_a"))


COHORT_CUTOFF = "2024-01-08"


@register("d16_cohort_seen_before_cutoff", with_ctes(f"""
SELECT type, count(*) AS trips FROM comp
WHERE start_zone IN (SELECT start_zone FROM comp WHERE start_time < TIMESTAMP '{COHORT_CUTOFF}'
                     UNION SELECT end_zone FROM comp WHERE start_time < TIMESTAMP '{COHORT_CUTOFF}')
  AND end_zone IN (SELECT start_zone FROM comp WHERE start_time < TIMESTAMP '{COHORT_CUTOFF}'
                   UNION SELECT end_zone FROM comp WHERE start_time < TIMESTAMP '{COHORT_CUTOFF}')
GROUP BY type""", **CTES))
def d16_cohort_seen_before_cutoff(spark, sf_dir):
    """Keep trips whose start and end zones were both seen before a cut-off (two semi joins)."""
    c = comparison_fact(spark, sf_dir)
    kept = Rel.seen_before(c, "start_zone", "end_zone", "start_time", F.lit(COHORT_CUTOFF).cast("timestamp_ntz"))
    return R.count_by(kept, ["type"])


_BIKE_JOIN = """JOIN (SELECT start_zone AS pu, end_zone AS dz, avg(trip_distance) AS imputed_distance FROM comp
    WHERE type = 'taxi' GROUP BY ALL) g ON g.pu = tt.start_zone AND g.dz = tt.end_zone"""


@register("m75_bike_travel_time_regression", with_ctes(
    ols_sql(_reg_src(", round(g.imputed_distance, 6) AS imputed_distance", _BIKE_JOIN), _terms("imputed_distance", list(C.ROUTE_LABELS)),
            "ln(avg_duration)", "trips"), tt=_tt_sql("bike"), **_REG))
def m75_bike_travel_time_regression(spark, sf_dir):
    """K3: bike travel-time regression, all five factors, with distance imputed from the
    taxi average for the same zone pair (join with renamed keys, E15)."""
    bt = travel_times(spark, sf_dir, "bike").filter(F.col("avg_duration") > 0)
    dist = m66_avg_distance_by_pair(spark, sf_dir).select(
        F.col("start_zone").alias("pu"), F.col("end_zone").alias("do"), F.col("avg_distance").alias("imputed_distance"))
    bt = bt.join(dist, (bt.start_zone == dist.pu) & (bt.end_zone == dist.do)).drop("pu", "do")
    return _tidy(_regression(bt, spark, sf_dir, "imputed_distance"))


_register_variants()


# Further summaries of the extract's rates, weighted by taxi trips.
def _weighted(r, keys):
    out = K.weighted_rate(r, keys, "win_rate", "n_a")
    return out.select(*keys, F.round("weighted_rate", 9).alias("weighted_rate"), F.col("n_a").cast("bigint").alias("n_a"))


def _weighted_sql(keys, dims, join="", where="", pick=None):
    ctes, _ = _extract_parts(dims, where)
    names = ", ".join(keys)
    return with_ctes(f"""SELECT {names}, round(sum(win_rate * n_a) / sum(n_a), 9) AS weighted_rate, CAST(sum(n_a) AS BIGINT) AS n_a
FROM (SELECT wr.*{pick or ''} FROM wr {join}) GROUP BY {names}""", zones=ZONES_SQL, **ctes)


@register("m71_weighted_win_rate_by_month", _weighted_sql(["month"], ["time_bucket", "month"], where="WHERE hour_of_day BETWEEN 8 AND 18"))
def m71_weighted_win_rate_by_month(spark, sf_dir):
    """Weighted win rate by month of daytime trips."""
    dims, _, pick = _VARIANTS["m70_pair_bucket_month"]
    return _weighted(extract_rates(spark, sf_dir, dims, lambda w: pick(w, spark, sf_dir)), ["month"])


@register("m71_weighted_win_rate_by_date", _weighted_sql(["date"], ["time_bucket", "date"], "WHERE time_bucket = 'afternoon'"))
def m71_weighted_win_rate_by_date(spark, sf_dir):
    """Weighted afternoon win rate by date."""
    r = extract_rates(spark, sf_dir, ["time_bucket", "date"]).filter(F.col("time_bucket") == "afternoon")
    return _weighted(r, ["date"])


@register("m71_weighted_win_rate_by_distance", _weighted_sql(
    ["distance_band"], ["time_bucket"], """JOIN (SELECT start_zone AS s, end_zone AS e, avg(trip_distance) AS d FROM comp
  WHERE type = 'taxi' GROUP BY ALL) g ON g.s = wr.start_zone AND g.e = wr.end_zone WHERE time_bucket IN ('morning', 'midday', 'afternoon')""",
    pick=", 0.25 * floor(round(g.d, 6) / 0.25) + 0.125 AS distance_band"))
def m71_weighted_win_rate_by_distance(spark, sf_dir):
    """Weighted daytime win rate by band of the route's average taxi distance."""
    r = extract_rates(spark, sf_dir, ["time_bucket"]).filter(F.col("time_bucket").isin("morning", "midday", "afternoon"))
    d = m66_avg_distance_by_pair(spark, sf_dir).select("start_zone", "end_zone", C.floor_bucket("avg_distance", 0.25, 0.125).alias("distance_band"))
    return _weighted(r.join(d, ["start_zone", "end_zone"]), ["distance_band"])


@register("m71_weighted_win_rate_by_route_hour", _weighted_sql(
    ["route_type", "hour_of_day"], ["hour_of_day"], """JOIN zones ps ON wr.start_zone = ps.location_id JOIN zones ds ON wr.end_zone = ds.location_id
  JOIN (VALUES (true, true, 'within_manhattan'), (true, false, 'manhattan_to_outer_boroughs'), (false, true, 'outer_boroughs_to_manhattan'),
    (false, false, 'within_outer_boroughs')) c(p, d, route_type) ON c.p = (ps.borough = 'AMERICA') AND c.d = (ds.borough = 'AMERICA')""",
    pick=", c.route_type"))
def m71_weighted_win_rate_by_route_hour(spark, sf_dir):
    """Weighted win rate by route class and hour."""
    r = Rel.lookup_twice(extract_rates(spark, sf_dir, ["hour_of_day"]), zones(spark, sf_dir), "location_id", "start_zone", "end_zone",
                         ["borough"], "s_", "e_")
    return _weighted(r.withColumn("route_type", C.route_type("s_borough", "e_borough", core="AMERICA")), ["route_type", "hour_of_day"])


def _region_hour_sql(bucket):
    ctes, _ = _extract_parts(["hour_of_day"])
    return with_ctes(f"""SELECT s.{bucket}, w.hour_of_day, round(sum(w.win_rate * w.n_a) / sum(w.n_a), 9) AS weighted_rate, CAST(sum(w.n_a) AS BIGINT) AS n_a
FROM wr w JOIN rb s ON w.start_zone = s.gid JOIN rb e ON w.end_zone = e.gid AND e.{bucket} = s.{bucket}
GROUP BY ALL""", **{**_region_ctes(), **ctes})


def _register_regions():
    for bucket in ("uptown_bucket", "crosstown_bucket"):
        def q(spark, sf_dir, bucket=bucket):
            r = extract_rates(spark, sf_dir, ["hour_of_day"])
            b = region_buckets(spark, sf_dir).select("gid", bucket)
            j = (r.join(F.broadcast(b), r.start_zone == b.gid).drop("gid")
                  .join(F.broadcast(b.withColumnsRenamed({"gid": "_g", bucket: "_e"})), (F.col("end_zone") == F.col("_g")) & (F.col("_e") == F.col(bucket))))
            return _weighted(j, [bucket, "hour_of_day"])
        q.__doc__ = f"M74: taxi-weighted win rates within one {bucket.replace('_', ' ')} by hour (C30, K10)."
        register(f"m74_{bucket.split('_')[0]}_by_hour", _region_hour_sql(bucket))(q)


_register_regions()
