"""The comparison's entry point and what hangs on it: one simulation call by zone ids (L5), the bike trips'
export and import by column list (A22), slow days by zone pair (M73), p-values of the vote regressions (K1)
and the inverse projection (J8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import relational as Rel
from ..operators import series as S
from ..operators import stats as K
from ..operators.margins import median_margins
from ..sources import readers, writers
from .bindings import with_ctes
from .comparison import (BOUND_QUALIFY_MIN, BUCKET_SQL, CTES, HOL_SQL, MIN_OBS, QZ_SQL, WE_SQL, WR_COLS, _with_bucket, _wr_parts, bike_arm,
                         comparison_fact, taxi_arm, weekday_extract)
from .load_queries import _folder
from .market import VOTE_REGRESSION_CTES, VOTE_REGRESSION_SQL, vote_regressions
from .registry import register
from .spatial_queries import DLAT, DLON, LAT0, LON0, lonlat_zones


def run_simulation(facts: DataFrame, zone_ids: Sequence[int], dims: Sequence[str], filters: Sequence[Column] = (), min_obs: int = 5,
                   mode: str = "type", a: str = "taxi", b: str = "bike", value: str = "duration_in_seconds", medians: bool = True) -> DataFrame:
    """The whole comparison for trips that start in some zones: win rate, mean and median margins by
    winner and means of either mode, per bucket of ``dims``. Exact over all pairs; see ``win_rate`` and
    ``median_margins``. ``filters`` are further predicates of the caller (D15)."""
    some = Rel.where_all(facts.where(F.col("start_zone").isin(list(zone_ids))), list(filters))
    rates = K.win_rate(some, dims, mode, a, b, value, min_obs=min_obs)
    if not medians:
        return rates
    m = median_margins(some, dims, mode, a, b, value, min_obs=min_obs).select(*dims, "median_margin_a_wins", "median_margin_b_wins")
    return K.join_null_safe(rates, m, dims, "left")


#: Zones of the registered simulation.
SIMULATED = [1, 3, 5, 7, 11, 13]
_DIMS = ["start_zone", "time_bucket"]
_SIM_CTES, _SIM_FINAL = _wr_parts(_DIMS, src="chosen")


@register("l5_run_simulation", with_ctes(f"""
SELECT w.*, m.* EXCLUDE (z, t) FROM ({_SIM_FINAL}) w JOIN (
  SELECT a.start_zone AS z, a.time_bucket AS t, round(median(b.v - a.v) FILTER (b.v > a.v), 6) AS median_margin_a_wins,
    round(median(a.v - b.v) FILTER (b.v <= a.v), 6) AS median_margin_b_wins
  FROM (SELECT * FROM src WHERE type = 'taxi') a JOIN (SELECT * FROM src WHERE type = 'bike') b USING (start_zone, time_bucket) GROUP BY ALL) m
ON m.z = w.start_zone AND m.t = w.time_bucket""", cb=BUCKET_SQL, chosen=f"SELECT * FROM cb WHERE start_zone IN {tuple(SIMULATED)} AND hour_of_day BETWEEN 8 AND 21",
                                         **CTES, **_SIM_CTES))
def l5_run_simulation(spark, sf_dir):
    """One call by zone ids, daytime trips, by start zone and time bucket."""
    r = run_simulation(_with_bucket(comparison_fact(spark, sf_dir)), SIMULATED, _DIMS, [F.col("hour_of_day").between(8, 21)], MIN_OBS)
    return r.select(*_DIMS, "n_a", "n_b", *[F.round(c, 9).alias(c) for c in WR_COLS],
                    *[F.round(c, 6).alias(c) for c in ("median_margin_a_wins", "median_margin_b_wins")])


#: Columns that the bike trips travel with.
TRANSFER = "external_id long, start_zone int, end_zone int, start_time timestamp_ntz, end_time timestamp_ntz, duration_in_seconds double"


@register("a22_bike_export_import", with_ctes("""
SELECT type, start_zone, end_zone, CAST(start_time AS DATE) AS date, count(*) AS trips, round(sum(duration_in_seconds), 4) AS seconds
FROM comp GROUP BY ALL""", **CTES))
def a22_bike_export_import(spark, sf_dir):
    """Bike trips exported as CSV by column list, read with a declared schema and appended to the taxi trips' table."""
    path, names = _folder(spark, "transfer"), [c.split()[0] for c in TRANSFER.split(", ")]
    writers.write_csv(bike_arm(spark, sf_dir).select(*names), f"{path}/bikes")
    schema = spark.createDataFrame([], TRANSFER).schema
    bikes = readers.read_csv(spark, f"{path}/bikes", schema).withColumn("type", F.lit("bike"))
    taxis = taxi_arm(spark, sf_dir).select("type", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    writers.write_table(taxis, f"{path}/trips")
    writers.append(bikes, f"{path}/trips", ["type", *names])
    t = spark.read.parquet(f"{path}/trips")
    return t.groupBy("type", "start_zone", "end_zone", F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("duration_in_seconds"), 4).alias("seconds"))


@register("m73_slow_day_ratio_zone_pairs", with_ctes("""
WITH spans AS (SELECT * FROM (VALUES (8, 10, 'morning'), (11, 15, 'midday'), (16, 18, 'afternoon')) x(lo, hi, label)),
days AS (
  SELECT start_zone, end_zone, label, date, median(CASE type WHEN 'taxi' THEN duration_in_seconds END) AS taxi, median(CASE type WHEN 'bike' THEN duration_in_seconds END) AS bike
  FROM we JOIN spans ON hour_of_day >= lo AND hour_of_day <= hi GROUP BY ALL HAVING min(type) <> max(type)),
late AS (SELECT taxi - median(taxi) OVER r AS taxi, bike - median(bike) OVER r AS bike FROM days WINDOW r AS (PARTITION BY start_zone, end_zone, label))
SELECT (SELECT count(*) FROM days) AS days, count_if(taxi >= 30) AS taxi_over_30, count_if(bike >= 30) AS bike_over_30,
  round(count_if(taxi >= 30) / nullif(CAST(count_if(bike >= 30) AS DOUBLE), 0), 9) AS ratio_30 FROM late""", qz=QZ_SQL, hol=HOL_SQL, we=WE_SQL, **CTES))
def m73_slow_day_ratio_zone_pairs(spark, sf_dir):
    """M73 / G12 by zone pairs: days above a pair's usual daily median, taxi against bike. The bound tables
    have few days with both modes on one pair, so the margin is half a minute here."""
    w = _with_bucket(weekday_extract(spark, sf_dir, BOUND_QUALIFY_MIN)).filter(F.col("time_bucket").isin("morning", "midday", "afternoon"))
    route = ["start_zone", "end_zone", "time_bucket"]
    days = K.medians_by_mode(w, [*route, "date"], "type", "taxi", "bike", "duration_in_seconds")
    days = days.filter(F.col("median_a").isNotNull() & F.col("median_b").isNotNull())
    r = S.delay_vs_median(days.withColumnsRenamed({"median_a": "taxi", "median_b": "bike"}), route, ["taxi", "bike"], (30,))
    n = days.agg(F.count(F.lit(1)).alias("days"))
    return n.crossJoin(r).select("days", "taxi_over_30", "bike_over_30", F.round("ratio_30", 9).alias("ratio_30"))  # one row each


@register("k1_vote_regression_p_values", with_ctes(f"""
WITH fit AS (SELECT candidate, n, slope / nullif(slope_se, 0) AS t FROM ({VOTE_REGRESSION_SQL})),
steps AS (SELECT unnest(range(0, 2001)) AS i),
tail AS (
  SELECT candidate, n, t, sum(w * pow(cos(a + (pi() / 2 - a) * i / 2000), n - 3)) * (pi() / 2 - a) / sum(w * pow(cos(pi() / 2 * i / 2000), n - 3)) / (pi() / 2) AS p
  FROM (SELECT *, atan(abs(t) / sqrt(n - 2)) AS a FROM fit), (SELECT i, CASE WHEN i % 2000 = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM steps)
  GROUP BY candidate, n, t, a)
SELECT candidate, n, round(t, 5) AS slope_t, round(p, 6) AS p_value FROM tail""", **VOTE_REGRESSION_CTES))
def k1_vote_regression_p_values(spark, sf_dir):
    """Slope t and two-sided p-value of the vote regressions (the oracle integrates Student's density)."""
    o = K.with_p_value(vote_regressions(spark, sf_dir))
    return o.select("candidate", F.col("n").cast("bigint").alias("n"), F.round("slope_t", 5).alias("slope_t"), F.round("p_value", 6).alias("p_value"))


@register("j8_projection_inverse", f"""
SELECT n_nationkey AS gid, c.corner, round({LON0} + (n_nationkey % 5 + c.dx) * {DLON}, 7) AS lon, round({LAT0} + (n_nationkey // 5 + c.dy) * {DLAT}, 7) AS lat
FROM nation, (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) c(corner, dx, dy)""")
def j8_projection_inverse(spark, sf_dir):
    """Every corner projected and brought back."""
    z = lonlat_zones(spark, sf_dir).select("gid", F.posexplode(F.element_at("rings", 1)["pts"]).alias("corner", "c"))
    f = geo.lcc_forward(F.col("c.x"), F.col("c.y"))
    p = z.select("gid", "corner", f["x"].alias("x"), f["y"].alias("y"))
    b = geo.lcc_inverse(F.col("x"), F.col("y"))
    return p.select("gid", "corner", F.round(b["x"], 7).alias("lon"), F.round(b["y"], 7).alias("lat"))
