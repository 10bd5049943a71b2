"""Market share and area-weighted allocation.

Districts and zones are rectangles built from the supplier and nation rows
(as WKT text, parsed with ``parse_wkt``); their overlaps go through the
general polygon-overlap operator (J5), checked against the closed-form
rectangle intersection in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..functions import geo
from ..functions import timeparts as tp
from ..operators import rollups as R
from ..operators import spatial as SP
from ..operators import stats as K
from ..session import dealt_out
from .bindings import EV_TRIPS_SQL, ZONES_SQL, ev_trips, read, with_ctes, zones
from .cleansing import ERAS
from .registry import register

A, B = "purchase", "signup"   # the two brands being compared
# Trips before the event that a zone needs; the bound tables hold few, so the queries pass BOUND_MIN_PRE.
MIN_PRE, BOUND_MIN_PRE = 250, 30
MIN_VOTES = 1000
CANDIDATES = ["red", "blue", "hot", "cold"]


def brand_daily(spark, sf_dir):
    t = ev_trips(spark, sf_dir).filter(F.col("car_type").isin(A, B))
    return R.count_by(t, ["car_type", F.to_date("pickup_datetime").alias("date"), "pickup_location_id"])


BRAND_DAILY_SQL = f"""SELECT car_type, CAST(pickup_datetime AS DATE) AS date, pickup_location_id, count(*) AS trips
FROM trips WHERE car_type IN ('{A}', '{B}') GROUP BY ALL"""


def brand_shares(spark, sf_dir):
    """Two-brand shares by era and zone; no ELSE in the numerator, so a
    zone without the brand gets a null share (F6, T15); distinct days (F10)."""
    d = brand_daily(spark, sf_dir)
    d = d.withColumn("era", C.era("date", ERAS))
    ct = F.col("car_type")
    return d.groupBy("era", "pickup_location_id").agg(
        R.share(R.cond_sum(ct == A, "trips", else_zero=False), F.sum("trips")).alias("a_share"),
        R.share(R.cond_sum(ct == B, "trips", else_zero=False), F.sum("trips")).alias("b_share"),
        R.cond_sum(ct == A, "trips", else_zero=False).cast("bigint").alias("a_trips"),
        R.cond_sum(ct == B, "trips", else_zero=False).cast("bigint").alias("b_trips"),
        F.sum("trips").cast("bigint").alias("total_trips"),
        F.countDistinct("date").alias("days"))


# Per era and zone a row a brand, then shares of the row sums.
BS_SQL = f"""WITH sums AS (
  SELECT e.label AS era, bd.pickup_location_id, bd.car_type, sum(bd.trips) AS n FROM bd
  LEFT JOIN (VALUES {", ".join(f"('{lab}', DATE '{lo}', DATE '{hi}')" for lab, lo, hi in ERAS)}) e(label, lo, hi)
    ON bd.date BETWEEN e.lo AND e.hi GROUP BY ALL),
days AS (
  SELECT e.label AS era, bd.pickup_location_id, count(DISTINCT bd.date) AS days FROM bd
  LEFT JOIN (VALUES {", ".join(f"('{lab}', DATE '{lo}', DATE '{hi}')" for lab, lo, hi in ERAS)}) e(label, lo, hi)
    ON bd.date BETWEEN e.lo AND e.hi GROUP BY ALL),
wide AS (
  SELECT era, pickup_location_id, CAST(any_value(n) FILTER (car_type = '{A}') AS BIGINT) AS a_trips,
    CAST(any_value(n) FILTER (car_type = '{B}') AS BIGINT) AS b_trips, CAST(sum(n) AS BIGINT) AS total_trips
  FROM sums GROUP BY era, pickup_location_id)
SELECT w.*, CAST(w.a_trips AS DOUBLE) / w.total_trips AS a_share, CAST(w.b_trips AS DOUBLE) / w.total_trips AS b_share, d.days
FROM wide w JOIN days d ON w.pickup_location_id = d.pickup_location_id AND w.era IS NOT DISTINCT FROM d.era"""


@register("m45_brand_share_by_era", with_ctes("""
SELECT era, pickup_location_id, round(a_share, 9) AS a_share, round(b_share, 9) AS b_share,
  a_trips, b_trips, total_trips, days FROM bs""", trips=EV_TRIPS_SQL, bd=BRAND_DAILY_SQL, bs=BS_SQL))
def m45_brand_share_by_era(spark, sf_dir):
    s = brand_shares(spark, sf_dir)
    return s.withColumn("a_share", F.round("a_share", 9)).withColumn("b_share", F.round("b_share", 9))


def share_change(spark, sf_dir, min_pre: int = MIN_PRE):
    """Wide per-zone share change (post - pre, F5), volume filter (D12), percent labels."""
    s = brand_shares(spark, sf_dir)
    z = zones(spark, sf_dir)
    j = s.join(F.broadcast(z), s.pickup_location_id == z.location_id)
    era = F.col("era")
    g = j.groupBy("location_id", "zone", "borough").agg(
        R.signed_cond_sum(era == "during", era == "before", "b_share").alias("b_share_change"),
        F.sum(F.when(era == "before", F.col("b_share"))).alias("pre_b_share"),
        F.sum(F.when(era == "during", F.col("b_share"))).alias("post_b_share"),
        F.sum(F.when(era == "before", F.col("total_trips"))).alias("_pre_total"))
    g = g.filter(F.col("_pre_total") > min_pre).drop("_pre_total")
    return g.select("*", C.percent_label("b_share_change").alias("b_share_change_pct"),
                    C.percent_label("pre_b_share").alias("pre_b_share_pct"))


SC_SQL = f"""WITH pairs AS (
  SELECT z.*, pre.b_share AS pre_b_share, post.b_share AS post_b_share, list_sum([post.b_share, -pre.b_share]) AS b_share_change
  FROM zones z JOIN (SELECT * FROM bs WHERE era = 'before' AND total_trips > {BOUND_MIN_PRE}) pre ON pre.pickup_location_id = z.location_id
  LEFT JOIN (SELECT * FROM bs WHERE era = 'during') post ON post.pickup_location_id = z.location_id)
SELECT *, printf('%d%%', CAST(round(b_share_change * 100) AS BIGINT)) AS b_share_change_pct,
  printf('%d%%', CAST(round(pre_b_share * 100) AS BIGINT)) AS pre_b_share_pct FROM pairs"""


@register("m46_share_change_by_zone", with_ctes("""
SELECT location_id, zone, borough, round(b_share_change, 9) AS b_share_change, round(pre_b_share, 9) AS pre_b_share,
  round(post_b_share, 9) AS post_b_share, b_share_change_pct, pre_b_share_pct FROM sc""",
                                                trips=EV_TRIPS_SQL, bd=BRAND_DAILY_SQL, bs=BS_SQL, zones=ZONES_SQL, sc=SC_SQL))
def m46_share_change_by_zone(spark, sf_dir):
    s = share_change(spark, sf_dir, BOUND_MIN_PRE)
    return s.select("location_id", "zone", "borough", *[F.round(c, 9).alias(c) for c in
                                                        ["b_share_change", "pre_b_share", "post_b_share"]],
                    "b_share_change_pct", "pre_b_share_pct")


@register("m46_brand_share_by_era_wide", with_ctes(f"""
SELECT z.location_id, {", ".join(f"round(max(b_share) FILTER (era = '{e}'), 9) AS {e}_share, CAST(round(max(b_share) FILTER (era = '{e}') * 100) AS BIGINT) || '%' AS {e}_share_pct" for e, _, _ in ERAS)}
FROM bs JOIN zones z ON bs.pickup_location_id = z.location_id GROUP BY z.location_id
HAVING max(total_trips) FILTER (era = 'before') > {BOUND_MIN_PRE}""", trips=EV_TRIPS_SQL, bd=BRAND_DAILY_SQL, bs=BS_SQL, zones=ZONES_SQL))
def m46_brand_share_by_era_wide(spark, sf_dir):
    """Every era's brand share and percent label, one row per zone with enough earlier trips."""
    s, z = brand_shares(spark, sf_dir), zones(spark, sf_dir)
    j = s.join(F.broadcast(z), s.pickup_location_id == z.location_id)
    era = F.col("era")
    g = j.groupBy("location_id").agg(*[F.max(F.when(era == e, F.col("b_share"))).alias(f"{e}_share") for e, _, _ in ERAS],
                                     F.max(F.when(era == "before", F.col("total_trips"))).alias("_pre"))
    g = g.filter(F.col("_pre") > BOUND_MIN_PRE)
    cols = [c for e, _, _ in ERAS for c in (F.round(f"{e}_share", 9).alias(f"{e}_share"), C.percent_label(f"{e}_share").alias(f"{e}_share_pct"))]
    return g.select("location_id", *cols)


def votes_by_district(spark, sf_dir):
    """Raw returns -> typed (thousands separators, A21), candidate name with the
    first parenthetical removed (I11, T10), prefix filter (D7), summed by district."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    raw = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_suppkey").alias("election_district"),
        F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") ("), "p_type", F.lit(")")).alias("unit_name"),
        F.format_number(F.col("l_quantity") * 1000, 0).alias("tally_as_text"))
    er = raw.select("election_district", F.trim(tp.replace_first("unit_name", r"\(.+?\)")).alias("candidate"),
                    F.regexp_replace("tally_as_text", ",", "").cast("int").alias("tally"))
    cond = None
    for c in CANDIDATES:
        cond = F.col("candidate").like(f"{c}%") if cond is None else cond | F.col("candidate").like(f"{c}%")
    return er.filter(cond).groupBy("election_district", "candidate").agg(F.sum("tally").cast("bigint").alias("votes"))


VBD_SQL = f"""SELECT election_district, candidate, CAST(sum(tally) AS BIGINT) AS votes
FROM (SELECT l_suppkey AS election_district,
        trim(regexp_replace(p_name || ' (' || p_brand || ') (' || p_type || ')', '\\(.+?\\)', '')) AS candidate,
        CAST(replace(format('{{:,}}', CAST(l_quantity * 1000 AS BIGINT)), ',', '') AS INTEGER) AS tally
      FROM lineitem JOIN part ON l_partkey = p_partkey)
WHERE {" OR ".join(f"candidate LIKE '{c}%'" for c in CANDIDATES)}
GROUP BY ALL"""


@register("m47_votes_by_district", VBD_SQL)
def m47_votes_by_district(spark, sf_dir):
    return votes_by_district(spark, sf_dir)


def _rect_wkt(x0, y0, w, h):
    x1, y1 = x0 + F.lit(w), y0 + F.lit(h)
    s = lambda c: c.cast("string")
    return F.concat(F.lit("POLYGON(("), s(x0), F.lit(" "), s(y0), F.lit(", "), s(x1), F.lit(" "), s(y0), F.lit(", "),
                    s(x1), F.lit(" "), s(y1), F.lit(", "), s(x0), F.lit(" "), s(y1), F.lit(", "),
                    s(x0), F.lit(" "), s(y0), F.lit("))"))


# Fixed parameters: rectangle layout of district and zone polygons.
ZW, DW, DH = 2.6, 1.7, 1.1


def zone_polygons(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    x0 = (F.col("n_nationkey") % 5).cast("double") * ZW
    y0 = F.floor(F.col("n_nationkey") / 5).cast("double") * ZW
    return n.select(F.col("n_nationkey").alias("location_id"), geo.parse_wkt(_rect_wkt(x0, y0, ZW, ZW)).alias("rings"))


ZONE_RECT_SQL = f"""SELECT n_nationkey AS location_id, CAST(n_nationkey % 5 AS DOUBLE) * {ZW} AS x0,
  CAST(floor(n_nationkey / 5) AS DOUBLE) * {ZW} AS y0, {ZW} AS w, {ZW} AS h FROM nation"""


def district_polygons(spark, sf_dir):
    s = dealt_out(read(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    x0 = (F.col("s_suppkey") % 10).cast("double") * 1.3 + 0.1
    y0 = (F.floor(F.col("s_suppkey") / 10) % 10).cast("double") * 1.3 + 0.2
    return s.select(F.col("s_suppkey").alias("elect_dist"), geo.parse_wkt(_rect_wkt(x0, y0, DW, DH)).alias("rings"))


DIST_RECT_SQL = f"""SELECT s_suppkey AS elect_dist, CAST(s_suppkey % 10 AS DOUBLE) * 1.3 + 0.1 AS x0,
  CAST(floor(s_suppkey / 10) % 10 AS DOUBLE) * 1.3 + 0.2 AS y0, {DW} AS w, {DH} AS h FROM supplier"""

OVERLAP_SQL = """SELECT d.elect_dist, z.location_id AS taxi_zone_location_id,
  greatest(0, least(d.x0 + d.w, z.x0 + z.w) - greatest(d.x0, z.x0)) * greatest(0, least(d.y0 + d.h, z.y0 + z.h) - greatest(d.y0, z.y0))
    / (d.w * d.h) AS overlap
FROM dr d JOIN zr z ON d.x0 < z.x0 + z.w AND z.x0 < d.x0 + d.w AND d.y0 < z.y0 + z.h AND z.y0 < d.y0 + d.h"""


def district_zone_overlap(spark, sf_dir, min_fraction=0.001, strict=False):
    o = SP.overlap_fractions(district_polygons(spark, sf_dir), "elect_dist", zone_polygons(spark, sf_dir),
                             "location_id", min_fraction=min_fraction, strict=strict, cell=2.0)
    return o.select("elect_dist", F.col("location_id").alias("taxi_zone_location_id"), F.col("fraction").alias("overlap"))


@register("m48_district_zone_overlap", with_ctes(
    "SELECT elect_dist, taxi_zone_location_id, round(overlap, 9) AS overlap FROM ov WHERE overlap >= 0.001",
    dr=DIST_RECT_SQL, zr=ZONE_RECT_SQL, ov=OVERLAP_SQL))
def m48_district_zone_overlap(spark, sf_dir):
    """District -> zone overlap fractions, rows below 0.001 deleted."""
    return district_zone_overlap(spark, sf_dir).withColumn("overlap", F.round("overlap", 9))


@register("m10_tract_zone_mapping", with_ctes(
    "SELECT elect_dist AS tract_id, taxi_zone_location_id, round(overlap, 9) AS overlap FROM ov WHERE overlap > 0.5",
    dr=DIST_RECT_SQL, zr=ZONE_RECT_SQL, ov=OVERLAP_SQL))
def m10_tract_zone_mapping(spark, sf_dir):
    """Tract -> zone mapping, kept where the overlap is strictly above one half."""
    o = district_zone_overlap(spark, sf_dir, min_fraction=0.5, strict=True)
    return o.select(F.col("elect_dist").alias("tract_id"), "taxi_zone_location_id",
                    F.round("overlap", 9).alias("overlap"))


def results_by_zone(spark, sf_dir):
    """Area-weighted votes (F22) and candidate shares by zone."""
    v = votes_by_district(spark, sf_dir)
    m = district_zone_overlap(spark, sf_dir)
    z = zones(spark, sf_dir)
    vz = (v.join(m, v.election_district == m.elect_dist)
           .join(F.broadcast(z), F.col("taxi_zone_location_id") == z.location_id)
           .groupBy("location_id", "zone", "borough", "candidate")
           .agg(F.sum(F.col("votes") * F.col("overlap")).alias("estimated_votes")))
    ev = F.col("estimated_votes")
    aggs = [F.sum(ev).alias("_votes"), F.round(F.sum(ev)).cast("bigint").alias("estimated_total_votes")]
    for c in CANDIDATES:
        aggs.append(F.round(R.share(F.sum(F.when(F.col("candidate").like(f"{c}%"), ev)), F.sum(ev)), 9).alias(c))
    return vz.groupBy("location_id", "zone", "borough").agg(*aggs).filter(F.col("_votes") > 0).drop("_votes")


RBZ_SQL = f"""SELECT location_id, zone, borough, CAST(round(sum(estimated_votes)) AS BIGINT) AS estimated_total_votes,
  {", ".join(f"round(sum(CASE WHEN candidate LIKE '{c}%' THEN estimated_votes END) / nullif(sum(estimated_votes), 0), 9) AS {c}" for c in CANDIDATES)}
FROM (SELECT z.location_id, z.zone, z.borough, v.candidate, sum(v.votes * m.overlap) AS estimated_votes
      FROM vbd v JOIN (SELECT * FROM ov WHERE overlap >= 0.001) m ON v.election_district = m.elect_dist
      JOIN zones z ON m.taxi_zone_location_id = z.location_id
      GROUP BY ALL)
GROUP BY location_id, zone, borough HAVING sum(estimated_votes) > 0"""


@register("m48_results_by_zone", with_ctes(RBZ_SQL, vbd=VBD_SQL, dr=DIST_RECT_SQL, zr=ZONE_RECT_SQL,
                                           ov=OVERLAP_SQL, zones=ZONES_SQL))
def m48_results_by_zone(spark, sf_dir):
    return results_by_zone(spark, sf_dir)


@register("f22_votes_allocated_to_zones", with_ctes("""
SELECT m.taxi_zone_location_id, round(sum(v.votes * m.overlap), 6) AS votes
FROM (SELECT elect_dist, taxi_zone_location_id, overlap FROM ov WHERE overlap >= 0.001) m
JOIN (SELECT election_district AS elect_dist, sum(votes) AS votes FROM vbd GROUP BY 1) v USING (elect_dist)
GROUP BY 1""", vbd=VBD_SQL, dr=DIST_RECT_SQL, zr=ZONE_RECT_SQL, ov=OVERLAP_SQL))
def f22_votes_allocated_to_zones(spark, sf_dir):
    """all districts' votes allocated to zones by overlap."""
    v = votes_by_district(spark, sf_dir).groupBy(F.col("election_district").alias("elect_dist")).agg(F.sum("votes").alias("votes"))
    a = R.allocate(v, district_zone_overlap(spark, sf_dir), "elect_dist", "votes", "overlap", "taxi_zone_location_id")
    return a.withColumn("votes", F.round("votes", 6))


# Oracle of the fits, before rounding.
VOTE_REGRESSION_CTES = dict(trips=EV_TRIPS_SQL, bd=BRAND_DAILY_SQL, bs=BS_SQL, zones=ZONES_SQL, sc=SC_SQL, vbd=VBD_SQL, dr=DIST_RECT_SQL,
           zr=ZONE_RECT_SQL, ov=OVERLAP_SQL, rbz=RBZ_SQL)
VOTE_REGRESSION_SQL = f"""
WITH d AS (
  SELECT c.candidate, s.b_share_change AS y,
    CASE c.candidate {" ".join(f"WHEN '{c}' THEN r.{c}" for c in CANDIDATES[:2])} END AS x
  FROM rbz r JOIN sc s USING (location_id), (VALUES {", ".join(f"('{c}')" for c in CANDIDATES[:2])}) c(candidate)
  WHERE r.estimated_total_votes > {MIN_VOTES}),
m AS (SELECT *, avg(x) OVER p AS mx, avg(y) OVER p AS my, count(*) OVER p AS n FROM d WHERE x IS NOT NULL AND y IS NOT NULL
      WINDOW p AS (PARTITION BY candidate)),
q AS (SELECT candidate, any_value(n) AS n, any_value(mx) AS mx, any_value(my) AS my, sum((x - mx) ^ 2) AS sxx,
        sum((y - my) ^ 2) AS syy, sum((x - mx) * (y - my)) AS sxy FROM m GROUP BY candidate)
SELECT candidate, sxy / sxx AS slope, my - sxy / sxx * mx AS intercept, sxy ^ 2 / (sxx * syy) AS r2, n,
  sqrt((syy - sxy ^ 2 / sxx) / (n - 2)) AS residual_se, sqrt((syy - sxy ^ 2 / sxx) / (n - 2) / sxx) AS slope_se,
  sqrt((syy - sxy ^ 2 / sxx) / (n - 2) * (1.0 / n + mx ^ 2 / sxx)) AS intercept_se
FROM q"""


def vote_regressions(spark, sf_dir):
    """The brand's share change regressed on a candidate's vote share, one
    regression per candidate, over zones with enough votes."""
    r = results_by_zone(spark, sf_dir).filter(F.col("estimated_total_votes") > MIN_VOTES)
    s = share_change(spark, sf_dir, BOUND_MIN_PRE).select("location_id", "b_share_change")
    long = r.join(s, "location_id").unpivot(["b_share_change"], CANDIDATES[:2], "candidate", "share")
    return K.ols(long, "b_share_change", "share", ["candidate"])


_FIT = ["slope", "intercept", "r2", "residual_se", "slope_se", "intercept_se"]


@register("m55_share_vs_vote_regression", with_ctes(f"""
SELECT candidate, n, {", ".join(f"round({c}, 6) AS {c}" for c in _FIT)} FROM ({VOTE_REGRESSION_SQL})""", **VOTE_REGRESSION_CTES))
def m55_share_vs_vote_regression(spark, sf_dir):
    """Both regressions with their errors."""
    o = vote_regressions(spark, sf_dir)
    return o.select("candidate", F.col("n").cast("bigint").alias("n"), *[F.round(c, 6).alias(c) for c in _FIT])
