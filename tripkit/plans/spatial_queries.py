"""Geospatial analyses (J2-J15, M2/M4 zone back-fill, M11, M28, M29, M42, M69).

Points are events placed at (fare, k); polygons are literal WKT (the ad-hoc
shapes) or rectangles built from the nation rows. Vertex coordinates sit at
.005 offsets, so no data point falls on an edge or a vertex height (T19).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import geo
from ..functions import timeparts as tp
from ..operators import rollups as R
from ..operators import overlay as OV
from ..operators import spatial as SP
from ..session import dealt_out
from .bindings import EV_TRIPS_SQL, ZONES_SQL, ev_trips, read, with_ctes, zones
from .registry import register

# Ad-hoc polygons in the (fare, k) plane.
OFFICE_WKT = "POLYGON((100.005 10.005, 300.005 10.005, 300.005 60.005, 200.005 35.005, 100.005 60.005, 100.005 10.005))"
NORTH_WKT = "POLYGON((20.005 70.005, 80.005 70.005, 90.005 95.005, 10.005 90.005, 20.005 70.005))"
EAST_WKT = "POLYGON((350.005 5.005, 480.005 20.005, 450.005 80.005, 380.005 60.005, 350.005 5.005))"


def _edges_sql(wkt: str):
    pts = [tuple(map(float, p.strip().split())) for p in wkt[wkt.index("((") + 2: wkt.index("))")].split(",")]
    return ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(pts, pts[1:]))


def _inside_sql(wkt: str, x: str, y: str) -> str:
    """Even-odd ray cast in SQL over the polygon's edges (a correlated count)."""
    return (f"((SELECT count(*) FROM (VALUES {_edges_sql(wkt)}) e(x1, y1, x2, y2) "
            f"WHERE ((e.y1 > {y}) <> (e.y2 > {y})) AND ({x} < (e.x2 - e.x1) * ({y} - e.y1) / (e.y2 - e.y1) + e.x1)) % 2 = 1)")


@register("m28_office_dropoff_origins", with_ctes(f"""
SELECT z.zone, CAST(sum(n) AS BIGINT) AS trips
FROM (SELECT pickup_location_id, count(*) AS n FROM trips
      WHERE dayofweek(dropoff_datetime) BETWEEN 1 AND 5 AND hour(dropoff_datetime) BETWEEN 5 AND 8
        AND pickup_location_id IS NOT NULL AND {_inside_sql(OFFICE_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')}
      GROUP BY 1) a
JOIN zones z ON a.pickup_location_id = z.location_id
GROUP BY z.zone""", trips=EV_TRIPS_SQL, zones=ZONES_SQL))
def m28_office_dropoff_origins(spark, sf_dir):
    """Drop-offs inside a named (non-convex) polygon on weekday
    mornings, ranked by origin (constant polygon, F2, H2)."""
    t = ev_trips(spark, sf_dir).withColumn("y", F.col("k").cast("double"))
    inside = SP.within(t, OFFICE_WKT, "fare_amount", "y")
    inside = inside.filter(F.dayofweek("dropoff_datetime").between(2, 6)
                           & F.hour("dropoff_datetime").between(5, 8) & F.col("pickup_location_id").isNotNull())
    a = R.count_by(inside, ["pickup_location_id"], out="n")
    z = zones(spark, sf_dir)
    return (a.join(F.broadcast(z), a.pickup_location_id == z.location_id)
             .groupBy("zone").agg(F.sum("n").cast("bigint").alias("trips"))
             .orderBy(F.desc("trips")))


@register("m28_second_office_dropoffs", with_ctes(f"""
SELECT trip_id, pickup_location_id, dropoff_datetime FROM trips
WHERE dropoff_location_id % 2 = 1 AND {_inside_sql(NORTH_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')}""", trips=EV_TRIPS_SQL))
def m28_second_office_dropoffs(spark, sf_dir):
    """Drop-offs inside a second named polygon, first cut down by drop-off zone."""
    t = ev_trips(spark, sf_dir).filter(F.col("dropoff_location_id") % 2 == 1).withColumn("y", F.col("k").cast("double"))
    return SP.within(t, NORTH_WKT, "fare_amount", "y").select("trip_id", "pickup_location_id", "dropoff_datetime")


@register("m39_office_time_of_day", with_ctes(f"""
SELECT CAST(600 * floor(date_diff('second', date_trunc('day', dropoff_datetime), date_trunc('second', dropoff_datetime)) / 600) AS DOUBLE) AS bin, count(*) AS n
FROM trips WHERE dayofweek(dropoff_datetime) % 6 <> 0 AND {_inside_sql(OFFICE_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')}
GROUP BY 1""", trips=EV_TRIPS_SQL))
def m39_office_time_of_day(spark, sf_dir):
    """Weekday drop-offs inside the office polygon by 10-minute bins."""
    t = ev_trips(spark, sf_dir).filter(tp.dow0("dropoff_datetime").between(1, 5)).withColumn("y", F.col("k").cast("double"))
    t = SP.within(t, OFFICE_WKT, "fare_amount", "y").withColumn("sod", tp.second_of_day("dropoff_datetime"))
    return R.histogram(t, "sod", 600, out="n").withColumn("bin", F.col("bin").cast("double"))


@register("m29_two_polygon_flags", with_ctes(f"""
SELECT trip_id, {_inside_sql(NORTH_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')} AS north,
  {_inside_sql(EAST_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')} AS east
FROM trips
WHERE {_inside_sql(NORTH_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')} OR {_inside_sql(EAST_WKT, 'fare_amount', 'CAST(k AS DOUBLE)')}""",
                                            trips=EV_TRIPS_SQL))
def m29_two_polygon_flags(spark, sf_dir):
    """One boolean column per polygon; each polygon is a folded constant."""
    t = ev_trips(spark, sf_dir).withColumn("y", F.col("k").cast("double"))
    t = SP.within(t, NORTH_WKT, "fare_amount", "y", out="north")
    t = SP.within(t, EAST_WKT, "fare_amount", "y", out="east")
    return t.filter(F.col("north") | F.col("east")).select("trip_id", "north", "east")


# Fixed parameters: zone rectangles in the (fare, k) plane.
ZX, ZY, ZW, ZH = 100.0, 20.0, 90.0, 17.0


def zone_shapes(spark, sf_dir):
    """Zone polygons built from the nation rows as WKT, then parsed."""
    n = read(spark, sf_dir, "nation")
    x0 = (F.col("n_nationkey") % 5).cast("double") * ZX + 5.005
    y0 = F.floor(F.col("n_nationkey") / 5).cast("double") * ZY + 1.005
    s = lambda c: c.cast("string")
    x1, y1 = x0 + ZW, y0 + ZH
    wkt = F.concat(F.lit("POLYGON(("), s(x0), F.lit(" "), s(y0), F.lit(", "), s(x1), F.lit(" "), s(y0), F.lit(", "),
                   s(x1), F.lit(" "), s(y1), F.lit(", "), s(x0), F.lit(" "), s(y1), F.lit(", "), s(x0), F.lit(" "),
                   s(y0), F.lit("))"))
    return n.select(F.col("n_nationkey").alias("gid"), F.col("n_nationkey").alias("zone_location_id"),
                    geo.parse_wkt(wkt).alias("rings"))


ZONE_SHAPES_SQL = f"""SELECT n_nationkey AS gid, CAST(n_nationkey % 5 AS DOUBLE) * {ZX} + 5.005 AS x0,
  CAST(floor(n_nationkey / 5) AS DOUBLE) * {ZY} + 1.005 AS y0 FROM nation"""


@register("j3_spatial_join_backfill", with_ctes(f"""
SELECT car_type, s.gid AS polygon_zone, coalesce(supplied_zone, s.gid) AS pickup_zone, count(*) AS trips
FROM (SELECT car_type, fare_amount AS x, CAST(k AS DOUBLE) AS y,
        CASE WHEN car_type = 'error' THEN NULL ELSE pickup_location_id END AS supplied_zone FROM trips) p
LEFT JOIN zs s ON p.x > s.x0 AND p.x < s.x0 + {ZW} AND p.y > s.y0 AND p.y < s.y0 + {ZH}
GROUP BY ALL""", trips=EV_TRIPS_SQL, zs=ZONE_SHAPES_SQL))
def j3_spatial_join_backfill(spark, sf_dir):
    """Point-in-polygon left join on grid cells, then the
    supplied zone is back-filled from the polygon zone (C14)."""
    t = ev_trips(spark, sf_dir).select(
        "car_type", F.col("fare_amount").alias("x"), F.col("k").cast("double").alias("y"),
        F.when(F.col("car_type") == "error", None).otherwise(F.col("pickup_location_id")).alias("supplied_zone"))
    j = SP.spatial_join(t, zone_shapes(spark, sf_dir).select("gid", "rings"), "x", "y", cell=50.0, how="left")
    return R.count_by(j, ["car_type", F.col("gid").alias("polygon_zone"),
                          F.coalesce("supplied_zone", "gid").alias("pickup_zone")])


@register("m11_zone_area_centroid", with_ctes(f"""
SELECT gid, CAST(round({ZW} * {ZH}, 6) AS DOUBLE) AS area, round(x0 + {ZW} / 2, 6) AS cx, round(y0 + {ZH} / 2, 6) AS cy FROM zs""",
                                             zs=ZONE_SHAPES_SQL))
def m11_zone_area_centroid(spark, sf_dir):
    """Polygon area and centroid (shoelace moments)."""
    z = zone_shapes(spark, sf_dir)
    c = geo.centroid("rings")
    return z.select("gid", F.round(geo.area("rings"), 6).alias("area"), F.round(c["x"], 6).alias("cx"),
                    F.round(c["y"], 6).alias("cy"))


@register("m11_borough_centroid", with_ctes(f"""
SELECT z.borough, CAST(round(sum({ZW} * {ZH}), 6) AS DOUBLE) AS area,
  round(sum({ZW} * {ZH} * (s.x0 + {ZW} / 2)) / sum({ZW} * {ZH}), 6) AS x,
  round(sum({ZW} * {ZH} * (s.y0 + {ZH} / 2)) / sum({ZW} * {ZH}), 6) AS y,
  count(*) AS rings
FROM zs s JOIN zones z ON s.gid = z.location_id GROUP BY z.borough""", zs=ZONE_SHAPES_SQL, zones=ZONES_SQL))
def m11_borough_centroid(spark, sf_dir):
    """Centroid of each borough's union (area-weighted
    moments) and the dissolved multipolygon's ring count."""
    z = zone_shapes(spark, sf_dir)
    zn = zones(spark, sf_dir)
    j = z.join(F.broadcast(zn), z.gid == zn.location_id).select("borough", "rings")
    c = SP.group_centroid(j, ["borough"])
    d = SP.dissolve(j, ["borough"]).select("borough", F.size("rings").cast("bigint").alias("rings"))
    return c.join(d, "borough").select("borough", F.round("area", 6).alias("area"), F.round("x", 6).alias("x"),
                                       F.round("y", 6).alias("y"), "rings")


# ---------------------------------------------------------------------------
# Projected centroids, rotation, hub zones, pair distances
# ---------------------------------------------------------------------------
# Fixed parameters: zone rectangles in lon/lat around the projection's area.
LON0, LAT0, DLON, DLAT = -74.05, 40.60, 0.02, 0.03
ROTATION = 29.0
CORE = "AMERICA"


def lonlat_zones(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    lon0 = F.lit(LON0) + (F.col("n_nationkey") % 5).cast("double") * DLON
    lat0 = F.lit(LAT0) + F.floor(F.col("n_nationkey") / 5).cast("double") * DLAT
    corners = [(lon0, lat0), (lon0 + DLON, lat0), (lon0 + DLON, lat0 + DLAT), (lon0, lat0 + DLAT), (lon0, lat0)]
    ring = F.array(*[geo.point(x, y) for x, y in corners])
    return n.select(F.col("n_nationkey").alias("gid"), F.array(F.struct(F.lit(False).alias("hole"),
                                                                        ring.alias("pts"))).alias("rings"))


def rotated_zones(spark, sf_dir):
    """Projected zone centroids (J8 + J6), the core borough's centroid
    (centroid of the union: area-weighted, F21), centroids rotated 29 degrees
    about it (J9) and the hub flag (J13). The rotation origin is one
    struct-valued scalar subquery; ``ox``/``oy`` are kept as columns."""
    c = SP.transformed_centroids(lonlat_zones(spark, sf_dir), "gid", geo.lcc_forward)
    zn = zones(spark, sf_dir)
    z = c.join(F.broadcast(zn), c.gid == zn.location_id).drop("location_id")
    core = (z.filter(F.col("borough") == CORE)
             .agg(F.struct((F.sum(F.col("area") * F.col("x")) / F.sum("area")).alias("ox"),
                           (F.sum(F.col("area") * F.col("y")) / F.sum("area")).alias("oy")))
             .scalar())
    z = z.select("gid", "zone", "borough", "x", "y", core["ox"].alias("ox"), core["oy"].alias("oy"))
    r = geo.rotate("x", "y", ROTATION, "ox", "oy")
    z = z.select("gid", "zone", "borough", r["x"].alias("rotated_x"), r["y"].alias("rotated_y"), "ox", "oy")
    hub = (F.col("borough") == CORE) & ~F.col("zone").like("NATION_2%") & (F.col("rotated_y") <= F.col("oy") + 1000)
    return z.withColumn("is_hub", hub)


def _lcc_sql(lon: str, lat: str):
    p = geo._NY
    e = p.e
    phi = f"radians({lat})"
    es = f"({e!r} * sin({phi}))"
    t = f"(tan({math.pi / 4!r} - {phi} / 2) / pow((1 - {es}) / (1 + {es}), {e / 2!r}))"
    rho = f"({p.a * p.F!r} * pow({t}, {p.n!r}))"
    theta = f"({p.n!r} * (radians({lon}) - {p.lon0!r}))"
    return (f"({rho} * sin({theta}) / {p.unit!r} + {p.fe!r})",
            f"(({p.rho0!r} - {rho} * cos({theta})) / {p.unit!r} + {p.fn!r})")


def _rotated_sql():
    lon0 = f"({LON0} + CAST(n_nationkey % 5 AS DOUBLE) * {DLON})"
    lat0 = f"({LAT0} + CAST(floor(n_nationkey / 5) AS DOUBLE) * {DLAT})"
    corners = [(lon0, lat0), (f"({lon0} + {DLON})", lat0), (f"({lon0} + {DLON})", f"({lat0} + {DLAT})"),
               (lon0, f"({lat0} + {DLAT})")]
    cols = []
    for i, (lo, la) in enumerate(corners):
        x, y = _lcc_sql(lo, la)
        cols.append(f"{x} AS x{i}, {y} AS y{i}")
    proj = f"SELECT n_nationkey AS gid, {', '.join(cols)} FROM nation"
    terms = [(i, (i + 1) % 4) for i in range(4)]
    cross = lambda i, j: f"(x{i} * y{j} - x{j} * y{i})"
    a = " + ".join(cross(i, j) for i, j in terms)
    mx = " + ".join(f"(x{i} + x{j}) * {cross(i, j)}" for i, j in terms)
    my = " + ".join(f"(y{i} + y{j}) * {cross(i, j)}" for i, j in terms)
    cent = f"SELECT gid, ({a}) / 2 AS a, ({mx}) / 6 AS mx, ({my}) / 6 AS my FROM proj"
    th = math.radians(ROTATION)
    return {
        "proj": proj, "cent": cent,
        "zc": "SELECT c.gid, z.zone, z.borough, c.a, c.mx / c.a AS cx, c.my / c.a AS cy FROM cent c JOIN zones z ON c.gid = z.location_id",
        "core": f"SELECT sum(mx) / sum(a) AS ox, sum(my) / sum(a) AS oy FROM cent c JOIN zones z ON c.gid = z.location_id WHERE z.borough = '{CORE}'",
        "rot": (f"SELECT gid, zone, borough, ox + (cx - ox) * {math.cos(th)!r} - (cy - oy) * {math.sin(th)!r} AS rotated_x, "
                f"oy + (cx - ox) * {math.sin(th)!r} + (cy - oy) * {math.cos(th)!r} AS rotated_y, ox, oy FROM zc, core"),
    }


ROT = _rotated_sql()


@register("m42_rotated_zones", with_ctes(f"""
SELECT gid, zone, borough, round(rotated_x, 3) AS rotated_x, round(rotated_y, 3) AS rotated_y,
  (borough = '{CORE}' AND zone NOT LIKE 'NATION_2%' AND rotated_y <= oy + 1000) AS is_hub
FROM rot""", zones=ZONES_SQL, **ROT))
def m42_rotated_zones(spark, sf_dir):
    r = rotated_zones(spark, sf_dir)
    return r.select("gid", "zone", "borough", F.round("rotated_x", 3).alias("rotated_x"),
                    F.round("rotated_y", 3).alias("rotated_y"), "is_hub")


@register("m69_zone_pair_distances", with_ctes("""
SELECT a.gid AS from_id, b.gid AS to_id,
  round(sqrt((b.rotated_x - a.rotated_x) ** 2 + (b.rotated_y - a.rotated_y) ** 2), 3) AS distance,
  round(abs(b.rotated_x - a.rotated_x), 3) AS distance_crosstown,
  round(abs(b.rotated_y - a.rotated_y), 3) AS distance_uptown
FROM rot a JOIN rot b ON a.gid <> b.gid""", zones=ZONES_SQL, **ROT))
def m69_zone_pair_distances(spark, sf_dir):
    """Every ordered pair of distinct zones (a dimension:
    quadratic in the zone count by definition, not in the trip count)."""
    r = rotated_zones(spark, sf_dir)
    d = SP.pair_distances(r, "gid", "rotated_x", "rotated_y")
    return d.select("from_id", "to_id", *[F.round(c, 3).alias(c) for c in
                                          ["distance", "distance_crosstown", "distance_uptown"]])


@register("j8_projection_roundtrip", with_ctes("""
SELECT gid, round(x0, 3) AS x, round(y0, 3) AS y FROM proj""", **{k: ROT[k] for k in ("proj",)}))
def j8_projection_roundtrip(spark, sf_dir):
    """Forward projection of each zone's south-west corner (inverse checked in tests)."""
    z = lonlat_zones(spark, sf_dir)
    p = z.select("gid", F.element_at(F.element_at("rings", 1)["pts"], 1).alias("c"))
    f = geo.lcc_forward(F.col("c.x"), F.col("c.y"))
    return p.select("gid", F.round(f["x"], 3).alias("x"), F.round(f["y"], 3).alias("y"))


# An L with a square hole, in units of its own size: non-convex, not a rectangle.
_L_OUTER = [(0.0, 0.0), (0.9, 0.0), (0.9, 0.4), (0.4, 0.4), (0.4, 0.9), (0.0, 0.9)]
_L_HOLE = [(0.1, 0.1), (0.3, 0.1), (0.3, 0.3), (0.1, 0.3)]


def _l_shape(x0, y0, w, h):
    """WKT column of the L at (x0, y0), scaled to w x h."""
    def ring(pts):
        at = [F.concat((x0 + F.lit(dx) * w).cast("string"), F.lit(" "), (y0 + F.lit(dy) * h).cast("string")) for dx, dy in [*pts, pts[0]]]
        return F.concat(F.lit("("), F.concat_ws(", ", *at), F.lit(")"))
    return F.concat(F.lit("POLYGON("), ring(_L_OUTER), F.lit(", "), ring(_L_HOLE), F.lit(")"))


_L_EDGES_SQL = "(VALUES " + ", ".join(
    f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for pts in (_L_OUTER, _L_HOLE) for a, b in zip(pts, [*pts[1:], pts[0]])) + ") e(dx1, dy1, dx2, dy2)"


@register("j3_points_in_shapes_with_holes", with_ctes(f"""
WITH edges AS (
  SELECT n_nationkey AS gid, (n_nationkey % 5) * 100 + 5.005 + dx1 * 90 AS x1, floor(n_nationkey / 5) * 20 + 1.005 + dy1 * 17 AS y1,
    (n_nationkey % 5) * 100 + 5.005 + dx2 * 90 AS x2, floor(n_nationkey / 5) * 20 + 1.005 + dy2 * 17 AS y2
  FROM nation, {_L_EDGES_SQL}),
hits AS (
  SELECT t.trip_id, g.gid FROM trips t, edges g
  WHERE (g.y1 > t.k) <> (g.y2 > t.k) AND t.fare_amount < (g.x2 - g.x1) * (t.k - g.y1) / (g.y2 - g.y1) + g.x1
  GROUP BY t.trip_id, g.gid HAVING count(*) % 2 = 1)
SELECT gid, count(*) AS points, CAST(sum(trip_id) AS BIGINT) AS id_sum FROM hits GROUP BY gid""", trips=EV_TRIPS_SQL))
def j3_points_in_shapes_with_holes(spark, sf_dir):
    """Points in non-convex polygons with holes, by grid cells and local edges."""
    n = read(spark, sf_dir, "nation")
    x0 = (F.col("n_nationkey") % 5).cast("double") * 100 + 5.005
    y0 = F.floor(F.col("n_nationkey") / 5).cast("double") * 20 + 1.005
    shapes = n.select(F.col("n_nationkey").alias("gid"), geo.parse_wkt(_l_shape(x0, y0, F.lit(90.0), F.lit(17.0))).alias("rings"))
    t = ev_trips(spark, sf_dir).select("trip_id", "fare_amount", F.col("k").cast("double").alias("y"))
    j = SP.spatial_join(t, shapes, "fare_amount", "y", cell=10.0, how="inner")
    return j.groupBy("gid").agg(F.count(F.lit(1)).alias("points"), F.sum("trip_id").alias("id_sum"))


@register("j5_overlap_shapes_with_holes", """
SELECT s_suppkey AS district, round((0.9 * 0.4 + 0.4 * 0.5 - 0.2 * 0.2) * (1 + (s_suppkey % 7) * 0.2) ^ 2, 6) AS covered FROM supplier""")
def j5_overlap_shapes_with_holes(spark, sf_dir):
    """Overlaps of non-convex districts with holes and the zone grid they lie in: a
    district's overlaps add up to its own area."""
    from .market import zone_polygons
    s = dealt_out(read(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    x0 = (F.col("s_suppkey") % 9).cast("double") * 1.2 + 0.15
    y0 = (F.floor(F.col("s_suppkey") / 9) % 9).cast("double") * 1.2 + 0.15
    size = F.lit(1.0) + (F.col("s_suppkey") % 7) * F.lit(0.2)
    districts = s.select(F.col("s_suppkey").alias("district"), geo.parse_wkt(_l_shape(x0, y0, size, size)).alias("rings"))
    inter = SP.intersection_areas(districts, "district", zone_polygons(spark, sf_dir), "location_id", cell=2.0)
    return inter.groupBy("district").agg(F.round(F.sum("inter_area"), 6).alias("covered"))


@register("j7_dissolved_boundaries", """
WITH cells AS (SELECT n_regionkey AS region, n_nationkey % 5 AS c, n_nationkey // 5 AS r FROM nation),
sides AS (
  SELECT a.region, a.c, a.r, s.dc, s.dr FROM cells a, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(dc, dr)
  ANTI JOIN (SELECT region, c, r FROM cells) b ON b.region = a.region AND b.c = a.c + s.dc AND b.r = a.r + s.dr)
SELECT region, count(*) AS edges, round(count(*) * 2.6, 6) AS perimeter,
  round((SELECT count(*) FROM cells x WHERE x.region = sides.region) * 2.6 * 2.6, 6) AS area
FROM sides GROUP BY region""")
def j7_dissolved_boundaries(spark, sf_dir):
    """Zones dissolved into their regions with shared boundaries merged; length
    and area (J4) of the merged outline from its edges."""
    from .market import zone_polygons
    z = zone_polygons(spark, sf_dir)
    n = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    e = SP.dissolved_edges(z.join(n, z.location_id == n.n_nationkey), ["region"])
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    return e.groupBy("region").agg(F.count(F.lit(1)).alias("edges"), F.round(F.sum(length), 6).alias("perimeter"),
                                   F.round(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2, 6).alias("area"))


@register("j3_covering_join", with_ctes(f"""
SELECT s.gid, count(*) AS points, CAST(sum(trip_id) AS BIGINT) AS id_sum
FROM (SELECT trip_id, fare_amount AS x, CAST(k AS DOUBLE) AS y FROM trips) p
JOIN zs s ON p.x > s.x0 AND p.x < s.x0 + {ZW} AND p.y > s.y0 AND p.y < s.y0 + {ZH}
GROUP BY s.gid""", trips=EV_TRIPS_SQL, zs=ZONE_SHAPES_SQL))
def j3_covering_join(spark, sf_dir):
    """Points in polygons by a covering of adaptive depth: equality inside, rays at borders only."""
    t = ev_trips(spark, sf_dir).select("trip_id", F.col("fare_amount").alias("x"), F.col("k").cast("double").alias("y"))
    j = SP.covering_join(t, zone_shapes(spark, sf_dir).select("gid", "rings"), "x", "y", cell=50.0, how="inner", edges_per_cell=2)
    return j.groupBy("gid").agg(F.count(F.lit(1)).alias("points"), F.sum("trip_id").alias("id_sum"))


#: Broken polygons in the unit plane; their areas and rings after repair are worked out by hand in the oracle.
BROKEN = ["POLYGON((0 0, 4 4, 4 0, 0 4, 0 0))", "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0),(3 1, 6 1, 6 3, 3 3, 3 1))",
          "POLYGON((0 0, 4 0, 4 4, 9 9, 4 4, 9 9, 4 4, 0 4, -3 7, 0 4, 0 0))", "POLYGON((0 0, 6 0, 6 6, 0 6, 0 0),(1 1, 3 1, 3 3, 1 3, 1 1),(2 2, 4 2, 4 4, 2 4, 2 2))"]


@register("j11_make_valid", """
SELECT s_suppkey AS shape, round(b.area * (1 + s_suppkey % 7 * 0.25) ^ 2, 6) AS area, b.rings, b.holes
FROM supplier JOIN (VALUES (0, 8.0, 2, 0), (1, 14.0, 1, 0), (2, 16.0, 1, 0), (3, 29.0, 2, 1)) b(kind, area, rings, holes) ON s_suppkey % 4 = b.kind""")
def j11_make_valid(spark, sf_dir):
    """Bow-ties, holes over the border, repeated spikes and overlapping holes, repaired."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("shape"))
    size, x0, y0 = 1 + F.col("shape") % 7 * 0.25, (F.col("shape") % 19).cast("double") * 8, (F.col("shape") % 23).cast("double") * 5
    kinds = F.array(*[geo.parse_wkt(F.lit(w)) for w in BROKEN])
    rings = F.transform(F.element_at(kinds, (F.col("shape") % len(BROKEN) + 1).cast("int")), lambda r: F.struct(
        r["hole"].alias("hole"), F.transform(r["pts"], lambda p: F.struct((x0 + p["x"] * size).alias("x"), (y0 + p["y"] * size).alias("y"))).alias("pts")))
    v = OV.make_valid(s.select("shape", rings.alias("rings")), ["shape"])
    return v.select("shape", F.round(geo.area("rings"), 6).alias("area"), F.size("rings").alias("rings"), F.size(F.filter("rings", lambda r: r["hole"])).alias("holes"))


@register("j7_union_of_overlapping_parts", """
WITH unit AS (
  SELECT DISTINCT s_nationkey AS nation, x, y FROM (
    SELECT s_nationkey, unnest(range(s_suppkey * 7 % 30, s_suppkey * 7 % 30 + 1 + s_suppkey % 5)) AS x, s_suppkey FROM supplier),
    LATERAL (SELECT unnest(range(s_suppkey * 11 % 20, s_suppkey * 11 % 20 + 1 + s_suppkey % 3)) AS y))
SELECT nation, CAST(count(*) AS DOUBLE) AS area, round(avg(x + 0.5), 6) AS cx, round(avg(y + 0.5), 6) AS cy, true AS closed FROM unit GROUP BY nation""")
def j7_union_of_overlapping_parts(spark, sf_dir):
    """Overlapping rectangles united into closed rings; area and centroid of the rings."""
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x0, y0, x1, y1 = k * 7 % 30, k * 11 % 20, k * 7 % 30 + 1 + k % 5, k * 11 % 20 + 1 + k % 3
    pts = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    parts = s.select(F.col("s_nationkey").alias("nation"), k.alias("part"), F.array(F.struct(F.lit(False).alias("hole"), pts.alias("pts"))).alias("rings"))
    r = OV.union_rings(parts, ["nation"], "part").select("nation", geo.moments(F.array(F.struct("hole", "pts"))).alias("m"), (F.element_at("pts", 1) == F.element_at("pts", -1)).alias("closed"))
    return r.groupBy("nation").agg(F.round(F.sum("m.a"), 6).alias("area"), F.round(F.sum("m.mx") / F.sum("m.a"), 6).alias("cx"),
                                   F.round(F.sum("m.my") / F.sum("m.a"), 6).alias("cy"), F.bool_and("closed").alias("closed"))
