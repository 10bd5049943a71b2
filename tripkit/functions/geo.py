"""Planar geometry as Spark ``Column`` expressions (inventory group J).

Polygon column type (``RINGS``)::

    array<struct<hole: boolean, pts: array<struct<x: double, y: double>>>>

Each ring is closed (first point == last point). A POLYGON contributes one
outer ring and its holes; a MULTIPOLYGON contributes the rings of every part.
Point-in-polygon uses the even-odd rule over all rings, so holes and
disjoint parts need no special casing. Everything is built from Spark
higher-order functions (``aggregate``, ``transform``, ``filter``), so it runs
JVM-side inside whole-stage codegen — no Python in the row path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.StructType([T.StructField("hole", T.BooleanType()),
                     T.StructField("pts", T.ArrayType(POINT))])
RINGS = T.ArrayType(RING)


def point(x, y) -> Column:
    """make_point(x, y)."""
    return F.struct(col_of(x).cast("double").alias("x"), col_of(y).cast("double").alias("y"))


def px(p) -> Column:
    """ST_X."""
    return col_of(p).getField("x")


def py(p) -> Column:
    """ST_Y."""
    return col_of(p).getField("y")


def parse_wkt(c) -> Column:
    """POLYGON / MULTIPOLYGON WKT text -> RINGS.

    A ring opened by ``((`` starts a polygon part (outer ring); a ring opened
    by a single ``(`` is a hole of the current part.
    """
    w = F.regexp_replace(col_of(c), r"\s+", " ")
    opens = F.regexp_extract_all(w, F.lit(r"(\(+) ?[-0-9.eE]"), 1)
    bodies = F.regexp_extract_all(w, F.lit(r"\(+ ?([^()]+)\)"), 1)

    def ring(o, body):
        pts = F.transform(
            F.split(F.trim(body), r"\s*,\s*"),
            lambda s: F.struct(
                F.split(F.trim(s), " ").getItem(0).cast("double").alias("x"),
                F.split(F.trim(s), " ").getItem(1).cast("double").alias("y")))
        return F.struct((F.length(o) == 1).alias("hole"), pts.alias("pts"))

    return F.zip_with(opens, bodies, ring)


def _edge_sum(pts: Column, fn) -> Column:
    """Sum of fn(p_i, p_{i+1}) over the edges of a closed ring."""
    n = F.size(pts)
    return F.aggregate(
        F.sequence(F.lit(0), n - 2),
        F.lit(0.0),
        lambda acc, i: acc + fn(F.element_at(pts, i + 1), F.element_at(pts, i + 2)))


def ring_signed_area(pts) -> Column:
    """Shoelace signed area of one closed ring (CCW positive)."""
    return _edge_sum(col_of(pts), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]) / F.lit(2.0)


def area(rings) -> Column:
    """area = sum |outer| - sum |holes|."""
    return F.aggregate(
        col_of(rings), F.lit(0.0),
        lambda acc, r: acc + F.when(r["hole"], -F.abs(ring_signed_area(r["pts"])))
                              .otherwise(F.abs(ring_signed_area(r["pts"]))))


def _ring_moments(pts: Column):
    a = ring_signed_area(pts)
    mx = _edge_sum(pts, lambda p, q: (p["x"] + q["x"]) * (p["x"] * q["y"] - q["x"] * p["y"])) / F.lit(6.0)
    my = _edge_sum(pts, lambda p, q: (p["y"] + q["y"]) * (p["x"] * q["y"] - q["x"] * p["y"])) / F.lit(6.0)
    return a, mx, my


def moments(rings) -> Column:
    """Area and first moments of a polygon: struct<a, mx, my> (holes subtract)."""
    def step(acc, r):
        a, mx, my = _ring_moments(r["pts"])
        # orient: outer rings count positive, holes negative, whatever the stored winding
        s = F.when(r["hole"], F.lit(-1.0)).otherwise(F.lit(1.0)) * F.signum(a)
        return F.struct((acc["a"] + s * a).alias("a"), (acc["mx"] + s * mx).alias("mx"),
                        (acc["my"] + s * my).alias("my"))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(col_of(rings), zero, step)


def centroid(rings) -> Column:
    """Area centroid of a polygon / multipolygon -> struct<x, y>."""
    m = moments(rings)
    return F.struct((m["mx"] / m["a"]).alias("x"), (m["my"] / m["a"]).alias("y"))


def bbox(rings) -> Column:
    """Bounding box struct<minx, miny, maxx, maxy>."""
    xs = F.flatten(F.transform(col_of(rings), lambda r: F.transform(r["pts"], lambda p: p["x"])))
    ys = F.flatten(F.transform(col_of(rings), lambda r: F.transform(r["pts"], lambda p: p["y"])))
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def point_in(x, y, rings) -> Column:
    """Strict-interior point-in-polygon (even-odd ray cast; boundary -> false)."""
    X, Y = col_of(x).cast("double"), col_of(y).cast("double")

    def crossings(pts):
        n = F.size(pts)
        return F.aggregate(
            F.sequence(F.lit(0), n - 2), F.lit(0),
            lambda acc, i: acc + F.when(
                ((F.element_at(pts, i + 1)["y"] > Y) != (F.element_at(pts, i + 2)["y"] > Y))
                & (X < (F.element_at(pts, i + 2)["x"] - F.element_at(pts, i + 1)["x"])
                   * (Y - F.element_at(pts, i + 1)["y"])
                   / (F.element_at(pts, i + 2)["y"] - F.element_at(pts, i + 1)["y"])
                   + F.element_at(pts, i + 1)["x"]), F.lit(1)).otherwise(F.lit(0)))

    def on_edge(pts):
        n = F.size(pts)

        def seg(i):
            a = F.element_at(pts, i + 1)
            b = F.element_at(pts, i + 2)
            cross = (b["x"] - a["x"]) * (Y - a["y"]) - (b["y"] - a["y"]) * (X - a["x"])
            return ((cross == 0) & (X >= F.least(a["x"], b["x"])) & (X <= F.greatest(a["x"], b["x"]))
                    & (Y >= F.least(a["y"], b["y"])) & (Y <= F.greatest(a["y"], b["y"])))
        return F.exists(F.sequence(F.lit(0), n - 2), seg)

    total = F.aggregate(col_of(rings), F.lit(0), lambda acc, r: acc + crossings(r["pts"]))
    touches = F.exists(col_of(rings), lambda r: on_edge(r["pts"]))
    return ((total % 2) == 1) & ~touches


def clean_rings(rings) -> Column:
    """J11 (data-level part): drop repeated consecutive vertices, close open
    rings, orient outer rings counter-clockwise and holes clockwise."""
    def fix(r):
        pts = r["pts"]
        dedup = F.filter(pts, lambda p, i: (i == 0) | (p != F.element_at(pts, i)))
        closed = F.when(F.element_at(dedup, 1) == F.element_at(dedup, -1), dedup) \
                  .otherwise(F.concat(dedup, F.array(F.element_at(dedup, 1))))
        a = ring_signed_area(closed)
        want_ccw = ~r["hole"]
        flip = (want_ccw & (a < 0)) | (~want_ccw & (a > 0))
        return F.struct(r["hole"].alias("hole"),
                        F.when(flip, F.reverse(closed)).otherwise(closed).alias("pts"))
    return F.transform(col_of(rings), fix)


def rotate(x, y, degrees: float, ox, oy) -> Column:
    """Rotate (x, y) counter-clockwise by ``degrees`` about (ox, oy) -> struct<x, y>."""
    th = math.radians(degrees)
    c, s = math.cos(th), math.sin(th)
    dx, dy = col_of(x) - col_of(ox), col_of(y) - col_of(oy)
    return F.struct((col_of(ox) + dx * F.lit(c) - dy * F.lit(s)).alias("x"),
                    (col_of(oy) + dx * F.lit(s) + dy * F.lit(c)).alias("y"))


def distance(x1, y1, x2, y2) -> Column:
    """Straight-line distance."""
    return F.hypot(col_of(x2) - col_of(x1), col_of(y2) - col_of(y1))


def distance_crosstown(x1, x2) -> Column:
    """Distance along x only (to the point (x2, y1))."""
    return F.abs(col_of(x2) - col_of(x1))


def distance_uptown(y1, y2) -> Column:
    """Distance along y only (to the point (x1, y2))."""
    return F.abs(col_of(y2) - col_of(y1))


# ---------------------------------------------------------------------------
# Lambert conformal conic (2 standard parallels) on GRS 1980.
# The New York Long Island state-plane zone, US survey feet.
# ---------------------------------------------------------------------------
LCC_NY_LONG_ISLAND = dict(
    a=6378137.0, inv_f=298.257222101,
    lon0=-74.0, lat0=40.16666666666666,
    lat1=40.66666666666666, lat2=41.03333333333333,
    false_easting=984250.0, false_northing=0.0,
    unit=0.3048006096012192,  # metres per US survey foot
)


class _LCC:
    def __init__(self, a, inv_f, lon0, lat0, lat1, lat2, false_easting, false_northing, unit):
        f = 1.0 / inv_f
        self.e = math.sqrt(2 * f - f * f)
        self.a, self.unit = a, unit
        self.lon0 = math.radians(lon0)
        self.fe, self.fn = false_easting, false_northing
        e = self.e

        def m(phi):
            return math.cos(phi) / math.sqrt(1 - e * e * math.sin(phi) ** 2)

        def t(phi):
            return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

        p0, p1, p2 = map(math.radians, (lat0, lat1, lat2))
        self.n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
        self.F = m(p1) / (self.n * t(p1) ** self.n)
        self.rho0 = a * self.F * t(p0) ** self.n


_NY = _LCC(**LCC_NY_LONG_ISLAND)


def lcc_forward(lon, lat, p: _LCC = _NY) -> Column:
    """lon/lat degrees -> projected (x, y) in the projection's unit."""
    e = p.e
    phi = F.radians(col_of(lat))
    lam = F.radians(col_of(lon))
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    rho = F.lit(p.a * p.F) * F.pow(t, F.lit(p.n))
    theta = F.lit(p.n) * (lam - F.lit(p.lon0))
    x = rho * F.sin(theta) / F.lit(p.unit) + F.lit(p.fe)
    y = (F.lit(p.rho0) - rho * F.cos(theta)) / F.lit(p.unit) + F.lit(p.fn)
    return F.struct(x.alias("x"), y.alias("y"))


def lcc_inverse(x, y, p: _LCC = _NY, iterations: int = 5) -> Column:
    """Projected (x, y) -> lon/lat degrees; latitude by fixed-point iteration."""
    e = p.e
    xm = (col_of(x) - F.lit(p.fe)) * F.lit(p.unit)
    ym = (col_of(y) - F.lit(p.fn)) * F.lit(p.unit)
    dy = F.lit(p.rho0) - ym
    sgn = 1.0 if p.n > 0 else -1.0
    rho = F.lit(sgn) * F.sqrt(xm * xm + dy * dy)
    theta = F.atan2(F.lit(sgn) * xm, F.lit(sgn) * dy)
    t = F.pow(rho / F.lit(p.a * p.F), F.lit(1.0 / p.n))
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(iterations):
        es = F.lit(e) * F.sin(phi)
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2)))
    lam = theta / F.lit(p.n) + F.lit(p.lon0)
    return F.struct(F.degrees(lam).alias("x"), F.degrees(phi).alias("y"))


def grid_cell(c, cell_size: float) -> Column:
    """Integer grid cell index of a coordinate."""
    return F.floor(col_of(c) / F.lit(cell_size)).cast("bigint")


def wkt_rings_const(wkt: str) -> list[tuple[bool, list[tuple[float, float]]]]:
    """Vertices of a literal POLYGON/MULTIPOLYGON text known when the plan is
    built (a constant of the query, not data): [(is_hole, [(x, y), ...]), ...]."""
    import re
    rings = []
    for opens, body in re.findall(r"(\(+)\s*([^()]+)\)", wkt):
        pts = [tuple(float(v) for v in p.split()) for p in body.split(",")]
        rings.append((len(opens) == 1, pts))
    return rings


def point_in_const(x, y, wkt: str) -> Column:
    """J2 for a literal polygon: the even-odd ray cast unrolled into one
    arithmetic expression over the polygon's constant edges (no higher-order
    function, so it compiles inside whole-stage codegen). Boundary -> false."""
    X, Y = col_of(x).cast("double"), col_of(y).cast("double")
    crossings = None
    touches = None
    for _, pts in wkt_rings_const(wkt):
        for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
            c = F.when(((F.lit(y1) > Y) != (F.lit(y2) > Y))
                       & (X < F.lit(x2 - x1) * (Y - F.lit(y1)) / F.lit(y2 - y1) + F.lit(x1)), 1).otherwise(0) \
                if y1 != y2 else F.lit(0)
            crossings = c if crossings is None else crossings + c
            t = ((F.lit(x2 - x1) * (Y - F.lit(y1)) - F.lit(y2 - y1) * (X - F.lit(x1)) == 0)
                 & X.between(min(x1, x2), max(x1, x2)) & Y.between(min(y1, y2), max(y1, y2)))
            touches = t if touches is None else touches | t
    xs = [px_ for _, pts in wkt_rings_const(wkt) for px_, _ in pts]
    ys = [py_ for _, pts in wkt_rings_const(wkt) for _, py_ in pts]
    in_box = (X > F.lit(min(xs))) & (X < F.lit(max(xs))) & (Y > F.lit(min(ys))) & (Y < F.lit(max(ys)))
    # bounding box first: most points are decided by four comparisons
    return F.when(in_box, ((crossings % 2) == 1) & ~touches).otherwise(F.lit(False))


EDGE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])


def edges_of(rings) -> Column:
    """All edges of a polygon as array<struct<x1, y1, x2, y2>> (holes included)."""
    def ring_edges(r):
        pts = r["pts"]
        n = F.size(pts)
        return F.zip_with(F.slice(pts, 1, n - 1), F.slice(pts, 2, n - 1),
                          lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                                                b["x"].alias("x2"), b["y"].alias("y2")))
    return F.flatten(F.transform(col_of(rings), ring_edges))


def point_in_edges(x, y, edges, passed=0) -> Column:
    """J2 over an edge list: even-odd crossings of the rightward ray; a point on
    an edge is not inside. Exact for any edge list that contains every edge
    able to cross the ray or touch the point (see ``spatial_join``); ``passed``
    counts edges left out that every ray crosses."""
    X, Y = col_of(x).cast("double"), col_of(y).cast("double")

    def crosses(e):
        return F.when(((e["y1"] > Y) != (e["y2"] > Y))
                      & (X < (e["x2"] - e["x1"]) * (Y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]), 1).otherwise(0)

    def touches(e):
        cross = (e["x2"] - e["x1"]) * (Y - e["y1"]) - (e["y2"] - e["y1"]) * (X - e["x1"])
        return ((cross == 0) & (X >= F.least(e["x1"], e["x2"])) & (X <= F.greatest(e["x1"], e["x2"]))
                & (Y >= F.least(e["y1"], e["y2"])) & (Y <= F.greatest(e["y1"], e["y2"])))

    start = passed if isinstance(passed, Column) else F.lit(passed)
    total = F.aggregate(col_of(edges), start.cast("int"), lambda acc, e: acc + crosses(e))
    return ((total % 2) == 1) & ~F.exists(col_of(edges), touches)
