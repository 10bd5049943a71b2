"""Spatial joins and polygon aggregates (inventory groups E7, E8, E10, J3, J5-J7).

Point-in-polygon join (J3): each polygon is registered in every grid cell
its bounding box covers, with only the edges that matter inside that cell;
points carry their own cell; the join is an equi-join on the cell followed
by the exact ray cast (over the cell's edges) as a join condition.
The polygon-cell side is a dimension (bounded by polygons x cells); the
point side is the fact. A dense cell is a skewed join key, which AQE's
skew-join splitting handles (sort-merge left/inner joins).

``covering_join`` answers the same with a covering of adaptive depth: grid cells
with many edges are cut into finer cells, cells without an edge are marked inside
or left out, and only points of the remaining border cells are ray-cast.

Polygon overlap (J5): every ring is clipped to each grid cell it touches
and fan-triangulated inside the cell (signed triangles); triangles meet only
triangles of the same cell (equi-join on the cell plus a bounding-box test),
each pair's convex intersection area is computed in Arrow batches with numpy
(``mapInPandas``), then summed per polygon pair with the triangles' signs:
area(A n B) = sum_ij s_i s_j area(T_i n T_j), exact for simple polygons with
holes oriented opposite to their shell.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..functions._util import col_of
from ..session import cut_lineage, dealt_out

# The Arrow-batch functions below run in Python workers. Serialise this module
# by value, so executors need numpy/pandas but not this package on their path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


def polygon_cells(polys: DataFrame, rings: str, cell: float) -> DataFrame:
    """Explode each polygon into the grid cells covered by its bounding box."""
    bb = geo.bbox(rings)
    return (polys.withColumn("_bb", bb)
                 .withColumn("_cx", F.explode(F.sequence(geo.grid_cell(F.col("_bb.minx"), cell),
                                                         geo.grid_cell(F.col("_bb.maxx"), cell))))
                 .withColumn("_cy", F.explode(F.sequence(geo.grid_cell(F.col("_bb.miny"), cell),
                                                         geo.grid_cell(F.col("_bb.maxy"), cell)))))


def spatial_join(points: DataFrame, polygons: DataFrame, x: str, y: str, rings: str = "rings",
                 cell: float = 0.01, how: str = "left", keep: Sequence[str] | None = None) -> DataFrame:
    """Points x polygons where the point lies strictly inside.

    ``how='left'`` keeps unmatched points with null polygon columns. A point
    inside k overlapping polygons yields k rows.
    """
    keep = list(keep) if keep is not None else [c for c in polygons.columns if c != rings]
    cells = polygon_cells(polygons.select(*keep, rings), rings, cell)
    # Per (polygon, cell): keep only the edges a point of this cell can need --
    # edges overlapping the cell's y-band that reach the cell's left side or
    # beyond (an edge wholly to the left cannot cross a rightward ray). Done
    # once on the polygon side; the per-point test then scans few edges.
    eps = cell * 1e-9
    lo_y = F.col("_cy").cast("double") * F.lit(cell) - F.lit(eps)
    hi_y = (F.col("_cy") + 1).cast("double") * F.lit(cell) + F.lit(eps)
    lo_x = F.col("_cx").cast("double") * F.lit(cell) - F.lit(eps)
    local = F.filter(geo.edges_of(F.col(rings)),
                     lambda e: (F.greatest(e["y1"], e["y2"]) >= lo_y) & (F.least(e["y1"], e["y2"]) <= hi_y)
                     & (F.greatest(e["x1"], e["x2"]) >= lo_x))
    cells = cells.select(*[F.col(c) for c in keep], local.alias("_edges"), "_cx", "_cy", "_bb")
    p = (points.withColumn("_px", geo.grid_cell(F.col(x), cell))
               .withColumn("_py", geo.grid_cell(F.col(y), cell)))
    cond = ((F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy"))
            & (F.col(x) > F.col("_bb.minx")) & (F.col(x) < F.col("_bb.maxx"))
            & (F.col(y) > F.col("_bb.miny")) & (F.col(y) < F.col("_bb.maxy"))
            & geo.point_in_edges(F.col(x), F.col(y), F.col("_edges")))
    return p.join(cells, cond, how).drop("_px", "_py", "_cx", "_cy", "_bb", "_edges")


#: Edges (of all polygons) aimed at in one cell of a covering, and the finest depth below a grid cell.
EDGES_PER_CELL, MAX_DEPTH = 8, 6


def _in_box(e, x0, y0, x1, y1):
    """Whether an edge may touch a closed box: their extents meet and the box has corners on both sides of its line."""
    corner = lambda x, y: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    corners = [corner(x, y) for x in (x0, x1) for y in (y0, y1)]
    return ((F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["y1"], e["y2"]) >= y0)
            & (F.least(e["y1"], e["y2"]) <= y1) & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0))


def covering(polygons: DataFrame, rings: str = "rings", cell: float = 0.01, edges_per_cell: int = EDGES_PER_CELL,
             max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """Cells of adaptive depth over polygons: (grid cells with their depth, finest cells).

    The depth of a grid cell follows the edges of all polygons in it (each halving of its side halves the
    edges a part holds). Each polygon has a row in every finest cell it touches: ``_inside`` where the cell holds
    no edge of it, else the edges a ray from there can meet; edges that every ray of the cell
    crosses are only counted (``_passed``). Both tables grow with the polygons, not with the points.
    """
    keep = [c for c in polygons.columns if c != rings]
    cells = polygon_cells(polygons.select(*keep, rings), rings, cell).withColumn("_e", geo.edges_of(F.col(rings))).drop("_bb", rings)

    def cut(df, cx, cy, size):
        """Sort each cell's edges: those that touch it, those its rays may meet, those every ray crosses."""
        room = size * 1e-9
        x0, y0 = F.col(cx) * size - room, F.col(cy) * size - room
        x1, y1 = (F.col(cx) + 1) * size + room, (F.col(cy) + 1) * size + room
        beyond = lambda e: (F.least(e["x1"], e["x2"]) > x1) & (F.least(e["y1"], e["y2"]) < y0) & (F.greatest(e["y1"], e["y2"]) > y1)
        reach = lambda e: (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["x1"], e["x2"]) >= x0)
        return (df.withColumn("_passed", F.col("_passed") + F.size(F.filter("_e", beyond)))
                .withColumn("_e", F.filter("_e", lambda e: reach(e) & ~beyond(e)))
                .withColumn("_touch", F.size(F.filter("_e", lambda e: _in_box(e, x0, y0, x1, y1)))))

    top = cut_lineage(cut(cells.withColumn("_passed", F.lit(0)), "_cx", "_cy", F.lit(float(cell))))
    depth = F.ceil(F.log2(F.greatest(F.sum("_touch") / F.lit(float(edges_per_cell)), F.lit(1.0)))).cast("int")
    grid = top.groupBy("_cx", "_cy").agg(F.least(depth, F.lit(max_depth)).alias("_depth"))
    leaf = top.join(grid, ["_cx", "_cy"])
    parts = F.pow(F.lit(2), F.col("_depth")).cast("long")
    leaf = leaf.withColumn("_at", F.explode(F.sequence(F.lit(0), parts * parts - 1)))
    leaf = leaf.withColumn("_lx", F.col("_cx") * parts + F.col("_at") % parts).withColumn("_ly", F.col("_cy") * parts + F.floor(F.col("_at") / parts))
    size = F.lit(float(cell)) / parts
    leaf = cut(leaf, "_lx", "_ly", size)
    middle = geo.point_in_edges((F.col("_lx") + 0.5) * size, (F.col("_ly") + 0.5) * size, F.col("_e"), F.col("_passed"))
    leaf = leaf.withColumn("_inside", F.when(F.col("_touch") == 0, middle)).where(F.coalesce(F.col("_inside"), F.lit(True)))
    edges = F.when(F.col("_inside").isNull(), F.col("_e"))
    return grid, leaf.select(*keep, "_cx", "_cy", "_lx", "_ly", F.col("_inside").isNotNull().alias("_inside"), edges.alias("_edges"), "_passed")


def covering_join(points: DataFrame, polygons: DataFrame, x: str, y: str, rings: str = "rings", cell: float = 0.01, how: str = "left",
                  edges_per_cell: int = EDGES_PER_CELL, max_depth: int = MAX_DEPTH, cast_flag: str | None = None) -> DataFrame:
    """``spatial_join`` over a covering of adaptive depth. Points of cells that lie inside a polygon
    are joined by equality alone, only those of border cells are ray-cast (``cast_flag`` names
    a column that tells which). Points look up the depth of their grid cell first.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    keep = [c for c in polygons.columns if c != rings]
    grid, leaf = covering(polygons, rings, cell, edges_per_cell, max_depth)
    grid, leaf = cut_lineage(grid), cut_lineage(leaf)
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    p = points.withColumn("_px", geo.grid_cell(X, cell)).withColumn("_py", geo.grid_cell(Y, cell))
    g = grid.select(F.col("_cx").alias("_gx"), F.col("_cy").alias("_gy"), "_depth")
    p = p.join(g, (F.col("_px") == F.col("_gx")) & (F.col("_py") == F.col("_gy")), how).drop("_gx", "_gy")
    parts = F.pow(F.lit(2), F.col("_depth")).cast("long")

    def mine(c, at):
        return F.least(F.greatest(F.floor(c * parts / F.lit(float(cell))), F.col(at) * parts), F.col(at) * parts + parts - 1)

    p = p.withColumn("_kx", mine(X, "_px")).withColumn("_ky", mine(Y, "_py"))
    same = (F.col("_kx") == F.col("_lx")) & (F.col("_ky") == F.col("_ly")) & (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy"))
    out = p.join(leaf, same & (F.col("_inside") | geo.point_in_edges(X, Y, F.col("_edges"), F.col("_passed"))), how)
    flag = [] if cast_flag is None else [(~F.col("_inside")).alias(cast_flag)]
    return out.select(*points.columns, *keep, *flag)


def within(points: DataFrame, rings, x: str, y: str, out: str | None = None) -> DataFrame:
    """J2 scalar form: filter (``out=None``) or flag points strictly inside one polygon.

    ``rings`` is either WKT text of a literal polygon (the ray cast is then
    unrolled over its constant edges and compiled by whole-stage codegen) or
    a polygon Column that does not depend on the row. No join either way.
    """
    inside = (geo.point_in_const(F.col(x), F.col(y), rings) if isinstance(rings, str)
              else geo.point_in(F.col(x), F.col(y), col_of(rings)))
    if out is None:
        return points.filter(inside)
    return points.withColumn(out, inside)


# ---------------------------------------------------------------------------
# Polygon overlap
# ---------------------------------------------------------------------------

#: Vertices that one pass of the numpy code below holds at a time.
VERTICES_A_PASS = 500_000


def _flat_clip(P: np.ndarray, seg: np.ndarray, s: np.ndarray, axis: int | None = None, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sutherland-Hodgman clip of many rings at once to a half-plane each, where ``s >= 0``.

    Rings lie one after the other in ``P`` (open vertex arrays), ``seg`` numbers them in rising order. Inside
    its half-plane a clipped ring has the original winding number (it may gain zero-area segments along
    the border, which carry no area). With ``axis`` new vertices get the coordinate ``bound`` exactly."""
    if not len(P):
        return P, seg
    inside = s >= 0
    if inside.all():
        return P, seg
    first = np.r_[True, seg[1:] != seg[:-1]]
    prev = np.arange(-1, len(P) - 1)
    prev[first] = np.r_[np.flatnonzero(first)[1:], len(P)] - 1
    cross = inside != inside[prev]
    t = s[prev] / np.where(cross, s[prev] - s, 1.0)
    q = P[prev] + t[:, None] * (P - P[prev])
    if axis is not None:
        q[:, axis] = bound
    keep = np.stack([cross, inside], axis=1).reshape(-1)
    return np.stack([q, P], axis=1).reshape(-1, 2)[keep], np.repeat(seg, 2)[keep]


def _clip_areas(S: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Area of (convex CCW triangle S_i) n (convex CCW triangle C_i), vectorised."""
    area, step = np.zeros(len(S)), VERTICES_A_PASS // 6
    for lo in range(0, len(S), step):
        n = len(S[lo:lo + step])
        poly, seg = S[lo:lo + step].reshape(-1, 2), np.repeat(np.arange(n), 3)
        for e in range(3):
            a, b = C[lo + seg, e], C[lo + seg, (e + 1) % 3]
            poly, seg = _flat_clip(poly, seg, (b[:, 0] - a[:, 0]) * (poly[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (poly[:, 0] - a[:, 0]))
        if len(poly):
            first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            after = np.arange(1, len(poly) + 1)
            after[np.r_[first[1:], len(seg)] - 1] = first
            nxt = poly[after]
            area[lo:lo + n] = 0.5 * np.bincount(seg, poly[:, 0] * nxt[:, 1] - nxt[:, 0] * poly[:, 1], minlength=n)
    return area


def _pair_area_batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        S = np.stack([pdf[["a_x0", "a_y0"]].to_numpy(), pdf[["a_x1", "a_y1"]].to_numpy(),
                      pdf[["a_x2", "a_y2"]].to_numpy()], axis=1).astype(float)
        C = np.stack([pdf[["b_x0", "b_y0"]].to_numpy(), pdf[["b_x1", "b_y1"]].to_numpy(),
                      pdf[["b_x2", "b_y2"]].to_numpy()], axis=1).astype(float)
        area = _clip_areas(S, C) if len(pdf) else np.zeros(0)
        yield pd.DataFrame({"a_id": pdf["a_id"], "b_id": pdf["b_id"],
                            "inter": area * pdf["a_w"].to_numpy() * pdf["b_w"].to_numpy()})


def _starts(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


def _bands(P: np.ndarray, seg: np.ndarray, axis: int, cell: float):
    """(P, seg, row): each ring clipped to every band of the grid that it touches along ``axis``; ``row`` names the
    ring of a piece and its band. Bands come in passes of VERTICES_A_PASS vertices, one piece at least."""
    if not len(P):
        return
    first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    size = np.diff(np.r_[first, len(seg)])
    lo = np.floor(np.minimum.reduceat(P[:, axis], first) / cell).astype(np.int64)
    many = np.floor(np.maximum.reduceat(P[:, axis], first) / cell).astype(np.int64) + 1 - lo
    ring = np.repeat(np.arange(len(first)), many)  # a piece each from here
    band = np.repeat(lo - _starts(many), many) + np.arange(len(ring))
    at = np.cumsum(size[ring])
    for k in np.split(np.arange(len(ring)), np.flatnonzero(np.diff(at // VERTICES_A_PASS)) + 1):
        n = size[ring[k]]
        piece = np.repeat(np.arange(len(k)), n)
        Q = P[np.repeat(first[ring[k]] - _starts(n), n) + np.arange(len(piece))]
        bound = band[k][piece] * cell
        Q, piece = _flat_clip(Q, piece, Q[:, axis] - bound, axis, bound)
        bound = (band[k][piece] + 1) * cell
        Q, piece = _flat_clip(Q, piece, bound - Q[:, axis], axis, bound)
        whole = (np.bincount(piece, minlength=len(k)) >= 3)[piece]
        Q, piece = Q[whole], piece[whole]
        if len(Q):
            yield Q, piece, np.stack([seg[first[ring[k]]], band[k]], axis=1)


def _ring_triangles(P: np.ndarray, seg: np.ndarray, cell: float):
    """(ring, cx, cy, w, corners) of rings clipped to each cell they touch: columns first, then rows of a column."""
    for strip, piece, col in _bands(P, seg, 0, cell):
        for q, part, row in _bands(strip, piece, 1, cell):
            ends = np.r_[part[1:] != part[:-1], True]
            first = np.flatnonzero(np.r_[True, ends[:-1]])
            start = np.repeat(first, np.diff(np.r_[first, len(q)]))
            i = np.flatnonzero(~ends & (np.arange(len(q)) > start))
            o, b, c = q[start[i]], q[i], q[i + 1]
            cr = (b[:, 0] - o[:, 0]) * (c[:, 1] - o[:, 1]) - (b[:, 1] - o[:, 1]) * (c[:, 0] - o[:, 0])
            i, o, b, c, cr = (v[cr != 0] for v in (i, o, b, c, cr))
            if len(cr):
                turn, of = (cr > 0)[:, None], row[part[i]]
                yield col[of[:, 0], 0], col[of[:, 0], 1], of[:, 1], np.sign(cr), np.hstack([o, np.where(turn, b, c), np.where(turn, c, b)])


def _cell_triangles(cell: float):
    names = ["x0", "y0", "x1", "y1", "x2", "y2"]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            pdf = pdf[[v is not None and len(v) > 3 for v in pdf["xs"]]]
            if not len(pdf):
                continue
            n = pdf["xs"].map(len).to_numpy() - 1  # without the closing vertex
            flat = [np.concatenate([np.asarray(v, float)[:-1] for v in pdf[c]]) for c in ("xs", "ys")]
            for ring, cx, cy, w, corners in _ring_triangles(np.column_stack(flat), np.repeat(np.arange(len(n)), n), cell):
                out = pd.DataFrame(corners, columns=names)
                out.insert(0, "w", w)
                out.insert(0, "cy", cy)
                out.insert(0, "cx", cx)
                out.insert(0, "id", pdf["id"].to_numpy()[ring])
                yield out
    return run


def cell_triangles(polys: DataFrame, id_col: str, rings: str, cell: float) -> DataFrame:
    """Each ring clipped to every grid cell it touches, then fan-triangulated
    inside the cell: (id, cx, cy, w, triangle). Triangles of one cell lie inside
    that cell, so they only ever meet the other polygon's triangles of the same
    cell. Rings are oriented first (outer CCW, holes CW), so the signed triangles
    sum to the polygon's winding number. A ring travels once, not once a cell. Rings are dealt out
    first: a table of polygons is small as a file, and the work on each is not (no filter here, as
    Spark would move it, and with it the parsing, before the dealing)."""
    r = dealt_out(polys.select(col_of(id_col).alias("id"), F.posexplode_outer(rings).alias("_n", "_r")), "id", "_n")
    r = r.select("id", geo.clean_rings(F.array("_r"))[0].alias("_r"))
    r = r.select("id", F.transform("_r.pts", lambda p: p["x"]).alias("xs"),
                 F.transform("_r.pts", lambda p: p["y"]).alias("ys"))
    schema = T.StructType([T.StructField("id", polys.select(col_of(id_col)).schema[0].dataType),
                           T.StructField("cx", T.LongType()), T.StructField("cy", T.LongType()),
                           *[T.StructField(n, T.DoubleType()) for n in ("w", "x0", "y0", "x1", "y1", "x2", "y2")]])
    return r.mapInPandas(_cell_triangles(cell), schema)


def intersection_areas(a: DataFrame, a_id: str, b: DataFrame, b_id: str,
                       rings: str = "rings", cell: float = 1.0) -> DataFrame:
    """area(A n B) for every intersecting pair (a_id, b_id, inter_area).

    Both sides are cut into per-cell signed triangles (``cell_triangles``);
    triangles meet only within their cell (equi-join on the cell, then a
    bounding-box test), so the number of triangle pairs grows with the local
    vertex counts per cell, not with the product of whole-polygon sizes.
    """
    def side(df, idc, p):
        t = cell_triangles(df, idc, rings, cell)
        t = t.select("*", F.least("x0", "x1", "x2").alias("minx"), F.greatest("x0", "x1", "x2").alias("maxx"),
                     F.least("y0", "y1", "y2").alias("miny"), F.greatest("y0", "y1", "y2").alias("maxy"))
        return t.select(*[F.col(c).alias(f"{p}{c}") for c in t.columns])
    ta, tb = side(a, a_id, "a_"), side(b, b_id, "b_")
    cond = ((F.col("a_cx") == F.col("b_cx")) & (F.col("a_cy") == F.col("b_cy"))
            & (F.col("a_minx") < F.col("b_maxx")) & (F.col("b_minx") < F.col("a_maxx"))
            & (F.col("a_miny") < F.col("b_maxy")) & (F.col("b_miny") < F.col("a_maxy")))
    pairs = ta.join(tb, cond, "inner").select(
        "a_id", "b_id", "a_w", "b_w", "a_x0", "a_y0", "a_x1", "a_y1", "a_x2", "a_y2",
        "b_x0", "b_y0", "b_x1", "b_y1", "b_x2", "b_y2")
    schema = T.StructType([T.StructField("a_id", a.select(col_of(a_id)).schema[0].dataType),
                           T.StructField("b_id", b.select(col_of(b_id)).schema[0].dataType),
                           T.StructField("inter", T.DoubleType())])
    areas = pairs.mapInPandas(_pair_area_batches, schema)
    return (areas.groupBy("a_id", "b_id").agg(F.sum("inter").alias("inter_area"))
                 .filter(F.col("inter_area") > 0)
                 .withColumnRenamed("a_id", a_id).withColumnRenamed("b_id", b_id))


def overlap_fractions(a: DataFrame, a_id: str, b: DataFrame, b_id: str, rings: str = "rings",
                      min_fraction: float | None = None, strict: bool = True,
                      cell: float = 1.0) -> DataFrame:
    """area(a n b) / area(a) for intersecting pairs, optionally thresholded.

    ``strict=True`` keeps ``fraction > min_fraction`` (tract->zone map, 0.5);
    ``strict=False`` keeps ``fraction >= min_fraction`` (district overlaps keep
    rows not deleted by ``< 0.001``).
    """
    inter = intersection_areas(a, a_id, b, b_id, rings, cell)
    area_a = a.select(col_of(a_id).alias(a_id), geo.area(rings).alias("area_a"))
    out = (inter.join(area_a, a_id)
                .withColumn("fraction", F.col("inter_area") / F.col("area_a")))
    if min_fraction is not None:
        out = out.filter(F.col("fraction") > min_fraction if strict else F.col("fraction") >= min_fraction)
    return out


def group_centroid(df: DataFrame, keys: Sequence[str], rings: str = "rings") -> DataFrame:
    """Centroid of the union of a group's (non-overlapping) parts,
    as the area-weighted mean of part centroids (sum of first moments). Overlaps would count
    twice: ``overlay.union_areas`` counts them once."""
    m = df.select(*keys, geo.moments(rings).alias("_m"))
    return (m.groupBy(*keys).agg(F.sum("_m.a").alias("area"), F.sum("_m.mx").alias("_mx"),
                                 F.sum("_m.my").alias("_my"))
             .select(*keys, "area", (F.col("_mx") / F.col("area")).alias("x"),
                     (F.col("_my") / F.col("area")).alias("y")))


def dissolve(df: DataFrame, keys: Sequence[str], rings: str = "rings") -> DataFrame:
    """Union of a group's polygons as one multipolygon (rings concatenated).

    Valid for non-overlapping parts; shared boundaries are not merged (``overlay.union_rings``
    does both, a row a ring). The group is a dimension group (tracts of one neighbourhood), bounded.
    """
    return df.groupBy(*keys).agg(F.flatten(F.collect_list(rings)).alias(rings))


def dissolved_edges(df: DataFrame, keys: Sequence[str], rings: str = "rings", digits: int = 9) -> DataFrame:
    """The boundary of the union of a group's non-overlapping parts, as directed
    edges (keys, x1, y1, x2, y2): edges that two parts share run in opposite directions and
    cancel. Coordinates are snapped to ``digits`` decimals. One aggregate over edges, so no
    group is gathered; areas follow from the edges."""
    r = df.select(*keys, F.explode(geo.clean_rings(F.col(rings))).alias("_r"))
    e = r.select(*keys, F.explode(geo.edges_of(F.array("_r"))).alias("_e"))
    e = e.select(*keys, *[F.round(F.col("_e")[c], digits).alias(c) for c in ("x1", "y1", "x2", "y2")])
    a, b = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2))
    net = (e.withColumn("_d", F.when(a < b, 1).otherwise(-1)).select(*keys, F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b"), "_d")
            .filter(F.col("_a") != F.col("_b")).groupBy(*keys, "_a", "_b").agg(F.sum("_d").alias("_d")).filter(F.col("_d") != 0))
    first, last = F.when(F.col("_d") > 0, F.col("_a")).otherwise(F.col("_b")), F.when(F.col("_d") > 0, F.col("_b")).otherwise(F.col("_a"))
    return net.select(*keys, first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"), last["y"].alias("y2"))


def pair_distances(df: DataFrame, id_col: str, x: str, y: str) -> DataFrame:
    """All ordered pairs of distinct zones with straight, crosstown
    and uptown distances. The input is a zone dimension (hundreds of rows):
    the output is quadratic in it by definition."""
    a = df.select(F.col(id_col).alias("from_id"), F.col(x).alias("x1"), F.col(y).alias("y1"))
    b = df.select(F.col(id_col).alias("to_id"), F.col(x).alias("x2"), F.col(y).alias("y2"))
    return (a.join(b, F.col("from_id") != F.col("to_id"))
             .select("from_id", "to_id",
                     geo.distance("x1", "y1", "x2", "y2").alias("distance"),
                     geo.distance_crosstown("x1", "x2").alias("distance_crosstown"),
                     geo.distance_uptown("y1", "y2").alias("distance_uptown")))


def edges(df: DataFrame, id_col: str, rings: str = "rings") -> DataFrame:
    """One row per polygon edge: (id, ring, hole, ax, ay, bx, by)."""
    r = df.select(col_of(id_col).alias(id_col), F.posexplode(rings).alias("ring", "_r"))
    n = F.size("_r.pts")
    e = r.select(id_col, "ring", F.col("_r.hole").alias("hole"),
                 F.explode(F.arrays_zip(F.slice("_r.pts", 1, n - 1).alias("a"),
                                        F.slice("_r.pts", 2, n - 1).alias("b"))).alias("_e"))
    return e.select(id_col, "ring", "hole", F.col("_e.a.x").alias("ax"), F.col("_e.a.y").alias("ay"),
                    F.col("_e.b.x").alias("bx"), F.col("_e.b.y").alias("by"))


def transformed_centroids(df: DataFrame, id_col: str, transform=None, rings: str = "rings") -> DataFrame:
    """J6 (+J8): area and centroid of each polygon after an optional vertex
    transform (e.g. ``geo.lcc_forward``). Vertices are projected as plain rows
    (edges exploded, both endpoints projected), and the shoelace moments are
    a groupBy sum, so the projection compiles in whole-stage codegen."""
    e = edges(df, id_col, rings)
    if transform is not None:
        a = transform(F.col("ax"), F.col("ay"))
        b = transform(F.col("bx"), F.col("by"))
        e = e.select(id_col, "ring", "hole", a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"),
                     b["y"].alias("by"))
    cross = F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")
    e = e.select(id_col, "ring", "hole", (cross / 2).alias("a"), ((F.col("ax") + F.col("bx")) * cross / 6).alias("mx"),
                 ((F.col("ay") + F.col("by")) * cross / 6).alias("my"))
    # per ring: orient (outer positive, holes negative), then per polygon
    ring = e.groupBy(id_col, "ring", "hole").agg(F.sum("a").alias("a"), F.sum("mx").alias("mx"), F.sum("my").alias("my"))
    s = F.when(F.col("hole"), F.lit(-1.0)).otherwise(F.lit(1.0)) * F.signum("a")
    m = ring.groupBy(id_col).agg(F.sum(s * F.col("a")).alias("area"), F.sum(s * F.col("mx")).alias("_mx"),
                                 F.sum(s * F.col("my")).alias("_my"))
    return m.select(id_col, "area", (F.col("_mx") / F.col("area")).alias("x"),
                    (F.col("_my") / F.col("area")).alias("y"))
