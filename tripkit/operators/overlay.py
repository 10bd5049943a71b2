"""Valid and merged polygons (J6, J7, J11, F21): self-crossings repaired, overlapping parts united.

Polygons are taken apart into edges, and every step is a join or an aggregate of edges:

1. Noding: edges that share a grid cell are compared; where two cross, touch or overlap, both are
   split, so that afterwards edges meet at their ends only. Coordinates are snapped to a grid.
2. Each distinct edge finds, per ring, the winding number on its two sides: a ray from its middle counts the
   edges that it crosses (joined by horizontal band), and the edge's own occurrences make the difference
   of the sides.
3. A place is inside a polygon if it is inside a shell (odd winding) and in no hole. An edge with the inside of
   the group's union on one side only is boundary, directed with the inside on its left.
4. Boundary edges name their successor at their end; rings get a common label by pointer jumping, and each
   ring, one row of the result, is put in order.

The grid and the bands of a group follow its number of edges, so work grows with about the edges to the
power of 3/2. Groups of many parts are united in rounds, FAN parts at a time, so that edges inside what is
already united are gone before the next round. No group is gathered; a task holds one ring at a time.

Joins name their kind: the staged files are packed small, and by their size Spark would send whole tables of
edges through the driver.
"""

from __future__ import annotations

import sys as _sys
from typing import Sequence

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import cut_lineage

# The function that orders a ring runs in Python workers and is shipped by value with this module.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

#: Decimals kept of a coordinate.
DIGITS = 9
#: A slight shear: rays run along it, so that no edge of real data is parallel to them.
SHEAR = 0.012345678912345679
#: Parts of a group that are united in one round, about.
FAN = 16


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _edges(df: DataFrame, keys: Sequence[str], part: str | None, rings: str, digits: int) -> DataFrame:
    """(g, part, ring, hole, id, ax, ay, bx, by): snapped edges of closed rings, without those of no length."""
    r = df.select(F.struct(*keys).alias("g") if keys else F.struct(F.lit(0).alias("_all")).alias("g"),
                  (F.col(part) if part else F.monotonically_increasing_id()).alias("part"), F.col(rings).alias("_rings"))
    r = r.select("g", "part", F.posexplode("_rings").alias("ring", "_r"))
    pts = F.transform("_r.pts", lambda p: _point(F.round(p["x"], digits), F.round(p["y"], digits)))
    r = r.select("g", "part", "ring", F.col("_r.hole").alias("hole"), pts.alias("p")).where(F.size("p") > 0)
    r = r.withColumn("p", F.concat("p", F.array(F.element_at("p", 1))))  # closed; a second closing edge has no length
    e = r.select("g", "part", "ring", "hole", F.posexplode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p") - 1).alias("b"))).alias("i", "e"))
    e = e.where("e.a <> e.b").select("g", "part", "ring", "hole", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"), "i")
    return e.withColumn("id", F.struct("part", "ring", "i")).drop("i")


def _cells(e: DataFrame) -> DataFrame:
    """Each edge once per grid cell it may touch: all columns of its extent, in each the rows of its stretch there."""
    lim = e.groupBy("g").agg(F.min(F.least("ax", "bx")).alias("x0"), F.max(F.greatest("ax", "bx")).alias("x1"), F.min(F.least("ay", "by")).alias("y0"),
                             F.max(F.greatest("ay", "by")).alias("y1"), F.ceil(F.sqrt(F.count(F.lit(1)).cast("double"))).alias("n"))
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / F.col("n")
    e = e.join(lim.select("g", "x0", "y0", size.alias("size")).hint("merge"), "g")
    lo, hi = F.least("ax", "bx"), F.greatest("ax", "bx")
    e = e.withColumn("cx", F.explode(F.sequence(F.floor((lo - F.col("x0")) / F.col("size")), F.floor((hi - F.col("x0")) / F.col("size")))))
    slope = F.when(F.col("ax") != F.col("bx"), (F.col("by") - F.col("ay")) / (F.col("bx") - F.col("ax")))

    def y_at(x):
        return F.when(slope.isNull(), None).otherwise(F.col("ay") + (x - F.col("ax")) * slope)

    left = F.greatest(lo, F.col("x0") + F.col("cx") * F.col("size"))
    right = F.least(hi, F.col("x0") + (F.col("cx") + 1) * F.col("size"))
    ends = [F.coalesce(y_at(left), F.col("ay")), F.coalesce(y_at(right), F.col("by"))]
    room = F.col("size") * 1e-6  # rounding at the border of a cell
    row = [F.floor((F.least(*ends) - room - F.col("y0")) / F.col("size")), F.floor((F.greatest(*ends) + room - F.col("y0")) / F.col("size"))]
    return e.withColumn("cy", F.explode(F.sequence(*row))).drop("x0", "y0", "size")


def _split_points(e: DataFrame, digits: int) -> DataFrame:
    """(g, id, x, y): where another edge of the group crosses, touches or runs along an edge."""
    c = cut_lineage(_cells(e).select("g", "cx", "cy", "id", "ax", "ay", "bx", "by"))
    p = c.alias("p").join(c.alias("q").hint("merge"), ["g", "cx", "cy"]).where(F.col("p.id") < F.col("q.id"))
    v = {f"{s}{k}": F.col(f"{s}.{k}") for s in "pq" for k in ("ax", "ay", "bx", "by")}
    meet = (F.least(v["pax"], v["pbx"]) <= F.greatest(v["qax"], v["qbx"])) & (F.least(v["qax"], v["qbx"]) <= F.greatest(v["pax"], v["pbx"])) & (
        F.least(v["pay"], v["pby"]) <= F.greatest(v["qay"], v["qby"])) & (F.least(v["qay"], v["qby"]) <= F.greatest(v["pay"], v["pby"]))
    p = p.where(meet)
    dpx, dpy, dqx, dqy = v["pbx"] - v["pax"], v["pby"] - v["pay"], v["qbx"] - v["qax"], v["qby"] - v["qay"]
    det = dpx * dqy - dpy * dqx
    t = ((v["qax"] - v["pax"]) * dqy - (v["qay"] - v["pay"]) * dqx) / F.when(det != 0, det)
    u = ((v["qax"] - v["pax"]) * dpy - (v["qay"] - v["pay"]) * dpx) / F.when(det != 0, det)
    cross = F.when((t >= 0) & (t <= 1) & (u >= 0) & (u <= 1), _point(F.round(v["pax"] + t * dpx, digits), F.round(v["pay"] + t * dpy, digits)))

    def on(x, y, s):
        """The end (x, y) of one edge if it lies on edge ``s`` (as near as the snapping can tell)."""
        ax, ay, bx, by = (v[s + k] for k in ("ax", "ay", "bx", "by"))
        off = F.abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) / F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
        return F.when((off <= 2 * 10.0 ** -digits) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by)), _point(x, y))

    # An end that lies on the other edge splits it there, exactly; else a crossing splits both.
    to_p, to_q = [on(v["qax"], v["qay"], "p"), on(v["qbx"], v["qby"], "p")], [on(v["pax"], v["pay"], "q"), on(v["pbx"], v["pby"], "q")]
    touch = F.coalesce(*to_p, *to_q).isNotNull()
    crossing = F.when(~touch, cross)
    found = p.select("g", F.explode(F.array(
        F.struct(F.col("p.id").alias("id"), F.array_compact(F.array(*to_p, crossing)).alias("at")),
        F.struct(F.col("q.id").alias("id"), F.array_compact(F.array(*to_q, crossing)).alias("at")))).alias("f"))
    return found.select("g", "f.id", F.explode("f.at").alias("at"))


def noded(e: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(g, u, v, part, ring, hole, net): pieces of edges that meet at their ends only, u before v; ``net`` is how
    often a ring runs from u to v, less how often back (0 left out)."""
    marks = _split_points(e, digits).groupBy("g", "id").agg(F.collect_set("at").alias("at"))
    e = e.join(marks.hint("merge"), ["g", "id"], "left")
    a, b = _point(F.col("ax"), F.col("ay")), _point(F.col("bx"), F.col("by"))
    every = F.array_distinct(F.concat(F.array(a, b), F.coalesce("at", F.array().cast("array<struct<x:double,y:double>>"))))
    along = F.transform(every, lambda p: F.struct(((p["x"] - F.col("ax")) * (F.col("bx") - F.col("ax")) + (p["y"] - F.col("ay")) * (F.col("by") - F.col("ay"))).alias("t"),
                                                  p["x"].alias("x"), p["y"].alias("y")))
    s = e.select("g", "part", "ring", "hole", F.sort_array(along).alias("s"))
    n = F.size("s") - 1
    s = s.select("g", "part", "ring", "hole", F.explode(F.arrays_zip(F.slice("s", 1, n).alias("a"), F.slice("s", 2, n).alias("b"))).alias("e"))
    a, b = _point(F.col("e.a.x"), F.col("e.a.y")), _point(F.col("e.b.x"), F.col("e.b.y"))
    s = s.select("g", "part", "ring", "hole", F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), F.when(a < b, 1).otherwise(-1).alias("d")).where("u <> v")
    return s.groupBy("g", "u", "v", "part", "ring", "hole").agg(F.sum("d").alias("net")).where("net <> 0")


def _height(p: Column) -> Column:
    return p["y"] + SHEAR * p["x"]


def boundary(df: DataFrame, keys: Sequence[str], part: str | None = None, rings: str = "rings", digits: int = DIGITS) -> DataFrame:
    """(g, a, b): boundary of the union of each group's polygons as edges with the inside on their left.

    ``part`` tells the polygons of a group apart (default: a row each). With the polygon's id as key the
    boundary is that of the repaired polygon. Rings need not be closed; holes cut only their own polygon.
    """
    e = cut_lineage(_edges(df, keys, part, rings, digits))
    parts = e.select("g", "part").distinct().groupBy("g").agg(F.ceil(F.count(F.lit(1)) / FAN).alias("buckets"))
    width = parts.agg(F.max("buckets")).first()[0] or 1  # buckets of the group with the most parts
    if width > 1:
        e = e.join(parts.hint("merge"), "g").withColumn("part_of", F.pmod(F.xxhash64("part"), F.col("buckets"))).drop("buckets")
    while width > 1:
        united = cut_lineage(_boundary(e.withColumn("g", F.struct("g", "part_of")).drop("part_of"), digits))
        e = united.select(F.col("g.g").alias("g"), F.col("g.part_of").alias("part"), F.lit(0).alias("ring"), F.lit(False).alias("hole"), F.struct("a", "b").alias("e"))
        e = e.select("g", "part", "ring", "hole", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"),
                     F.struct("part", "ring", "e").alias("id"), F.floor(F.col("part") / FAN).alias("part_of"))
        width = -(-width // FAN)
    return _boundary(e.drop("part_of"), digits)


def _boundary(e: DataFrame, digits: int) -> DataFrame:
    """(g, a, b): ``boundary`` of the groups of ``_edges``, all parts at once."""
    s = cut_lineage(noded(e, digits))
    hu, hv = _height(F.col("u")), _height(F.col("v"))
    lim = s.groupBy("g").agg(F.min(F.least(hu, hv)).alias("h0"), F.max(F.greatest(hu, hv)).alias("h1"), F.ceil(F.sqrt(F.count(F.lit(1)).cast("double"))).alias("n"))
    s = s.join(lim.select("g", "h0", ((F.col("h1") - F.col("h0")) / F.col("n")).alias("size")).hint("merge"), "g").withColumns({"hu": hu, "hv": hv})
    band = lambda h: F.floor((h - F.col("h0")) / F.col("size"))
    # Only edges that some ring crosses an odd number of times can be boundary.
    asked = s.where("net % 2 <> 0").select("g", "u", "v", "h0", "size").distinct()
    mid = _point((F.col("u.x") + F.col("v.x")) / 2, (F.col("u.y") + F.col("v.y")) / 2)
    asked = asked.withColumn("m", mid).withColumn("hm", _height(F.col("m"))).withColumn("band", band(F.col("hm"))).select("g", "band", "u", "v", "m", "hm")
    walls = s.withColumn("band", F.explode(F.sequence(band(F.least("hu", "hv")), band(F.greatest("hu", "hv")))))
    walls = walls.select("g", "band", F.col("u").alias("wu"), F.col("v").alias("wv"), "part", "ring", "hole", "net", "hu", "hv")
    x_at = F.col("wu.x") + (F.col("hm") - F.col("hu")) / (F.col("hv") - F.col("hu")) * (F.col("wv.x") - F.col("wu.x"))
    up = F.when(F.col("hv") > F.col("hu"), 1).otherwise(-1)
    hits = (asked.join(walls.hint("merge"), ["g", "band"]).where(((F.col("hu") <= F.col("hm")) != (F.col("hv") <= F.col("hm"))) & ~((F.col("u") == F.col("wu")) & (F.col("v") == F.col("wv"))))
            .where(x_at > F.col("m.x")).select("g", "u", "v", "part", "ring", "hole", (up * F.col("net")).alias("right"), F.lit(0).cast("long").alias("own")))
    own = s.select("g", "u", "v", "part", "ring", "hole", F.lit(0).cast("long").alias("right"), (up * F.col("net")).alias("own"))
    own = own.join(asked.select("g", "u", "v").hint("merge"), ["g", "u", "v"], "left_semi")
    winding = hits.unionByName(own).groupBy("g", "u", "v", "part", "ring", "hole").agg(F.sum("right").alias("r"), F.sum("own").alias("o"))
    sides = {"right": F.col("r") % 2 != 0, "left": (F.col("r") + F.col("o")) % 2 != 0}
    inside = winding.groupBy("g", "u", "v", "part").agg(
        *[(F.coalesce(F.bool_or(~F.col("hole") & odd), F.lit(False)) & ~F.coalesce(F.bool_or(F.col("hole") & odd), F.lit(False))).alias(n) for n, odd in sides.items()])
    either = inside.groupBy("g", "u", "v").agg(F.bool_or("left").alias("left"), F.bool_or("right").alias("right")).where("left <> right")
    rises = _height(F.col("v")) > _height(F.col("u"))
    along = F.col("left") == rises  # inside on the left of an edge that goes up, on the right of one that goes down
    return either.select("g", F.when(along, F.col("u")).otherwise(F.col("v")).alias("a"), F.when(along, F.col("v")).otherwise(F.col("u")).alias("b"))


def edge_areas(edges: DataFrame) -> DataFrame:
    """(g, area, x, y): area and centroid of each group from its directed boundary."""
    cross = F.col("a.x") * F.col("b.y") - F.col("b.x") * F.col("a.y")
    m = edges.groupBy("g").agg((F.sum(cross) / 2).alias("area"), (F.sum((F.col("a.x") + F.col("b.x")) * cross) / 6).alias("mx"),
                               (F.sum((F.col("a.y") + F.col("b.y")) * cross) / 6).alias("my"))
    return m.select("g", "area", (F.col("mx") / F.col("area")).alias("x"), (F.col("my") / F.col("area")).alias("y"))


def chained(edges: DataFrame) -> DataFrame:
    """(g, hole, pts): the rings of a directed boundary, closed; shells run counter-clockwise, holes clockwise.

    Where rings touch in a point the next edge is the first one clockwise from where the edge came, so rings
    do not cross; a ring that comes back to a point is cut there. Labels are found by pointer jumping: the rounds grow with the logarithm of a ring's edges.
    """
    e = edges.withColumn("id", F.struct("a", "b"))
    angle = lambda p, q: F.atan2(q["y"] - p["y"], q["x"] - p["x"])
    outs = e.groupBy("g", F.col("a").alias("node")).agg(F.collect_list(F.struct(angle(F.col("a"), F.col("b")).alias("angle"), F.col("id"))).alias("outs"))
    e = e.withColumn("node", F.col("b")).withColumn("back", angle(F.col("b"), F.col("a"))).join(outs.hint("merge"), ["g", "node"])
    before = F.filter("outs", lambda o: o["angle"] < F.col("back"))
    e = e.withColumn("next", F.coalesce(F.array_max(before), F.array_max("outs"))["id"])
    links = cut_lineage(e.select("g", "id", "next"))
    now = links.select("g", "id", F.col("next").alias("far"), F.least("id", "next").alias("label"))
    while True:
        then = now.select("g", F.col("id").alias("far"), F.col("far").alias("farther"), F.col("label").alias("beyond"))
        new = cut_lineage(now.join(then.hint("merge"), ["g", "far"]).select("g", "id", F.col("farther").alias("far"), F.least("label", "beyond").alias("label"),
                                                              (F.col("beyond") < F.col("label")).alias("moved")))
        if new.where("moved").isEmpty():
            break
        now = new.drop("moved")
    rings = links.join(now.select("g", "id", "label").hint("merge"), ["g", "id"]).groupBy("g", "label").agg(F.collect_list(F.struct("id", "next")).alias("links"))

    def key(edge):
        return edge["a"]["x"], edge["a"]["y"], edge["b"]["x"], edge["b"]["y"]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            at_row, out = [], []
            for row, (label, links) in enumerate(zip(b.column("label").to_pylist(), b.column("links").to_pylist())):
                after = {key(k["id"]): key(k["next"]) for k in links}
                at = start = key(label)
                path, place = [at[:2]], {at[:2]: 0}
                while True:
                    p = at[2:]
                    if p in place:  # back at a point: what lies between is a ring of its own
                        ring = path[place[p]:]
                        out.append([{"x": x, "y": y} for x, y in [*ring, p]])
                        at_row.append(row)
                        for q in ring[1:]:
                            del place[q]
                        del path[place[p] + 1:]
                    else:
                        place[p] = len(path)
                        path.append(p)
                    at = after[at]
                    if at == start:
                        break
            kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("g").take(pa.array(at_row, pa.int64())), pa.array(out, kind)], names=["g", "pts"])

    group = rings.schema["g"].dataType.simpleString()
    pts = rings.mapInArrow(run, f"g {group}, pts array<struct<x:double,y:double>>")
    return pts.select("g", (geo.ring_signed_area("pts") < 0).alias("hole"), "pts")


def union_rings(df: DataFrame, keys: Sequence[str], part: str | None = None, rings: str = "rings", digits: int = DIGITS) -> DataFrame:
    """Closed rings (keys, hole, pts) of the union of each group's polygons, a row each."""
    out = chained(cut_lineage(boundary(df, keys, part, rings, digits)))
    return out.select(*[F.col("g")[k].alias(k) for k in keys], "hole", "pts")


def union_areas(df: DataFrame, keys: Sequence[str], part: str | None = None, rings: str = "rings", digits: int = DIGITS) -> DataFrame:
    """(keys, area, x, y): area and centroid of the union of each group's polygons, overlaps counted once."""
    out = edge_areas(boundary(df, keys, part, rings, digits))
    return out.select(*[F.col("g")[k].alias(k) for k in keys], "area", "x", "y")


def make_valid(df: DataFrame, keys: Sequence[str], rings: str = "rings", digits: int = DIGITS) -> DataFrame:
    """(keys, rings) with every polygon repaired: rings that cross themselves are taken apart by odd winding,
    spikes and doubled edges go, holes keep only what they cut from the shells. ``keys`` identify a polygon;
    one without any inside is left out."""
    out = union_rings(df.withColumn("_part", F.lit(0)), keys, "_part", rings, digits)
    return out.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("hole", "pts"))).alias(rings))
