"""Repaired and merged polygons against areas worked out by hand and by unit cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkit.functions import geo
from tripkit.operators import overlay as O

#: name, WKT, area: self-crossings, holes over the border, spikes, doubled rings, open rings.
SHAPES = [
    ("square", "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))", 16.0),
    ("clockwise", "POLYGON((0 0, 0 4, 4 4, 4 0, 0 0))", 16.0),
    ("bow-tie", "POLYGON((0 0, 4 4, 4 0, 0 4, 0 0))", 8.0),
    ("overlapping hole", "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0),(3 1, 6 1, 6 3, 3 3, 3 1))", 14.0),
    ("two holes that overlap", "POLYGON((0 0, 6 0, 6 6, 0 6, 0 0),(1 1, 3 1, 3 3, 1 3, 1 1),(2 2, 4 2, 4 4, 2 4, 2 2))", 29.0),
    ("spike", "POLYGON((0 0, 4 0, 4 4, 9 9, 4 4, 0 4, 0 0))", 16.0),
    ("repeated spike", "POLYGON((0 0, 4 0, 4 4, 9 9, 4 4, 9 9, 4 4, 0 4, -3 7, 0 4, 0 0))", 16.0),
    ("repeated points, open", "POLYGON((0 0, 0 0, 4 0, 4 0, 4 4, 0 4))", 16.0),
    ("star of five", "POLYGON((0 0, 2 6, 4 0, -1 4, 5 4, 0 0))", None),
    ("touching holes", "POLYGON((0 0, 6 0, 6 6, 0 6, 0 0),(1 1, 3 1, 3 3, 1 3, 1 1),(3 3, 5 3, 5 5, 3 5, 3 3))", 28.0),
    ("flat", "POLYGON((0 0, 4 0, 2 0, 0 0))", 0.0),
    ("ring run twice", "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0, 2 0, 2 2, 0 2, 0 0))", 0.0),
]


def _odd_area(pts, n=801):
    """Area of odd winding by sampling."""
    x, y = np.meshgrid(np.linspace(-1.5, 5.5, n), np.linspace(-0.5, 6.5, n))
    inside = np.zeros(x.shape, bool)
    for (ax, ay), (bx, by) in zip(pts, pts[1:]):
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return inside.mean() * 49


def test_make_valid_areas(spark):
    df = spark.createDataFrame([(n, w) for n, w, _ in SHAPES], "name string, wkt string").select("name", geo.parse_wkt("wkt").alias("rings"))
    out = O.make_valid(df, ["name"])
    got = {r["name"]: r for r in out.select("name", "rings", geo.area("rings").alias("area")).collect()}
    for name, _, area in SHAPES:
        if area == 0.0:
            assert name not in got
        elif area is not None:
            assert abs(got[name]["area"] - area) < 1e-9, name
    star = [(0, 0), (2, 6), (4, 0), (-1, 4), (5, 4), (0, 0)]
    assert abs(got["star of five"]["area"] - _odd_area(star)) < 0.05
    for r in got.values():  # closed, without repeated points, shells first and counter-clockwise
        for ring in r["rings"]:
            p = [(q["x"], q["y"]) for q in ring["pts"]]
            assert p[0] == p[-1] and len(set(p)) == len(p) - 1 >= 3
            signed = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:])) / 2
            assert (signed < 0) == ring["hole"]
    assert len(got["touching holes"]["rings"]) == 3 and len(got["bow-tie"]["rings"]) == 2
    again = O.make_valid(out, ["name"])  # valid polygons stay
    assert {r["name"]: round(r["a"], 6) for r in again.select("name", geo.area("rings").alias("a")).collect()} == {n: round(r["area"], 6) for n, r in got.items()}
    assert O.make_valid(df.where("false"), ["name"]).count() == 0


def test_union_of_overlapping_rectangles(spark):
    rng = np.random.default_rng(4)
    rows, cells = [], {}
    for k, n in (("few", 6), ("many", 60), (None, 9)):
        for i in range(n):
            x, y, w, h = (int(v) for v in (*rng.integers(0, 14, 2), *rng.integers(1, 6, 2)))
            rows.append((k, f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"))
            cells.setdefault(k, set()).update((a, b) for a in range(x, x + w) for b in range(y, y + h))
    df = spark.createDataFrame(rows, "k string, wkt string").select("k", geo.parse_wkt("wkt").alias("rings"))
    got = {r["k"]: r for r in O.union_areas(df, ["k"]).collect()}
    for k, c in cells.items():
        c = np.array(sorted(c))
        assert abs(got[k]["area"] - len(c)) < 1e-6
        assert abs(got[k]["x"] - (c[:, 0] + 0.5).mean()) < 1e-6 and abs(got[k]["y"] - (c[:, 1] + 0.5).mean()) < 1e-6
    rings = O.union_rings(df, ["k"]).select("k", "hole", geo.ring_signed_area("pts").alias("a"), F.size("pts").alias("n")).collect()
    for k, c in cells.items():
        assert abs(sum(r["a"] for r in rings if r["k"] == k) - len(c)) < 1e-6
    assert all(r["hole"] == (r["a"] < 0) and r["n"] >= 5 for r in rings)


def test_union_of_shapes_that_are_not_rectangles(spark):
    """Two triangles over each other (a hexagram), beside a diamond that touches a corner."""
    df = spark.createDataFrame([(1, "POLYGON((0 0, 6 0, 3 6, 0 0))"), (1, "POLYGON((0 4, 3 -2, 6 4, 0 4))"), (2, "POLYGON((6 0, 8 -2, 10 0, 8 2, 6 0))")],
                               "id int, wkt string").select("id", F.lit(1).alias("k"), geo.parse_wkt("wkt").alias("rings"))
    area = O.union_areas(df, ["k"]).first()["area"]
    assert abs(area - (18 + 18 - 12 + 8)) < 1e-6  # the triangles share a hexagon of 12
    assert O.union_rings(df, ["k"]).count() == 2


def test_union_of_many_parts_in_rounds(spark, monkeypatch):
    """A group of many overlapping parts is united a few parts at a time; a hole cuts only its own part."""
    rng = np.random.default_rng(5)
    rects, seen = [], np.zeros((2, 30, 30), bool)
    for i in range(150):
        k, (x, y), (w, h) = i % 10 // 9, rng.integers(0, 20, 2).tolist(), rng.integers(3, 9, 2).tolist()
        rects.append((k, i, f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}),({x + 1} {y + 1}, {x + 2} {y + 1}, {x + 2} {y + 2}, {x + 1} {y + 2}, {x + 1} {y + 1}))"))
        own = np.zeros((30, 30), bool)
        own[x:x + w, y:y + h] = True
        own[x + 1, y + 1] = False
        seen[k] |= own
    df = spark.createDataFrame(rects, "k long, part long, wkt string").select("k", "part", geo.parse_wkt("wkt").alias("rings"))
    most, once = [], O.noded

    def counted(e, digits):
        most.append(e.groupBy("g").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0])
        return once(e, digits)

    monkeypatch.setattr(O, "noded", counted)
    got = {r["k"]: r["area"] for r in O.union_areas(df, ["k"], "part").collect()}
    assert all(abs(got[k] - seen[k].sum()) < 1e-9 for k in (0, 1))
    assert len(most) > 1 and max(most) < 60  # 135 parts in the larger group


def test_small_packed_files_are_not_sent_through_the_driver(spark):
    df = spark.createDataFrame([(n, w) for n, w, _ in SHAPES], "name string, wkt string").select("name", geo.parse_wkt("wkt").alias("rings"))
    e = O.cut_lineage(O._edges(df.withColumn("part", F.lit(0)), ["name"], "part", "rings", O.DIGITS))
    edges = O.boundary(df.withColumn("part", F.lit(0)), ["name"], "part")
    for d in (O.noded(e), edges, O.chained(edges)):
        assert "Broadcast" not in d._jdf.queryExecution().executedPlan().toString()
