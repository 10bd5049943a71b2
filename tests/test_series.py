from pyspark.sql import functions as F

from tripkit.operators import relational as Rel
from tripkit.operators import rollups as R
from tripkit.operators import series as S


def test_rolling_sum_null_until_k(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4])], "k string, d int, x double")
    got = [r.s for r in S.rolling(df, ["k"], ["d"], "x", 3, out="s").orderBy("d").collect()]
    assert got == [None, None, 6.0, 9.0]            # FIXTURES G3


def test_densify_fills_every_period(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-03", 2)], "k string, d string, n int") \
        .withColumn("d", F.col("d").cast("date"))
    out = S.densify(df, ["k"], "d", ["n"])
    assert out.count() == 2 * 3 and out.filter(F.col("n") == 0).count() == 4


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 4, 3, 3, 3, 1]], "v int")
    assert S.top_k(df, [], "v", 2).count() == 2 and S.top_k(df, [], "v", 3).count() == 3
    assert S.top_k(df, [], "v", 4, ascending=True).count() == 4 + 0
    assert S.top_k(df, [], "v", 2, ascending=True).count() == 4   # 1 then three 3s tie at rank 2


def test_grouping_sets_totals_equal_base(spark):
    rows = [("t", p, d, 1, 2.0 + p, 3 + d) for p in range(3) for d in range(2)]
    df = spark.createDataFrame(rows, "c string, p int, d int, m int, x double, w long")
    g = R.weighted_grouping_sets(df, [["c", "p", "d", "m"], ["c", "p", "m"], ["c", "m"]], ["x"], "w", sums=["w"])
    tot = g.filter((F.col("p") == -1) & (F.col("d") == -1)).first()
    assert tot.w == sum(r[5] for r in rows)
    assert abs(tot.x - sum(r[4] * r[5] for r in rows) / sum(r[5] for r in rows)) < 1e-12


def test_weighted_mean_drops_null_values_and_weights(spark):
    df = spark.createDataFrame([("a", None, 5.0), ("a", 2.0, 1.0), ("b", None, 3.0)], "k string, x double, w double")
    got = {r.k: r.m for r in df.groupBy("k").agg(R.weighted_mean("x", "w").alias("m")).collect()}
    assert got == {"a": 2.0, "b": None}


def test_not_in_with_null_returns_nothing(spark):
    df = spark.createDataFrame([(1,), (2,)], "z int")
    keys_ok = spark.createDataFrame([(1,)], "z int")
    keys_null = spark.createDataFrame([(1,), (None,)], "z int")
    assert [r.z for r in Rel.not_in_set(df, "z", keys_ok).collect()] == [2]
    assert Rel.not_in_set(df, "z", keys_null).count() == 0          # trap T8


def test_duplicate_zone_ids_deduped(spark):
    zones = spark.createDataFrame([(56, "x"), (56, "x"), (57, "y")], "location_id int, zone string")
    trips = spark.createDataFrame([(56,), (57,)], "z int")
    dim = zones.dropDuplicates(["location_id"])
    assert trips.join(dim, trips.z == dim.location_id).count() == trips.count()   # T11
    assert Rel.duplicate_keys(zones, ["location_id"]).count() == 1


def test_union_unpivot_natural_join_allocate(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    assert Rel.union_distinct(a, a).count() == 2 and Rel.union_all(a, a).count() == 6
    w = spark.createDataFrame([("d1", 1.0, 2.0)], "date string, taxi double, bike double")
    assert sorted((r.mode, r.value) for r in Rel.unpivot(w, ["date"], ["taxi", "bike"], "mode", "value").collect()) == \
        [("bike", 2.0), ("taxi", 1.0)]
    b = spark.createDataFrame([(1, "x", 10)], "k int, v string, n int")
    assert Rel.natural_join(a.distinct(), b).count() == 1
    votes = spark.createDataFrame([(1, 100.0), (2, 50.0)], "d int, votes double")
    mp = spark.createDataFrame([(1, "z1", 0.25), (1, "z2", 0.75), (2, "z2", 1.0)], "d int, zone string, f double")
    got = {r.zone: r.votes for r in R.allocate(votes, mp, "d", "votes", "f", "zone").collect()}
    assert got == {"z1": 25.0, "z2": 125.0}


def test_impute_from_peers_and_latest(spark):
    rows = [("uber", "total", "d", 100.0), ("uber", "core", "d", 40.0), ("lyft", "total", "d", 100.0),
            ("lyft", "core", "d", 60.0), ("juno", "total", "d", 10.0), ("juno", "core", "d", 0.0)]
    df = spark.createDataFrame(rows, "car string, geo string, date string, x double")
    out = {(r.car, r.geo): (r.x, r.is_estimated) for r in
           S.impute_from_peers(df, ["car"], "date", "geo", "x", "car", ["uber", "lyft"], ["juno"]).collect()}
    assert out[("juno", "core")] == (5.0, True) and out[("juno", "total")] == (10.0, False)
    s = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, d int")
    assert sorted((r.k, r.d) for r in S.latest_per(s, ["k"], "d").collect()) == [("a", 3), ("b", 2)]


def test_keyless_top_k_keeps_ties_and_ranks_like_a_window(spark):
    rows = [(i, v) for i, v in enumerate([5, 9, 9, 7, 7, 7, 1, None, 2])]
    df = spark.createDataFrame(rows, "i int, v int")
    got = {r.i: r["rank"] for r in S.top_k(df, [], "v", 4).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}
    assert {r.i: r["rank"] for r in S.top_k(df, [], "v", 2, ascending=True).collect()} == {6: 1, 8: 2}


def test_key_uniqueness_and_delays(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 2), (None, 2)], "k string, v int")
    assert tuple(Rel.key_uniqueness(df, ["k", "v"]).first()) == (5, 2)
    assert tuple(Rel.key_uniqueness(df.filter("false"), ["k"]).first()) == (0, 0)
    days = spark.createDataFrame([("r", 100.0, 100.0), ("r", 100.0, 700.0), ("r", 400.0, 100.0)], "r string, taxi double, bike double")
    d = S.delay_vs_median(days, ["r"], ["taxi", "bike"], (300, 600)).first()
    assert (d.taxi_over_300, d.bike_over_300, d.taxi_over_600, d.bike_over_600) == (1, 1, 0, 1)
    assert d.ratio_300 == 1.0 and d.ratio_600 == 0.0
