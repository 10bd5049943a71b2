"""K5 exactness against a brute-force pair count, including a hot bucket that
holds most rows; K6 repeatability; OLS against numpy."""
import random

import pytest
import numpy as np
from pyspark.sql import functions as F

from tripkit.operators import stats as K


def brute(rows, min_obs=5):
    out = {}
    buckets = {r[0] for r in rows}
    for b in buckets:
        a = [v for k, m, v in rows if k == b and m == "taxi"]
        c = [v for k, m, v in rows if k == b and m == "bike"]
        if len(a) < min_obs or len(c) < min_obs:
            continue
        wins = sum(1 for x in a for y in c if x < y)
        am = sum(y - x for x in a for y in c if x < y)
        bm = sum(x - y for x in a for y in c if x >= y)
        n = len(a) * len(c)
        out[b] = (wins / n, am / wins if wins else None, bm / (n - wins) if n > wins else None)
    return out


def test_fixture_example(spark):
    df = spark.createDataFrame([("b", "taxi", 1.0), ("b", "taxi", 3.0), ("b", "bike", 2.0), ("b", "bike", 3.0)],
                               "k string, m string, v double")
    r = K.win_rate(df, ["k"], "m", "taxi", "bike", "v", min_obs=1).first()
    assert r.win_rate == 0.5                       # (1<2), (1<3): 2 of 4; the tie 3=3 is not a win


def test_win_rate_matches_brute_force_with_hot_bucket(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):                           # a hot bucket: most rows in 'hot'
        k = "hot" if i % 4 else f"b{i % 7}"
        rows.append((k, rnd.choice(["taxi", "bike"]), float(rnd.randint(1, 400))))   # many ties
    df = spark.createDataFrame(rows, "k string, m string, v double")
    got = {r.k: r for r in K.win_rate(df, ["k"], "m", "taxi", "bike", "v", min_obs=5, splits=8).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for k, (wr, am, bm) in want.items():
        assert abs(got[k].win_rate - wr) < 1e-12
        assert abs(got[k].mean_margin_a_wins - am) < 1e-9 and abs(got[k].mean_margin_b_wins - bm) < 1e-9


def test_split_cumsum_equals_running_sum(spark):
    rows = [("g", float(v), 1.0) for v in range(200)] + [("h", float(v), 2.0) for v in range(5)]
    df = spark.createDataFrame(rows, "k string, v double, n double")
    got = {(r.k, r.v): r.cum_n for r in K.split_cumsum(df, ["k"], "v", ["n"], splits=8).collect()}
    assert got[("g", 0.0)] == 1 and got[("g", 199.0)] == 200 and got[("h", 4.0)] == 10
    excl = {(r.k, r.v): r.cum_n for r in K.split_cumsum(df, ["k"], "v", ["n"], splits=8, inclusive=False).collect()}
    assert excl[("g", 0.0)] == 0 and excl[("g", 199.0)] == 199


def test_bootstrap_repeatable_and_close_to_exact(spark):
    rnd = random.Random(3)
    rows = [("d", rnd.choice(["taxi", "bike"]), rnd.gauss(100 if i % 2 else 110, 20)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    d1 = K.bootstrap_pairs(df, ["k"], "m", "taxi", "bike", "v", n=4000, seed=11)
    d2 = K.bootstrap_pairs(df, ["k"], "m", "taxi", "bike", "v", n=4000, seed=11)
    s1 = sorted((r.draw, r.va, r.vb) for r in d1.collect())
    assert s1 == sorted((r.draw, r.va, r.vb) for r in d2.collect()) and len(s1) == 4000
    sampled = K.winning_margins(d1, ["k"]).first().sampled_win_rate
    exact = K.win_rate(df, ["k"], "m", "taxi", "bike", "v").first().win_rate
    assert abs(sampled - exact) < 4 * (exact * (1 - exact) / 4000) ** 0.5


def test_ols_and_weighted_ols_match_numpy(spark):
    rnd = np.random.default_rng(5)
    x = rnd.uniform(0, 10, 300)
    f = rnd.choice(["a", "b", "c"], 300)
    w = rnd.integers(1, 5, 300).astype(float)
    y = 1.5 + 0.7 * x + np.where(f == "b", 0.3, 0) + np.where(f == "c", -0.2, 0) + rnd.normal(0, 0.1, 300)
    df = spark.createDataFrame([(float(a), str(b), float(c), float(d)) for a, b, c, d in zip(x, f, w, y)],
                               "x double, f string, w double, y double")
    r = K.ols(df, "y", "x").first()
    slope, intercept = np.polyfit(x, y, 1)
    assert abs(r.slope - slope) < 1e-9 and abs(r.intercept - intercept) < 1e-9
    coef, _ = K.weighted_ols(df, F.col("y"), {"x": F.col("x")}, {"f": ["a", "b", "c"]}, "w")
    est = {r.term: r.estimate for r in coef.collect()}
    X = np.column_stack([x, f == "b", f == "c", np.ones(300)]).astype(float)
    sw = np.sqrt(w)
    beta = np.linalg.lstsq(X * sw[:, None], y * sw, rcond=None)[0]
    for name, b in zip(["x", "fb", "fc", "(Intercept)"], beta):
        assert abs(est[name] - b) < 1e-8
    mult = {r.level: r.multiplier for r in K.multipliers(coef, "f", "a").collect()}
    assert mult["a"] == 1.0 and abs(mult["b"] - np.exp(beta[1])) < 1e-8


def test_exact_percentiles_match_numpy_with_hot_and_null_groups(spark):
    rnd = random.Random(9)
    rows = [("hot" if i % 5 else (None if i % 2 else "cold"), float(rnd.randint(0, 50))) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double")
    ps = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r.k: r for r in K.exact_percentiles(df, ["k"], "v", ps, [f"p{i}" for i in range(5)], splits=8).collect()}
    for key in ("hot", "cold", None):
        vals = np.array([v for k, v in rows if k == key])
        for i, p in enumerate(ps):
            assert abs(getattr(got[key], f"p{i}") - np.quantile(vals, p)) < 1e-9


from hypothesis import given, settings, strategies as st


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["taxi", "bike"]),
                          st.integers(min_value=0, max_value=12)), min_size=1, max_size=120),
       st.integers(min_value=2, max_value=6))
def test_win_rate_property(spark, rows, splits):
    rows = [(k, m, float(v)) for k, m, v in rows]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    got = {r.k: r for r in K.win_rate(df, ["k"], "m", "taxi", "bike", "v", min_obs=1, splits=splits,
                                      materialise=False).collect()}
    want = brute(rows, min_obs=1)
    assert set(got) == set(want)
    for k, (wr, am, bm) in want.items():
        assert 0.0 <= got[k].win_rate <= 1.0 and abs(got[k].win_rate - wr) < 1e-12
        assert (got[k].mean_margin_a_wins is None) == (am is None)
        assert (got[k].mean_margin_b_wins is None) == (bm is None)


def test_null_buckets_are_kept(spark):
    rows = [(k, m, float(v)) for k in (None, "x") for v in range(10) for m in ("taxi", "bike")]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    assert {r.k for r in K.win_rate(df, ["k"], "m", "taxi", "bike", "v").collect()} == {None, "x"}
    assert {r.k for r in K.bootstrap_pairs(df, ["k"], "m", "taxi", "bike", "v", n=20).select("k").distinct().collect()} == {None, "x"}


def test_weighted_ols_unlisted_levels_nulls_and_aliased_terms(spark):
    df = spark.createDataFrame([(float(i), "ab"[i % 2], 1.0, float(2 * i + i % 2)) for i in range(20)] + [(None, "a", 1.0, 1.0)],
                               "x double, f string, w double, y double")
    coef, info = K.weighted_ols(df, F.col("y"), {"x": F.col("x")}, {"f": ["a", "b", "c"]}, "w")
    est = {r.term: r.estimate for r in coef.collect()}
    assert abs(est["x"] - 2) < 1e-9 and abs(est["fb"] - 1) < 1e-9 and est["fc"] is None
    assert info == {"rows": 20, "dropped": 1}
    with pytest.raises(ValueError):
        K.weighted_ols(df, F.col("y"), {"x": F.col("x")}, {"f": ["a", "c"]}, "w")


def test_p_values_match_published_fits(spark):
    fits = spark.createDataFrame([(5.567, 235), (-0.120, 235), (-2.505, 235), (None, 235), (1.0, 2)], "slope_t double, n long")
    got = [r.p_value for r in K.with_p_value(fits).collect()]
    assert abs(got[0] / 7.13e-08 - 1) < 0.01 and abs(got[1] - 0.904) < 1e-3 and abs(got[2] - 0.0129) < 1e-4
    assert got[3] is None or got[3] != got[3]
    assert got[4] is None or got[4] != got[4]


def _medians(rows):
    out = {}
    for k in {r[0] for r in rows}:
        a, b = ([v for x, m, v in rows if x == k and m == t and v is not None] for t in ("taxi", "bike"))
        if a and b:
            d = np.subtract.outer(np.array(b), np.array(a)).ravel()
            out[k] = tuple(float(np.median(x)) if len(x) else None for x in (d[d > 0], -d[d <= 0]))
    return out


def test_median_margins_equal_all_pairs_with_hot_bucket(spark):
    from tripkit.operators.margins import median_margins
    rnd = random.Random(11)
    rows = [("hot" if i % 3 else None, rnd.choice(["taxi", "bike"]), round(rnd.expovariate(0.01), 1)) for i in range(900)]   # fractions
    rows += [("ties", m, float(rnd.randint(1, 9))) for m in ("taxi", "bike") for _ in range(100)]
    rows += [("tail", m, 10.0 ** rnd.randint(-3, 4) * rnd.choice([-1, 1])) for m in ("taxi", "bike") for _ in range(60)]
    rows += [("a always", "taxi", 1.0), ("a always", "bike", 5.5), ("b always", "taxi", 9.0), ("b always", "bike", 9.0),
             ("one side", "taxi", 1.0), ("no value", "taxi", None), ("no value", "bike", 2.0), ("other", "walk", 3.0)]
    df = spark.createDataFrame(rows, "k string, m string, v double").cache()
    got = {r.k: (r.median_margin_a_wins, r.median_margin_b_wins) for r in median_margins(df, ["k"], "m", "taxi", "bike", "v", min_obs=1, listed=4.0).collect()}
    assert got == _medians(rows) and len(got) == 6
    none = median_margins(df.where("false"), ["k"], "m", "taxi", "bike", "v")
    assert none.columns == ["k", "n_a", "n_b", "median_margin_a_wins", "median_margin_b_wins"] and none.count() == 0
    some = df.where("k = 'ties'")   # no dimension
    row = median_margins(some, [], "m", "taxi", "bike", "v", min_obs=100, listed=1.0).first()
    assert (row.median_margin_a_wins, row.median_margin_b_wins) == got["ties"]
