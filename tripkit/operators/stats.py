"""Statistical operators (inventory group K).

K2/K3 add a regression's cross-products up per combination of factor levels.
K5 (pairwise win rate) is exact and never forms the cross product: each
bucket is reduced to (value, n_a, n_b) counts, and P(a < b) is
sum_v n_a(v) * #{b > v} / (N_a N_b), with #{b > v} from a cumulative sum.
The cumulative sum (``split_cumsum``) splits every group into quantile
sub-ranges first, so a hot bucket is spread over many window partitions.
"""

from __future__ import annotations

import math
import sys as _sys
from typing import Sequence

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions._util import col_of, names_of
from .rollups import weighted_mean

# The one function below that runs in Python workers is shipped by value with this module.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


# ---------------------------------------------------------------------------
# K1: simple OLS by SQL aggregates
# ---------------------------------------------------------------------------

def ols(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """K1: y ~ x -> slope, intercept, r2, n, residual SE, slope and intercept SE, slope t.

    Pure aggregates (regr_*): one partial + final aggregate, no model object.
    """
    g = df.groupBy(*keys) if keys else df.groupBy()
    res = g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
                F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_avgx(y, x).alias("mx"))
    sse = F.col("syy") * (F.lit(1.0) - F.col("r2"))
    sigma = F.sqrt(F.try_divide(sse, (F.col("n") - 2).cast("double")))
    se_slope = F.try_divide(sigma, F.sqrt(F.col("sxx")))
    se_intercept = sigma * F.sqrt(F.try_divide(F.lit(1.0), F.col("n").cast("double"))
                                  + F.try_divide(F.col("mx") * F.col("mx"), F.col("sxx")))
    return res.select(*keys, "slope", "intercept", "r2", "n",
                      sigma.alias("residual_se"), se_slope.alias("slope_se"), se_intercept.alias("intercept_se"),
                      F.try_divide(F.col("slope"), se_slope).alias("slope_t"))


# ---------------------------------------------------------------------------
# K2-K4: weighted multi-factor OLS with explicit baselines
# ---------------------------------------------------------------------------

def _t_tail(t: float, df: float) -> float:
    """Two-sided p-value of Student's t, by the incomplete beta function's continued fraction."""
    x, a, b = df / (df + t * t), df / 2, 0.5

    def fraction(x, a, b):
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / d if abs(d) > 1e-300 else 1e300
        h = d
        for m in range(1, 500):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 + num * d, 1 + num / c
                d = 1 / d if abs(d) > 1e-300 else 1e300
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h

    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * fraction(x, a, b) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(1 - x, b, a) / b


def with_p_value(fits: DataFrame, t: str = "slope_t", n: str = "n", terms: int = 2, out: str = "p_value") -> DataFrame:
    """K1: two-sided p-value of a t statistic with n - terms degrees of freedom, for a table of
    fits (a row per regression)."""
    def run(batches):
        for pdf in batches:
            ok = pdf[t].notna() & (pdf[n] > terms)
            pdf[out] = [_t_tail(float(a), float(b - terms)) if c else None for a, b, c in zip(pdf[t], pdf[n], ok)]
            yield pdf.astype({out: "float64"})

    return fits.mapInPandas(run, StructType([*fits.schema.fields, StructField(out, DoubleType())]))


def cross_products(df: DataFrame, y: Column, numeric: dict, factors: dict, weight: str) -> DataFrame:
    """Weighted cross-products (i, j, v), i <= j, of a design matrix with terms in the order intercept, numeric,
    factor levels but the first, y. Three rows with i = -1 count the rows used, dropped for nulls, and with
    a factor value outside its levels.

    Rows are added up per combination of factor levels first, with a few native sums (products of intercept,
    numeric terms and y); a combination then yields the products of its own few non-zero terms only. So no
    row is expanded, and what is shuffled is bounded by the combinations.
    """
    base = [F.lit(1.0), *[c.cast("double") for c in numeric.values()], y.cast("double")]
    names = [f"_x{i}" for i in range(len(base))]
    whole, bad, at, first = F.col(weight).isNotNull(), F.lit(False), [], len(numeric) + 1
    for f, levels in factors.items():
        value = F.col(f).cast("string")
        place = F.array_position(F.array(*[F.lit(str(v)) for v in levels]), value)
        bad = bad | (value.isNotNull() & (place == 0))
        whole = whole & value.isNotNull()
        at.append(F.when(place >= 2, place.cast("int") + (first - 2)).alias(f"_f{len(at)}"))
        first += len(levels) - 1
    for c in base[1:]:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    y_at, places = first, [f"_f{i}" for i in range(len(at))]
    rows = df.select(*[c.alias(n) for c, n in zip(base, names)], F.col(weight).cast("double").alias("_w"), *at,
                     whole.alias("_whole"), F.coalesce(bad, F.lit(False)).alias("_bad"))
    pairs = [(i, j) for i in range(len(base)) for j in range(i, len(base))]
    cells = rows.groupBy(*places).agg(
        *[F.sum(F.when(F.col("_whole"), F.col("_w") * F.col(names[i]) * F.col(names[j]))).alias(f"_s{i}_{j}") for i, j in pairs],
        F.count_if("_whole").alias("_used"), F.count_if(~F.col("_whole")).alias("_dropped"), F.count_if("_bad").alias("_n_bad"))

    def entry(i: Column, j: Column, v: str):
        return F.struct(F.least(i, j).alias("i"), F.greatest(i, j).alias("j"), F.col(v).alias("v"))

    own = [F.lit(i) for i in range(len(base) - 1)] + [F.lit(y_at)]
    entries = [entry(own[i], own[j], f"_s{i}_{j}") for i, j in pairs]
    for k, p in enumerate(places):
        entries += [F.when(F.col(p).isNotNull(), entry(F.col(p), own[i], f"_s0_{i}")) for i in range(len(base))]
        entries += [F.when(F.col(p).isNotNull() & F.col(q).isNotNull(), entry(F.col(p), F.col(q), "_s0_0")) for q in places[k:]]
    entries += [F.struct(F.lit(-1).alias("i"), F.lit(n).alias("j"), F.col(c).cast("double").alias("v"))
                for n, c in enumerate(("_used", "_dropped", "_n_bad"))]
    return cells.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.i", "e.j").agg(F.sum("e.v").alias("v"))


def weighted_ols(df: DataFrame, y: Column, numeric: dict, factors: dict, weight: str):
    """K2/K3: weighted least squares from weighted cross-products.

    ``numeric``: name -> Column (e.g. sqrt(distance)); ``factors``: column ->
    ordered levels (first = baseline). The k x k cross-products (k terms, see
    ``cross_products``) are solved on the driver. A term that the
    earlier ones determine (R marks it aliased) stays as a row with a null
    estimate. A factor value outside its levels is an error. Returns
    (coefficients DataFrame, info: rows used and dropped for nulls).
    """
    import numpy as np
    names = ["(Intercept)", *numeric, *[f"{f}{v}" for f, levels in factors.items() for v in levels[1:]]]
    k = len(names)
    m = np.zeros((k + 1, k + 1))
    info = [0.0, 0.0, 0.0]
    for r in cross_products(df, y, numeric, factors, weight).collect():
        if r["i"] < 0:
            info[r["j"]] = r["v"]
        elif r["v"] is not None:
            m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    used, dropped, n_bad = info
    if n_bad:
        raise ValueError(f"{int(n_bad)} rows have a factor value outside the given levels")
    own, inv, kept = m.diagonal().copy(), m.copy(), []
    for j in range(k):  # sweep: afterwards the kept block holds minus the inverse, its last column the estimates
        if own[j] > 0 and inv[j, j] > 1e-9 * own[j]:
            p = inv[j, j]
            row, col = inv[j] / p, inv[:, j].copy()
            inv -= np.outer(col, row)
            inv[j], inv[:, j] = row, col / p
            inv[j, j] = -1 / p
            kept.append(j)
    left = int(used) - len(kept)
    sigma2 = max(0.0, inv[k, k]) / left if left > 0 else None
    out = []
    for j in [*range(1, k), 0]:
        if j not in kept:
            out.append((names[j], None, None, None, None))
            continue
        se = float((sigma2 * -inv[j, j]) ** 0.5) if sigma2 is not None and inv[j, j] < 0 else None
        est = float(inv[j, k])
        t = est / se if se else None
        out.append((names[j], est, se, t, None if t is None else float(_t_tail(t, left))))
    coef = df.sparkSession.createDataFrame(out, "term string, estimate double, std_error double, t_value double, p_value double")
    return coef, {"rows": int(used), "dropped": int(dropped)}


def multipliers(coef: DataFrame, prefix: str, baseline: str) -> DataFrame:
    """exp(estimate) for the terms of one factor (matched by name
    prefix), plus its baseline row at 1.0."""
    f = (coef.filter(F.col("term").startswith(prefix))
             .select(F.regexp_replace("term", f"^{prefix}", "").alias("level"),
                     F.exp("estimate").alias("multiplier")))
    base = coef.sparkSession.createDataFrame([(baseline, 1.0)], "level string, multiplier double")
    return f.unionByName(base)


# ---------------------------------------------------------------------------
# skew-safe cumulative sums
# ---------------------------------------------------------------------------

def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating null = null (group keys may be null)."""
    keys = list(keys)
    if not keys:
        return left.crossJoin(right) if how == "inner" else left.join(right, how=how)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


#: Rows aimed at in one sub-range of a cumulative sum, and the most sub-ranges.
ROWS_PER_RANGE, MAX_RANGES = 20_000, 1024


def range_cuts(df: DataFrame, order: str, splits: int | None = None) -> list[float]:
    """Approximate quantiles of ``order`` that cut it into ``splits`` sub-ranges, by default one for
    every ``ROWS_PER_RANGE`` rows. One job; at most ``MAX_RANGES`` numbers reach the driver."""
    qs = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
    n, got = df.agg(F.count(F.lit(1)), F.percentile_approx(F.col(order).cast("double"), qs, 4 * MAX_RANGES)).first()
    splits = min(MAX_RANGES, splits or -(-n // ROWS_PER_RANGE))
    if splits < 2 or not got:
        return []
    return sorted({got[i * MAX_RANGES // splits - 1] for i in range(1, splits)})


def sub_range(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, looked up in two levels."""
    step = max(1, math.isqrt(len(cuts)))

    def below(among: Column) -> Column:
        return F.size(F.filter(among, lambda s: s < value))

    whole, coarse = (F.array(*map(F.lit, x)).cast("array<double>") for x in (list(cuts), list(cuts[step - 1::step])))
    first = below(coarse)
    return (first * step + below(F.slice(whole, first * step + 1, F.lit(step)))) if cuts else F.lit(0)


def split_cumsum(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], splits: int | None = None,
                 inclusive: bool = True, ties: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """Running sums and totals of ``cols`` within ``keys`` ordered by ``order``, then ``ties`` (unique per
    key, but for rows that add nothing).

    The range of ``order`` is cut into sub-ranges at its approximate quantiles (``range_cuts``, or
    ``cuts`` as given). Totals of a key and of its earlier sub-ranges come from windows over one
    row per (key, sub-range); the in-range
    running sum is a window partitioned by (key, sub-range), which is also how the
    totals are joined, so a hot key spreads over many tasks and each row is
    shuffled once. Exact: the quantiles only decide where to cut. Adds ``cum_<c>``
    and ``tot_<c>``. Keys are compared as one struct, in which null equals null.
    """
    keys = list(keys)
    cuts = range_cuts(df, order, splits) if cuts is None else cuts
    d = df.withColumn("_ckey", F.struct(*keys) if keys else F.lit(0)).withColumn("_crange", sub_range(F.col(order).cast("double"), cuts))
    sub = d.groupBy("_ckey", "_crange").agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    whole = Window.partitionBy("_ckey")
    before = whole.orderBy("_crange").rowsBetween(Window.unboundedPreceding, -1)
    sub = sub.select("_ckey", "_crange", *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in cols],
                     *[F.sum(f"_s_{c}").over(whole).alias(f"tot_{c}") for c in cols])
    hi = 0 if inclusive else -1
    inside = Window.partitionBy("_ckey", "_crange").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, hi)
    d = d.join(sub, ["_ckey", "_crange"])
    return d.select(*df.columns, *[(F.col(f"_b_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"cum_{c}") for c in cols],
                    *[f"tot_{c}" for c in cols])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value, ps: Sequence[float],
                      names: Sequence[str], splits: int | None = None, materialise: bool = True) -> DataFrame:
    """Exact interpolated percentiles (percentile_cont) per group,
    without buffering a group's values in one task.

    Values are counted per (group, value) (partial aggregation), ranked with
    the skew-safe cumulative count, and for each p the values at ranks
    floor((n-1)p) and ceil((n-1)p) are picked and interpolated. Returns
    keys + one column per name; groups without non-null values are absent.
    """
    keys = list(keys)
    v = value if not isinstance(value, str) else F.col(value)
    vc = df.filter(v.isNotNull()).groupBy(*keys, v.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    vc = _materialise(vc, materialise)
    cum = split_cumsum(vc, keys, "_v", ["_n"], splits=splits, inclusive=False)
    j = cum.withColumnRenamed("tot__n", "_tot")
    sel = []
    for i, p in enumerate(ps):
        pos = (F.col("_tot") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        in_lo = (F.col("cum__n") <= lo) & (lo < F.col("cum__n") + F.col("_n"))
        in_hi = (F.col("cum__n") <= hi) & (hi < F.col("cum__n") + F.col("_n"))
        sel += [F.when(in_lo, F.col("_v")).alias(f"_lo{i}"), F.when(in_hi, F.col("_v")).alias(f"_hi{i}"),
                pos.alias(f"_pos{i}")]
    hit = None
    for i in range(len(ps)):
        h = F.col(f"_lo{i}").isNotNull() | F.col(f"_hi{i}").isNotNull()
        hit = h if hit is None else hit | h
    rows = j.select(*keys, *sel).filter(hit)
    agg = rows.groupBy(*keys).agg(*[F.max(f"_lo{i}").alias(f"_lo{i}") for i in range(len(ps))],
                                  *[F.max(f"_hi{i}").alias(f"_hi{i}") for i in range(len(ps))],
                                  *[F.max(f"_pos{i}").alias(f"_pos{i}") for i in range(len(ps))])
    out = []
    for i, n in enumerate(names):
        lo, hi, pos = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_pos{i}")
        fl = F.floor(pos)
        out.append(F.when(F.ceil(pos) == fl, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - fl) * hi).alias(n))
    return agg.select(*keys, *out)


# ---------------------------------------------------------------------------
# K5, K7, K8: exact win rate, margins, per-mode summaries
# ---------------------------------------------------------------------------

def value_counts(df: DataFrame, dims, mode, a, b, value) -> DataFrame:
    """Trips of either mode per (bucket, value): every later step works on these counts."""
    v = col_of(value)
    m = col_of(mode)
    return (df.filter(v.isNotNull() & m.isin(a, b))
              .groupBy(*dims, v.alias("_v"))
              .agg(F.count_if(m == a).cast("double").alias("na"),
                   F.count_if(m == b).cast("double").alias("nb")))


def _materialise(df: DataFrame, on: bool) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``: the
    (bucket, value) count table feeds several branches (totals, quantile
    bounds, windows), so it is computed once instead of re-scanning the facts
    per branch; it also cuts lineage, so a lost executor does not replay the
    fact scan."""
    if not on:
        return df
    from ..session import cut_lineage
    return cut_lineage(df)


def win_rate(df: DataFrame, dims: Sequence[str], mode: str, a, b, value: str,
             min_obs: int = 5, splits: int | None = None, materialise: bool = True) -> DataFrame:
    """K5/K7/K8: exact P(a < b) over all (a, b) pairs of each bucket (strict: ties are not wins).
    E11 re-aimed: the sampled self-join of pairs is replaced by this exact count.

    Output per bucket: n_a, n_b, win_rate, mean margins by winner (null when a
    side never wins; as in the sampled version, a pair that ``a`` does not
    win, ties included, counts for ``b``), mean values. Buckets need >=
    ``min_obs`` of each side.
    """
    dims = names_of(dims)
    vc = _materialise(value_counts(df, dims, mode, a, b, value), materialise)
    # Durations relative to the bucket's mean, summed from the top: no difference of two large totals.
    centre = vc.groupBy(F.struct(*dims).alias("_key") if dims else F.lit(0).alias("_key")).agg(
        (F.sum((F.col("na") + F.col("nb")) * F.col("_v")) / F.sum(F.col("na") + F.col("nb"))).alias("_c"))
    vc = vc.withColumn("_key", F.struct(*dims) if dims else F.lit(0)).join(centre, "_key").drop("_key")
    vc = vc.withColumn("_d", F.col("_v") - F.col("_c")).withColumn("_down", -F.col("_v"))
    vc = vc.withColumn("sa", F.col("na") * F.col("_d")).withColumn("sb", F.col("nb") * F.col("_d"))
    cum = split_cumsum(vc, dims, "_down", ["na", "nb", "sa", "sb"], splits=splits, inclusive=False)
    cum = cum.withColumnsRenamed({"tot_na": "N_a", "tot_nb": "N_b", "tot_sa": "S_a", "tot_sb": "S_b"})
    cum = cum.filter((F.col("N_a") >= min_obs) & (F.col("N_b") >= min_obs))
    # cum_<c> holds the values strictly greater than this one.
    per_v = cum.select(
        *dims, "N_a", "N_b", (F.col("S_a") + F.col("N_a") * F.col("_c")).alias("S_a"), (F.col("S_b") + F.col("N_b") * F.col("_c")).alias("S_b"),
        (F.col("na") * F.col("cum_nb")).alias("a_wins"),
        (F.col("na") * (F.col("cum_sb") - F.col("_d") * F.col("cum_nb"))).alias("a_margin"),
        (F.col("nb") * (F.col("cum_sa") - F.col("_d") * F.col("cum_na"))).alias("b_margin"))
    res = per_v.groupBy(*dims).agg(
        F.first("N_a").alias("N_a"), F.first("N_b").alias("N_b"),
        F.first("S_a").alias("S_a"), F.first("S_b").alias("S_b"),
        F.sum("a_wins").alias("a_wins"), F.sum("a_margin").alias("a_margin"), F.sum("b_margin").alias("b_margin"))
    return res.select(
        *dims,
        F.col("N_a").cast("bigint").alias("n_a"), F.col("N_b").cast("bigint").alias("n_b"),
        (F.col("a_wins") / (F.col("N_a") * F.col("N_b"))).alias("win_rate"),
        F.try_divide(F.col("a_margin"), F.col("a_wins")).alias("mean_margin_a_wins"),
        F.try_divide(F.col("b_margin"), F.col("N_a") * F.col("N_b") - F.col("a_wins")).alias("mean_margin_b_wins"),
        (F.col("S_a") / F.col("N_a")).alias("mean_a"), (F.col("S_b") / F.col("N_b")).alias("mean_b"))


def medians_by_mode(df: DataFrame, dims: Sequence[str], mode: str, a, b, value: str) -> DataFrame:
    """K8: per-bucket mean and exact median by mode (distributed exact median)."""
    m, v = F.col(mode), F.col(value)
    d = df.filter(m.isin(a, b))
    means = d.groupBy(*dims).agg(F.avg(F.when(m == a, v)).alias("mean_a"), F.avg(F.when(m == b, v)).alias("mean_b"))
    med = exact_percentiles(d, [*dims, mode], value, [0.5], ["median"])
    ma = med.filter(F.col(mode) == a).select(*dims, F.col("median").alias("median_a"))
    mb = med.filter(F.col(mode) == b).select(*dims, F.col("median").alias("median_b"))
    return join_null_safe(join_null_safe(means, ma, dims, "left"), mb, dims, "left")


# ---------------------------------------------------------------------------
# K6: seeded bootstrap of pairs
# ---------------------------------------------------------------------------

def bootstrap_pairs(df: DataFrame, dims: Sequence[str], mode: str, a, b, value: str,
                    n: int = 10_000, seed: int = 1, min_obs: int = 5, splits: int | None = None,
                    materialise: bool = True) -> DataFrame:
    """K6: n draws per bucket of (a value, b value), each side drawn uniformly
    with replacement. Deterministic for a seed (MD5 of seed, bucket, draw,
    side, which other engines can compute too).

    A draw is a rank among the bucket's sorted values. Ranks are cut into
    ``splits`` equal blocks per (bucket, side); counted values (never expanded to
    rows) and draws are ordered by rank inside their block, and a draw takes the
    last value at or before it. ``splits`` follows the rows unless given. Returns (dims..., draw, va, vb).
    """
    dims = names_of(dims)
    vc = _materialise(value_counts(df, dims, mode, a, b, value), materialise)
    splits = splits or min(MAX_RANGES, max(32, -(-vc.count() // ROWS_PER_RANGE)))
    cum = split_cumsum(vc, dims, "_v", ["na", "nb"], splits=splits, inclusive=False)
    cum = cum.filter((F.col("tot_na") >= min_obs) & (F.col("tot_nb") >= min_obs))
    side = F.explode(F.array(*[F.struct(F.lit(t).alias("side"), F.col(f"n{t}").cast("bigint").alias("n"),
                                        F.col(f"cum_n{t}").cast("bigint").alias("pos"),
                                        F.col(f"tot_n{t}").cast("bigint").alias("tot")) for t in "ab"]))
    key = F.struct(*dims) if dims else F.lit(0)
    values = cum.select(key.alias("_k"), "_v", side.alias("s")).select("_k", "_v", "s.*").filter("n > 0")
    size = F.ceil(F.col("tot") / splits)
    values = values.withColumn("size", size).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("pos") / F.col("size")), F.floor((F.col("pos") + F.col("n") - 1) / F.col("size")))))
    values = values.select("_k", "side", "block", F.greatest(F.col("pos"), F.col("block") * F.col("size")).alias("pos"), "_v",
                           F.lit(None).cast("int").alias("draw"))
    tot = vc.groupBy(*dims).agg(*[F.sum(f"n{t}").cast("bigint").alias(f"tot_{t}") for t in "ab"])
    tot = tot.filter((F.col("tot_a") >= min_obs) & (F.col("tot_b") >= min_obs))
    text = [F.coalesce(F.col(d).cast("string"), F.lit("~")) for d in dims]

    def rank(t):
        seeded = F.concat_ws("|", F.lit(str(seed)), *text, F.col("draw").cast("string"), F.lit(t))
        return F.struct(F.lit(t).alias("side"), F.pmod(F.conv(F.substring(F.md5(seeded), 1, 15), 16, 10).cast("long"), F.col(f"tot_{t}")).alias("pos"),
                        F.ceil(F.col(f"tot_{t}") / splits).alias("size"))

    draws = tot.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n))))
    draws = draws.select(key.alias("_k"), "draw", F.explode(F.array(rank("a"), rank("b"))).alias("s")).select(
        "_k", "s.side", F.floor(F.col("s.pos") / F.col("s.size")).alias("block"), "s.pos", F.lit(None).cast("double").alias("_v"), "draw")
    order = Window.partitionBy("_k", "side", "block").orderBy("pos", F.col("draw").asc_nulls_first())
    met = (values.withColumn("_v", F.col("_v").cast("double")).unionByName(draws)
           .withColumn("v", F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
           .filter(F.col("draw").isNotNull()))
    pairs = met.groupBy("_k", "draw").agg(*[F.max(F.when(F.col("side") == t, F.col("v"))).alias(f"v{t}") for t in "ab"])
    return pairs.select(*[F.col("_k")[d].alias(d) for d in dims], "draw", "va", "vb")


def winning_margins(draws: DataFrame, dims: Sequence[str]) -> DataFrame:
    """K7 over bootstrap draws: sampled win rate, mean and median margin by winner.
    A bucket holds exactly ``n`` draws (a parameter), so the median buffers a
    bounded group."""
    d = draws.withColumn("_diff", F.col("vb") - F.col("va"))
    return d.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("draws"),
        F.avg((F.col("va") < F.col("vb")).cast("double")).alias("sampled_win_rate"),
        F.avg(F.when(F.col("_diff") > 0, F.col("_diff"))).alias("mean_margin_a_wins"),
        F.median(F.when(F.col("_diff") > 0, F.col("_diff"))).alias("median_margin_a_wins"),
        F.avg(F.when(F.col("_diff") <= 0, -F.col("_diff"))).alias("mean_margin_b_wins"),
        F.median(F.when(F.col("_diff") <= 0, -F.col("_diff"))).alias("median_margin_b_wins"))


def compare(df: DataFrame, dims: Sequence[str], mode: str, a, b, value: str,
            filters: Sequence[Column] = (), min_obs: int = 5) -> DataFrame:
    """K9: parameterised comparison: caller's dimensions and filters, exact K5."""
    from .relational import where_all
    return win_rate(where_all(df, list(filters)), dims, mode, a, b, value, min_obs=min_obs)


def weighted_rate(df: DataFrame, keys, rate: str, weight: str, out: str = "weighted_rate") -> DataFrame:
    """Trip-weighted aggregation of per-bucket rates."""
    return df.groupBy(*names_of(keys)).agg(weighted_mean(rate, weight).alias(out),
                                           F.sum(weight).alias(weight))
