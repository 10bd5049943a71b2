"""Aggregations (inventory group F).

All are ``groupBy``/``agg`` plans: Spark runs a partial (map-side)
aggregate before the shuffle, so a hot key costs one partial row per map
task, not one row per input record.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import col_of, cols_of, names_of


def count_by(df: DataFrame, keys, out: str = "trips", where: Column | None = None) -> DataFrame:
    """COUNT(*) by keys (keys may be Columns with aliases)."""
    if where is not None:
        df = df.filter(where)
    return df.groupBy(*cols_of(keys)).agg(F.count(F.lit(1)).alias(out))


def rollup_sum(df: DataFrame, keys, value: str, out: str | None = None) -> DataFrame:
    """roll a finer rollup up to coarser keys by summing its counts."""
    return df.groupBy(*cols_of(keys)).agg(F.sum(value).alias(out or value))


def cond_sum(cond: Column, value=None, else_zero: bool = True) -> Column:
    """SUM(CASE WHEN cond THEN value [ELSE 0] END) (trap T15)."""
    v = F.lit(1) if value is None else col_of(value)
    e = F.when(cond, v)
    if else_zero:
        e = e.otherwise(F.lit(0))
    return F.sum(e)


def signed_cond_sum(pos: Column, neg: Column, value) -> Column:
    """SUM(CASE WHEN pos THEN x WHEN neg THEN -x END)."""
    v = col_of(value)
    return F.sum(F.when(pos, v).when(neg, -v))


def pivot_sum(df: DataFrame, keys, pivot: str, values: Sequence, measure: str,
              fill=None, prefix: str = "") -> DataFrame:
    """long -> wide with explicit pivot values (no extra pass to find them)."""
    out = df.groupBy(*cols_of(keys)).pivot(pivot, list(values)).agg(F.sum(measure))
    if prefix:
        out = out.select(*names_of(keys), *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])
    if fill is not None:
        out = out.fillna(fill)
    return out


def share(num: Column, den: Column) -> Column:
    """Ratio, null when the denominator is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percentiles_by(df: DataFrame, keys, c: str, ps: Sequence[float],
                   names: Sequence[str] | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """exact interpolated percentiles (percentile_cont) per group, plus
    ``extra`` aggregates. Distributed: no group's values are buffered in one
    task (see ``stats.exact_percentiles``). Keys may be aliased Columns."""
    from .stats import exact_percentiles, join_null_safe
    names = names or [f"pct{int(round(p * 100))}" for p in ps]
    kc = cols_of(keys)
    d = df.select(*kc, F.col(c).alias("_pv"))
    knames = [k for k in d.columns if k != "_pv"]
    pct = exact_percentiles(d, knames, "_pv", ps, names)
    if not extra:
        return pct
    ex = df.groupBy(*kc).agg(*extra)
    return join_null_safe(ex, pct, knames, "left")


def weighted_mean(x, w) -> Column:
    """sum(w*x)/sum(w over non-null x); all-null -> null, never NaN."""
    xc, wc = col_of(x), col_of(w)
    return F.try_divide(F.sum(wc * xc), F.sum(F.when(xc.isNotNull(), wc)).cast("double"))


def weighted_grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str],
                           weight: str, missing=-1, sums: Sequence[str] = ()) -> DataFrame:
    """GROUPING SETS with weighted means (F13) and plain sums.

    A key that some set rolls up is written as ``missing`` (not null) on the
    rolled-up rows, so real null ids stay distinguishable (trap T25). One
    Expand + partial/final aggregate: a single shuffle for all sets.
    """
    keys = list(dict.fromkeys(k for s_ in sets for k in s_))
    always = set(keys).intersection(*map(set, sets))
    rolled = [k for k in keys if k not in always]
    aggs = [weighted_mean(c, weight).alias(c) for c in cols] + [F.sum(c).alias(c) for c in sums]
    out = df.groupingSets([[F.col(k) for k in s_] for s_ in sets], *keys).agg(
        *[F.grouping(k).alias(f"_g_{k}") for k in rolled], *aggs)
    shown = [F.col(k) if k in always else F.when(F.col(f"_g_{k}") == 1, F.lit(missing)).otherwise(F.col(k)).alias(k) for k in keys]
    return out.select(*shown, *cols, *sums)


def histogram(df: DataFrame, c, width: float, keys=(), out: str = "n", offset: float = 0.0,
              bin_name: str = "bin") -> DataFrame:
    """fixed-width left-edge bins + count."""
    b = (F.floor((col_of(c) - F.lit(offset)) / F.lit(width)) * F.lit(width) + F.lit(offset)).alias(bin_name)
    return df.groupBy(*cols_of(keys), b).agg(F.count(F.lit(1)).alias(out))


def grid_density(df: DataFrame, x: str, y: str, places: int = 4, keys=(), out: str = "n") -> DataFrame:
    """round coordinates as decimals (trap T23), count per cell."""
    rx = F.round(col_of(x).cast("decimal(20,10)"), places).cast("double").alias(f"{x}_r")
    ry = F.round(col_of(y).cast("decimal(20,10)"), places).cast("double").alias(f"{y}_r")
    return df.groupBy(*cols_of(keys), rx, ry).agg(F.count(F.lit(1)).alias(out))


def allocate(df: DataFrame, map_df: DataFrame, key: str, measure: str, fraction: str,
             to: str, out: str | None = None) -> DataFrame:
    """area-weighted allocation SUM(measure * fraction) over a many-to-many map."""
    return (df.join(map_df, key)
              .groupBy(to).agg(F.sum(F.col(measure) * F.col(fraction)).alias(out or measure)))


def summary(df: DataFrame, keys, c: str) -> DataFrame:
    """max, min, n per group."""
    return df.groupBy(*cols_of(keys)).agg(F.max(c).alias(f"max_{c}"), F.min(c).alias(f"min_{c}"),
                                          F.count(F.lit(1)).alias("n"))


def group_arrays(df: DataFrame, keys, order: str, values: Sequence[str], out: str = "series") -> DataFrame:
    """collapse a group into parallel arrays sorted by ``order``.

    The group is bounded by the caller's calendar (months x modes), not by
    the trip count: call it on an aggregate, never on raw trips.
    """
    s = F.sort_array(F.collect_list(F.struct(col_of(order).alias("_o"), *[col_of(v) for v in values])))
    agg = df.groupBy(*cols_of(keys)).agg(s.alias("_s"))
    return agg.select(*names_of(keys), F.col("_s._o").alias(order),
                      *[F.col(f"_s.{v}").alias(v) for v in values])


def total(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """aggregate without grouping."""
    return df.agg(*aggs)


def and_all(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


# ---------------------------------------------------------------------------
# distinct counts that merge
# ---------------------------------------------------------------------------

def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct integers per key as bitmaps of 32,768 neighbouring values: (keys, bucket, bitmap).

    Stored by day they merge to any longer period without going back to the facts; nulls do not count.
    Values should be dense (ids): a bitmap has 4 KB however few bits are set.
    """
    v = F.col(value)
    return (df.where(v.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(v).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser keys (e.g. days to weeks)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Exact distinct counts per key; keys may be coarser than those of ``bitmaps``."""
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(out))
