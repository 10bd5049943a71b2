"""Series and window operators (inventory group G).

Windows here partition by a *series key* over *aggregated* rows (one row per
key and period), so a partition holds at most one row per calendar period —
bounded by the calendar, not by the trip count. Raw trips are never windowed.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import cols_of, names_of


def _w(keys, order):
    return Window.partitionBy(*cols_of(keys)).orderBy(*cols_of(order))


def densify(df: DataFrame, keys: Sequence[str], date: str, value_cols: Sequence[str],
            start=None, end=None, step: str = "1 day", fill=0,
            key_domain: DataFrame | None = None) -> DataFrame:
    """complete(date, keys, fill): every key gets every period in [start, end].

    ``start``/``end`` default to the data's own min/max (uncorrelated scalar
    subqueries, no driver round trip). The key domain defaults to the keys
    present. Each key row is expanded with ``explode(sequence(...))`` — a
    generator, not a cross join — then left-joined to the data.
    """
    lo = F.lit(start).cast("date") if start is not None else df.agg(F.min(date)).scalar()
    hi = F.lit(end).cast("date") if end is not None else df.agg(F.max(date)).scalar()
    dom = key_domain if key_domain is not None else df.select(*keys).distinct()
    grid = dom.select(*keys, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))).alias(date))
    out = grid.join(df, [*keys, date], "left")
    return out.fillna(fill, subset=list(value_cols)) if fill is not None else out


def rolling(df: DataFrame, keys, order, c: str, k: int, fn: str = "sum",
            out: str | None = None) -> DataFrame:
    """Right-aligned rolling sum/mean over k rows; null until k rows (trap T14)."""
    w = _w(keys, order).rowsBetween(-(k - 1), 0)
    agg = F.sum(c) if fn == "sum" else F.avg(c)
    return df.withColumn(out or f"{fn}_{k}",
                         F.when(F.count(F.lit(1)).over(w) == k, agg.over(w)))


def lag_diff(df: DataFrame, keys, order, c: str, n: int, out: str | None = None) -> DataFrame:
    """X - lag(x, n)."""
    return df.withColumn(out or f"{c}_diff_{n}", F.col(c) - F.lag(c, n).over(_w(keys, order)))


def lag_ratio(df: DataFrame, keys, order, c: str, n: int, out: str | None = None) -> DataFrame:
    """X / lag(x, n) - 1 (year-over-year when n = 12 monthly rows)."""
    prev = F.lag(c, n).over(_w(keys, order))
    return df.withColumn(out or f"{c}_yoy", F.try_divide(F.col(c).cast("double"), prev.cast("double")) - 1)


def share_within(df: DataFrame, keys, c: str, out: str | None = None) -> DataFrame:
    """X / sum(x) within keys (nulls ignored in the denominator, trap T17)."""
    tot = F.sum(c).over(Window.partitionBy(*cols_of(keys)))
    return df.withColumn(out or f"{c}_share", F.try_divide(F.col(c).cast("double"), tot.cast("double")))


def share_of_row(df: DataFrame, keys, c: str, is_total: Column, out: str | None = None) -> DataFrame:
    """X / sum(x * is_total) within keys (share versus a designated row)."""
    den = F.sum(F.when(is_total, F.col(c)).otherwise(F.lit(0))).over(Window.partitionBy(*cols_of(keys)))
    return df.withColumn(out or f"{c}_frac", F.try_divide(F.col(c).cast("double"), den.cast("double")))


def impute_from_peers(df: DataFrame, series_keys: Sequence[str], date: str, geo: str,
                      measure: str, peer_col: str, peers: Sequence, targets: Sequence,
                      total_geo: str = "total", out_flag: str = "is_estimated") -> DataFrame:
    """Estimate targets' per-geography values from the peers' geography shares.

    frac(date, geo) = sum_peers(x at geo) / sum_peers(x at geo == total); then
    for a target row outside ``total_geo``: x = x(target, date, total) * frac.
    All three sums are windows over the same rows (partitions: (date, geo),
    date, (series, date) -- each holds one row per series and geography), so
    the input is read once and never joined to itself.
    """
    peer_x = F.when(F.col(peer_col).isin(*peers), F.col(measure))
    num = F.sum(peer_x).over(Window.partitionBy(date, geo))
    den = F.sum(F.when(F.col(geo) == total_geo, peer_x).otherwise(F.lit(0))).over(Window.partitionBy(date))
    frac = F.try_divide(num.cast("double"), den.cast("double"))
    tot = F.sum(F.when(F.col(geo) == total_geo, F.col(measure)).otherwise(F.lit(0))).over(
        Window.partitionBy(*cols_of(series_keys), date))
    is_target = F.col(peer_col).isin(*targets) & (F.col(geo) != total_geo)
    return (df.withColumn("_frac", frac)
              .withColumn(measure, F.when(is_target, tot * F.col("_frac")).otherwise(F.col(measure)))
              .withColumn(out_flag, is_target)
              .drop("_frac"))


def delay_vs_median(df: DataFrame, keys, cols: Sequence[str], thresholds: Sequence[float] = (300, 600)) -> DataFrame:
    """How often each column is at least t above its group's median, over
    all groups, and the first column's count over the second's per threshold.

    Rows are aggregates (one per group and period), so a group's median buffers
    no more than the calendar; one window, no self-join.
    """
    w = Window.partitionBy(*cols_of(keys))
    d = df.select(*[(F.col(c) - F.median(c).over(w)).alias(c) for c in cols])
    counts = d.agg(*[F.count_if(F.col(c) >= F.lit(t)).alias(f"{c}_over_{int(t)}") for t in thresholds for c in cols])
    if len(cols) > 1:
        counts = counts.withColumns({f"ratio_{int(t)}": F.try_divide(F.col(f"{cols[0]}_over_{int(t)}").cast("double"),
                                                                     F.col(f"{cols[1]}_over_{int(t)}").cast("double")) for t in thresholds})
    return counts


def latest_per(df: DataFrame, keys, date: str) -> DataFrame:
    """Rows whose date equals the max date of their key: one window over the
    series (a row per period), so the input is evaluated once."""
    last = F.max(date).over(Window.partitionBy(*cols_of(keys)))
    return df.withColumn("_last", last).filter(F.col(date) == F.col("_last")).drop("_last")


def top_k(df: DataFrame, keys, c: str, k: int, ascending: bool = False, out: str = "rank") -> DataFrame:
    """H4: top-k (or bottom-k) per group keeping ties (rank, trap T27).

    Without keys, the k-th value is found by a distributed take-ordered
    (partial top-k per partition); ranks come from the counts of the at most k
    values at or beyond it, joined back, so no task sees all rows or all ties.
    """
    o = F.col(c).asc() if ascending else F.col(c).desc()
    keys = names_of(keys)
    if not keys:
        kth_rows = df.select(c).filter(F.col(c).isNotNull()).orderBy(o).limit(k)
        kth = (kth_rows.agg(F.max(c)) if ascending else kth_rows.agg(F.min(c))).scalar()
        near = df.filter(F.col(c) <= kth) if ascending else df.filter(F.col(c) >= kth)
        earlier = Window.orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
        ranks = near.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).select(
            F.col(c).alias("_c"), (1 + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).cast("int").alias(out))
        return near.join(F.broadcast(ranks), F.col(c) == F.col("_c")).drop("_c")
    w = Window.partitionBy(*cols_of(keys)).orderBy(o)
    return df.withColumn(out, F.rank().over(w)).filter(F.col(out) <= k)
