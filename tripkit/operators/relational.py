"""Predicates, joins and set operations (inventory groups D, E, H).

Dimension joins: a table whose row count is fixed by construction (zones,
nations, literal seed tables) may be broadcast explicitly via ``lookup(...,
broadcast=True)``; everything else is left to Catalyst/AQE, which broadcast
only under ``spark.sql.autoBroadcastJoinThreshold`` (a size check) and fall
back to a shuffle join above it.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import col_of, names_of


def where_all(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """AND of a caller-supplied list of predicates."""
    if not predicates:
        return df
    return df.filter(reduce(lambda a, b: a & b, predicates))


def in_set(df: DataFrame, c: str, keys_df: DataFrame, key: str | None = None) -> DataFrame:
    """C IN (subquery) -> left semi join (broadcast when the key side is small)."""
    key = key or c
    return df.join(keys_df.select(F.col(key).alias("_k")), F.col(c) == F.col("_k"), "left_semi")


def not_in_set(df: DataFrame, c: str, keys_df: DataFrame, key: str | None = None,
               keys_not_null: bool = False) -> DataFrame:
    """C NOT IN (subquery) with SQL null semantics (trap T8): a null in the
    subquery empties the result, a null probe qualifies only against no keys.

    A plain anti join on the non-null keys (Spark broadcasts them only while
    they are small, else shuffles) plus two scalar counts; with
    ``keys_not_null=True`` the caller vouches for a null-free, non-empty key column.
    """
    key = key or c
    keys = keys_df.select(F.col(key).alias("_k"))
    rest = df.join(keys.filter(F.col("_k").isNotNull()), F.col(c) == F.col("_k"), "left_anti")
    if keys_not_null:
        return rest.filter(F.col(c).isNotNull())
    n, nulls = keys.agg(F.count(F.lit(1))).scalar(), keys.agg(F.count_if(F.col("_k").isNull())).scalar()
    return rest.filter((n == 0) | (F.col(c).isNotNull() & (nulls == 0)))


def flag_in_set(df: DataFrame, c: str, keys_df: DataFrame, out: str, key: str | None = None) -> DataFrame:
    """IN (subquery) used as a value: left join to distinct keys + boolean flag."""
    key = key or c
    k = keys_df.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (df.join(k, F.col(c) == F.col("_k"), "left")
              .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False)))
              .drop("_k", "_hit"))


def available_since(df: DataFrame, key: str, date: str, starts_df: DataFrame,
                    start_col: str = "start_date") -> DataFrame:
    """Per-category start-date filter via a join to a (small) start table."""
    return df.join(starts_df, key, "inner").filter(F.col(date) >= F.col(start_col)).drop(start_col)


def seen_before(df: DataFrame, a: str, b: str, date: str, cutoff) -> DataFrame:
    """Keep rows whose ``a`` and ``b`` both occur in rows dated before ``cutoff``."""
    early = df.filter(F.col(date) < F.lit(cutoff))
    za = early.select(F.col(a).alias("_z"))
    zb = early.select(F.col(b).alias("_z"))
    zones = za.union(zb).distinct()
    return (df.join(zones, F.col(a) == F.col("_z"), "left_semi")
              .join(zones, F.col(b) == F.col("_z"), "left_semi"))


def key_domain(spark, lo: int, hi: int, exclude: Sequence[int] = (), name: str = "id") -> DataFrame:
    """Valid-id domain as a DataFrame (sequence minus exclusions)."""
    arr = F.array_except(F.sequence(F.lit(lo), F.lit(hi)), F.array(*[F.lit(x) for x in exclude])) \
        if exclude else F.sequence(F.lit(lo), F.lit(hi))
    return spark.range(1).select(F.explode(arr).alias(name))


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "left", broadcast: bool = False,
           prefix: str | None = None, dim_key: str | None = None) -> DataFrame:
    """Fact x dimension. ``broadcast=True`` only for fixed-size dimensions."""
    d = F.broadcast(dim) if broadcast else dim
    if prefix is not None:
        d = d.select(*[F.col(c).alias(f"{prefix}{c}") for c in dim.columns])
        dim_key = f"{prefix}{dim_key or on}"
        return df.join(d, F.col(on) == F.col(dim_key), how)
    if dim_key is not None:
        return df.join(d, F.col(on) == F.col(dim_key), how)
    return df.join(d, on, how)


def lookup_twice(df: DataFrame, dim: DataFrame, key: str, on1: str, on2: str,
                 attrs: Sequence[str], p1: str, p2: str, broadcast: bool = False) -> DataFrame:
    """E5: role-playing dimension joined twice (pickup and dropoff)."""
    d = F.broadcast(dim) if broadcast else dim
    d1 = d.select(F.col(key).alias("_k1"), *[F.col(a).alias(f"{p1}{a}") for a in attrs])
    d2 = d.select(F.col(key).alias("_k2"), *[F.col(a).alias(f"{p2}{a}") for a in attrs])
    return (df.join(d1, F.col(on1) == F.col("_k1"), "left").drop("_k1")
              .join(d2, F.col(on2) == F.col("_k2"), "left").drop("_k2"))


def join_by_day(df: DataFrame, ts: str, daily: DataFrame, date: str = "date", how: str = "inner") -> DataFrame:
    """Join on the derived key date(ts) = daily.date."""
    return df.withColumn("_d", F.to_date(ts)).join(
        daily.withColumnRenamed(date, "_d"), "_d", how).withColumnRenamed("_d", date)


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column name."""
    shared = [c for c in a.columns if c in set(b.columns)]
    return a.join(b, shared, how)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """H5: SQL UNION (de-duplicating)."""
    return reduce(lambda x, y: x.unionByName(y), dfs).distinct()


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """H6/H7: UNION ALL / row-bind by name."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=allow_missing), dfs)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "key",
            val: str = "value") -> DataFrame:
    """H8: wide -> long (gather)."""
    return df.unpivot(list(ids), list(values), var, val)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (must be empty for a unique key)."""
    return df.groupBy(*names_of(keys)).count().filter(F.col("count") > 1)


def cols(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [col_of(n) for n in names]


def key_uniqueness(df: DataFrame, keys) -> DataFrame:
    """One row: ``n_rows`` and ``n_duplicate_rows`` (rows beyond the first of each key)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicate_rows"))
