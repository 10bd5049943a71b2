"""Registry of named analyses: key -> (Spark builder, equivalent SQL or None).

A23: every builder returns a DataFrame and collects no result; those that load,
stream, checkpoint a shared intermediate (percentiles, win rates, series) or fit a
regression start that work when called; L5: the reference's R/Ruby helper functions are plain Python
functions over DataFrames and Columns. L3 (watermarks beyond hourly windows,
sessions, custom state) and L4 (database UDFs) do not occur in the reference.
"""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco
