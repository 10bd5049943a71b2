from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def cols_of(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col_of(c) for c in cs]


def names_of(cs) -> list[str]:
    if cs is None:
        return []
    if isinstance(cs, str):
        return [cs]
    return list(cs)
