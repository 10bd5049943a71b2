"""Named analyses bound to the driver's tables. Importing this package
registers every analysis in ``registry.QUERIES`` / ``registry.ORACLE``."""

from . import (airports, cleansing, comparison, daily, fares, hourly, load_queries, loads, market, payments,  # noqa: F401
               regulator, reload_queries, simulation, spatial_queries)
from .registry import ORACLE, QUERIES  # noqa: F401
