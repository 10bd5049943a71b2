"""Date/time ``Column`` builders (inventory group I, plus C21-C26 helpers).

Timestamps are ``TIMESTAMP_NTZ`` (naive local clock): no zone shifts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def trunc_ts(unit: str, ts) -> Column:
    """date_trunc('hour'|'day'|'month'|'year', ts) kept as timestamp_ntz.

    Built from the clock fields, so no session-zone conversion is involved.
    """
    t = col_of(ts)
    unit = unit.lower()
    zero = F.lit(0)
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), zero, zero)
    if unit == "day":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), zero, zero, zero)
    if unit == "month":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.lit(1), zero, zero, zero)
    if unit == "year":
        return F.make_timestamp_ntz(F.year(t), F.lit(1), F.lit(1), zero, zero, zero)
    raise ValueError(unit)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a naive timestamp (no zone)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col_of(ts).cast("timestamp_ntz"))


def to_day(ts) -> Column:
    """date(ts)."""
    return F.to_date(col_of(ts))


def dow0(ts) -> Column:
    """Day of week with Sunday = 0 (trap T1: Spark's dayofweek is 1-based)."""
    return F.dayofweek(col_of(ts)) - F.lit(1)


def wday1(ts) -> Column:
    """R-style weekday, Sunday = 1."""
    return F.dayofweek(col_of(ts))


def seconds_between(a, b, whole: bool = False) -> Column:
    """Epoch seconds of b - a; fractional by default; ``whole=True`` follows
    a whole-second clock (both ends truncated to the second first, trap T3)."""
    if whole:
        return (F.floor(epoch_micros(b) / F.lit(1_000_000)) - F.floor(epoch_micros(a) / F.lit(1_000_000))).cast("bigint")
    return (epoch_micros(b) - epoch_micros(a)) / F.lit(1_000_000.0)


def minutes_between(a, b) -> Column:
    return seconds_between(a, b) / F.lit(60.0)


def second_of_day(ts) -> Column:
    """Seconds since midnight (fractional)."""
    return seconds_between(trunc_ts("day", ts), ts)


def month_end(year, month) -> Column:
    """Last day of the month of (year, month)."""
    return F.last_day(F.make_date(col_of(year), col_of(month), F.lit(1)))


def month_start(ts) -> Column:
    """floor_date(month) as a date."""
    return F.trunc(F.to_date(col_of(ts)), "month")


def add_days(d, n) -> Column:
    """I8."""
    return F.date_add(col_of(d), n)


def day_sequence(start, end) -> Column:
    """I8: array of dates from start to end inclusive."""
    return F.sequence(col_of(start), col_of(end), F.expr("INTERVAL 1 DAY"))


def month_sequence(start, end) -> Column:
    """Array of month-start dates, inclusive."""
    return F.sequence(col_of(start), col_of(end), F.expr("INTERVAL 1 MONTH"))


def replace_first(c, pattern: str, replacement: str = "") -> Column:
    """Replace only the first match (Spark's regexp_replace replaces all, trap T10).

    The pattern is anchored as ``^(.*?)PATTERN(.*)$`` so exactly one occurrence
    (the leftmost) is replaced; strings without a match stay unchanged.
    """
    anchored = f"^(?s)(.*?){pattern}(.*)$"
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col_of(c), anchored, f"$1{rep}$2")


def epoch_millis_of_month(d) -> Column:
    """Epoch milliseconds of a month-start date."""
    return (epoch_micros(col_of(d).cast("timestamp_ntz")) / 1000).cast("bigint")
