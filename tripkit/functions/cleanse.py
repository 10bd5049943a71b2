"""Cleansing and derived-value ``Column`` builders (inventory group C).

All builders are JVM-side expressions (``pyspark.sql.functions``) so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# ---------------------------------------------------------------------------
# These must equal the source data conventions exactly.
# ---------------------------------------------------------------------------
VENDOR_NAME_CODES = {"CMT": 1, "VTS": 2, "DDS": 3}
VENDOR_DIGIT_CODES = ["1", "2"]
RATE_CODES = ["1", "2", "3", "4", "5", "6"]
STORE_FLAG_TRUE = ["Y", "1", "1.0"]
STORE_FLAG_FALSE = ["N", "0", "0.0"]
PAYMENT_DIGIT_CODES = ["1", "2", "3", "4", "5", "6"]
PAYMENT_WORDS = {
    1: ["credit", "cre", "crd"],
    2: ["cash", "cas", "csh"],
    3: ["no charge", "no"],
    4: ["dispute", "dis"],
}
# Dispatching base number -> (licence, company); anything else is 'other'.
BASES_JUNO = ["B02907", "B02908", "B02914", "B03035"]
BASES_LYFT = ["B02510", "B02844"]
BASES_UBER = ["B02395", "B02404", "B02512", "B02598", "B02617", "B02682", "B02764", "B02765",
              "B02835", "B02836", "B02864", "B02865", "B02866", "B02867", "B02869", "B02870",
              "B02871", "B02872", "B02875", "B02876", "B02877", "B02878", "B02879", "B02880",
              "B02882", "B02883", "B02884", "B02887", "B02888", "B02889"]
BASES_VIA = ["B02800", "B03136"]
BASE_GROUPS = [("HV0002", "juno", BASES_JUNO), ("HV0005", "lyft", BASES_LYFT),
               ("HV0003", "uber", BASES_UBER), ("HV0004", "via", BASES_VIA)]
LICENCE_COMPANY = {"HV0002": "juno", "HV0003": "uber", "HV0004": "via", "HV0005": "lyft"}
BOROUGHS = ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island", "EWR"]
BRANDS = ["uber", "lyft", "via", "juno", "gett"]
# Time-of-day buckets by hour (inclusive ranges); other hours -> 'other'.
TIME_BUCKETS = [("morning", 8, 10), ("midday", 11, 15), ("afternoon", 16, 18), ("evening", 19, 21)]
# Season by month.
SEASONS = [("winter", [12, 1, 2]), ("spring", [3, 4, 5]), ("summer", [6, 7, 8]), ("fall", [9, 10, 11])]
# End of fixed values.


def _norm(c) -> Column:
    """Trim + upper (also lower/replace below)."""
    return F.upper(F.trim(col_of(c)))


def code_map(c, mapping: Mapping, default=None, normalise=True) -> Column:
    """Map normalised string codes to values; unmatched -> ``default``."""
    key = _norm(c) if normalise else col_of(c)
    expr = None
    for k, v in mapping.items():
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def vendor_code(c) -> Column:
    """C1: '1','2' -> int; CMT/VTS/DDS -> 1/2/3; else null. I14 CASE, I16 try_cast."""
    t = F.trim(col_of(c))
    expr = F.when(t.isin(*VENDOR_DIGIT_CODES), t.try_cast("int"))
    for name, code in VENDOR_NAME_CODES.items():
        expr = expr.when(_norm(c) == name, F.lit(code))
    return expr


def rate_code(c) -> Column:
    """Whitelist 1..6 else null."""
    t = F.trim(col_of(c))
    return F.when(t.isin(*RATE_CODES), t.try_cast("int"))


def flag(c, true_values: Sequence[str], false_values: Sequence[str], normalise=True) -> Column:
    """Generic string flag -> boolean; unmatched -> null."""
    key = _norm(c) if normalise else col_of(c)
    return (F.when(key.isin(*true_values), F.lit(True))
             .when(key.isin(*false_values), F.lit(False)))


def store_flag(c) -> Column:
    """Y/1/1.0 -> true, N/0/0.0 -> false."""
    return flag(c, STORE_FLAG_TRUE, STORE_FLAG_FALSE)


def simple_yn(c) -> Column:
    """Exact 'Y'/'N' -> boolean."""
    return flag(c, ["Y"], ["N"], normalise=False)


def payment_code(c) -> Column:
    """C4: strip quotes; digits 1..6 as int; words -> 1..4; else null."""
    raw = F.replace(col_of(c), F.lit('"'), F.lit(""))
    t = F.trim(raw)
    low = F.trim(F.lower(raw))
    expr = F.when(t.isin(*PAYMENT_DIGIT_CODES), t.try_cast("int"))
    for code, words in PAYMENT_WORDS.items():
        expr = expr.when(low.isin(*words), F.lit(code))
    return expr


def zero_to_null(c) -> Column:
    """0 -> null."""
    x = col_of(c)
    return F.when(x != 0, x)


def fhv_flag_rowstore(c, empty_is_false=False) -> Column:
    """trim+upper; Y/N; '' -> false only when ``empty_is_false``."""
    falses = ["N", ""] if empty_is_false else ["N"]
    return flag(c, ["Y"], falses)


def fhv_flag_columnstore(c, blank_is_false=True) -> Column:
    """Exact 'Y' -> true; 'N' (and one space unless disabled) -> false."""
    falses = ["N", " "] if blank_is_false else ["N"]
    return flag(c, ["Y"], falses, normalise=False)


def norm_code(c) -> Column:
    """Trim + upper."""
    return _norm(c)


def base_licence(c) -> Column:
    """C10 (licence half): base number -> HV licence, else 'other'."""
    key = _norm(c)
    expr = None
    for lic, _, bases in BASE_GROUPS:
        expr = F.when(key.isin(*bases), F.lit(lic)) if expr is None else expr.when(key.isin(*bases), F.lit(lic))
    return expr.otherwise(F.lit("other"))


def base_company(c) -> Column:
    """C10 (company half): base number -> company, else 'other'."""
    key = _norm(c)
    expr = None
    for _, comp, bases in BASE_GROUPS:
        expr = F.when(key.isin(*bases), F.lit(comp)) if expr is None else expr.when(key.isin(*bases), F.lit(comp))
    return expr.otherwise(F.lit("other"))


def licence_company(c) -> Column:
    """C11: licence -> company, else null (exact match)."""
    return code_map(c, LICENCE_COMPANY, None, normalise=False)


def speed(distance, seconds) -> Column:
    """Distance / seconds * 3600, null when seconds is 0 or null (trap T4)."""
    return F.try_divide(col_of(distance), col_of(seconds).cast("double")) * F.lit(3600.0)


def in_bounds(bounds: Mapping[str, tuple]) -> Column:
    """AND of ``lo <= c < hi`` terms; a null term keeps SQL 3-valued logic."""
    terms = []
    for c, (lo, hi) in bounds.items():
        x = col_of(c)
        if lo is not None:
            terms.append(x >= F.lit(lo))
        if hi is not None:
            terms.append(x < F.lit(hi))
    return reduce(lambda a, b: a & b, terms)


def null_as_zero_sum(*cols) -> Column:
    """Sum of coalesce(c, 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(col_of(c), F.lit(0)) for c in cols])


def all_false(*cols) -> Column:
    """Every flag = false (3-valued: null unless some flag is true)."""
    return reduce(lambda a, b: a & b, [col_of(c) == F.lit(False) for c in cols])


def weekday_label(ts) -> Column:
    """C21: 'weekend' for Saturday/Sunday else 'weekday'."""
    dow = F.dayofweek(col_of(ts))
    return F.when(dow.isin(1, 7), F.lit("weekend")).otherwise(F.lit("weekday"))


def season(ts) -> Column:
    """Season from month."""
    m = F.month(col_of(ts))
    expr = None
    for name, months in SEASONS:
        expr = F.when(m.isin(*months), F.lit(name)) if expr is None else expr.when(m.isin(*months), F.lit(name))
    return expr


def time_bucket(hour, ranges=TIME_BUCKETS, other="other") -> Column:
    """Hour-of-day bucket; inclusive ranges."""
    h = col_of(hour)
    expr = None
    for name, lo, hi in ranges:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(other))


def bounded(c, lo, hi) -> Column:
    """Keep value only in closed [lo, hi], else null."""
    x = col_of(c)
    return F.when(x.between(lo, hi), x)


def era(date, ranges: Sequence[tuple]) -> Column:
    """Label by closed date ranges ``(label, start, end)``; else null."""
    d = col_of(date)
    expr = None
    for label, lo, hi in ranges:
        cond = d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# Route classes (both scripts use these labels).
ROUTE_LABELS = ("within_manhattan", "manhattan_to_outer_boroughs",
                "outer_boroughs_to_manhattan", "within_outer_boroughs")


def route_type(b1, b2, core="Manhattan", labels=ROUTE_LABELS, catch_all=True) -> Column:
    """Route class from start and end areas.

    ``catch_all=True`` follows the regression script (last class is the
    TRUE branch, so null areas fall into it); ``False`` follows the summary
    script, where a null area leaves the class null.
    """
    a, b = col_of(b1), col_of(b2)
    expr = (F.when((a == core) & (b == core), F.lit(labels[0]))
             .when((a == core) & (b != core), F.lit(labels[1]))
             .when((a != core) & (b == core), F.lit(labels[2])))
    if catch_all:
        return expr.otherwise(F.lit(labels[3]))
    return expr.when((a != core) & (b != core), F.lit(labels[3]))


def floor_bucket(c, width, offset=0.0) -> Column:
    """floor(x / w) * w + offset."""
    return F.floor(col_of(c) / F.lit(width)) * F.lit(width) + F.lit(offset)


def cut_left_closed(c, breaks: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Half-open [b_i, b_{i+1}) buckets; out of range -> null."""
    x = col_of(c)
    labels = labels or [f"[{breaks[i]},{breaks[i + 1]})" for i in range(len(breaks) - 1)]
    expr = None
    for i in range(len(breaks) - 1):
        cond = (x >= F.lit(breaks[i])) & (x < F.lit(breaks[i + 1]))
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def threshold_bucket(c, thresholds: Sequence[float]) -> Column:
    """Index of the first threshold with ``c < t``; len(thresholds) otherwise."""
    x = col_of(c)
    expr = None
    for i, t in enumerate(thresholds):
        expr = F.when(x < F.lit(t), F.lit(i)) if expr is None else expr.when(x < F.lit(t), F.lit(i))
    return expr.otherwise(F.lit(len(thresholds)))


def relabel(c, mapping: Mapping[str, str], keep_unmapped=True) -> Column:
    """Literal map lookup with fallback to the original value."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.element_at(m, col_of(c)) if mapping else F.lit(None)
    return F.coalesce(hit, col_of(c)) if keep_unmapped else hit


def group_key(*parts) -> Column:
    """Concatenated series key (e.g. type || year)."""
    return F.concat_ws("_", *[col_of(p).cast("string") for p in parts])


def clamp_max(c, hi) -> Column:
    """pmin(x, hi)."""
    return F.least(col_of(c), F.lit(hi))


def impute_cash_tip(total, tip, pay, cash_code=2, rate=0.15):
    """For cash trips with zero tip, cost x (1+rate) and tip = rate x total."""
    is_cash_no_tip = (col_of(pay) == F.lit(cash_code)) & (col_of(tip) == F.lit(0))
    cost = F.when(is_cash_no_tip, col_of(total) * F.lit(1 + rate)).otherwise(col_of(total))
    tip_out = F.when(is_cash_no_tip, col_of(total) * F.lit(rate)).otherwise(col_of(tip))
    return cost, tip_out


def percent_label(c) -> Column:
    """ROUND(x*100) || '%'."""
    return F.concat(F.round(col_of(c) * 100).cast("bigint").cast("string"), F.lit("%"))


def brand_bucket(c) -> Column:
    """Lower-cased brand name in the list else 'other'."""
    low = F.lower(col_of(c))
    return F.when(low.isin(*BRANDS), low).otherwise(F.lit("other"))


def sentinel_to_null(c, sentinel) -> Column:
    """Sentinel value -> null."""
    return F.nullif(col_of(c), F.lit(sentinel))


def parse_number(c) -> Column:
    """Strip ',', '%', '-' and spaces; blank -> null; numeric parse."""
    s = F.regexp_replace(col_of(c), r"[,%\-\s]", "")
    return F.when(s == "", F.lit(None).cast("double")).otherwise(s.try_cast("double"))


def slug(c) -> Column:
    """Lower-case, '-' -> space, squish spaces, space -> '_'."""
    s = F.regexp_replace(F.lower(col_of(c)), "-", " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.regexp_replace(s, " ", "_")


def month_string_end(c) -> Column:
    """A18: 'yyyy-MM' -> last day of that month."""
    return F.last_day(F.to_date(col_of(c), "yyyy-MM"))


def coalesce_cols(*cols) -> Column:
    """C14."""
    return F.coalesce(*[col_of(c) for c in cols])


def in_list(c, values: Iterable) -> Column:
    return col_of(c).isin(*list(values))
