"""K7: exact median margins over all pairs of a bucket, without forming the pairs.

A bucket's margin is b - a for every pair (a, b). Its sorted list holds the wins
of ``b`` (b - a <= 0; as in the sampled version a tie counts for ``b``) first,
then those of ``a``, so both medians are elements of known rank in one list.
Ranks are found by selection: each round counts, for a few thresholds t of every
bucket at once, the pairs with b <= a + t by merging the a values shifted by t
into the b values (one split running sum, see ``split_cumsum``), and narrows the
interval of every rank. When an interval holds no more distinct pairs than its
bucket has values, those pairs are listed by their position among the b values
and ranked exactly. Work per round is a few rows a value; nothing is gathered
by bucket, and the driver sees one flag a round.

a + t is compared without rounding error (two-sum), so ties are exact.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import names_of
from ..session import cut_lineage
from .stats import range_cuts, split_cumsum, value_counts

#: Thresholds a round tries inside an interval: evenly by value, and by magnitude for long tails.
EVEN, BY_SIZE = 4, 3
#: Magnitudes above 1 / FINE are told apart by their logarithm.
FINE = 1e6
_BIG = "decimal(38,0)"


def _shifted(a: Column, t: Column) -> tuple[Column, Column]:
    """(value, place among equal b values) of a + t: 0 before them if the rounded sum is too large, else 2."""
    s = a + t
    part = s - a
    error = (a - (s - part)) + (t - part)
    return s, F.when(error < 0, 0).otherwise(2)


def _merged(values: DataFrame, thresholds: DataFrame, cuts) -> DataFrame:
    """Per (bucket, a value, threshold): ``cum_nb`` and ``cum_ib``, the b trips and distinct b values up to
    a + t; also the b values themselves (``t`` null) with their positions."""
    asked = values.where("na > 0").join(thresholds, "_k").withColumn("t", F.explode("ts"))
    s, kind = _shifted(F.col("_v"), F.col("t"))
    asked = asked.select("_k", s.alias("_at"), kind.alias("_kind"), "_v", "t", "na", F.lit(0).cast("long").alias("nb"), F.lit(0).cast("long").alias("ib"))
    held = values.where("nb > 0").select("_k", F.col("_v").alias("_at"), F.lit(1).alias("_kind"), "_v", F.lit(None).cast("double").alias("t"),
                                         F.lit(0).cast("long").alias("na"), "nb", F.lit(1).cast("long").alias("ib"))
    return split_cumsum(asked.unionByName(held), ["_k"], "_at", ["nb", "ib"], ties=["_kind"], cuts=cuts)


def _counted(values: DataFrame, thresholds: DataFrame, cuts) -> DataFrame:
    """(bucket, t, c, p): pairs, and pairs of distinct values, with b - a <= t."""
    got = _merged(values, thresholds, cuts).where("t IS NOT NULL")
    return got.groupBy("_k", "t").agg(F.sum(F.col("na").cast(_BIG) * F.col("cum_nb").cast(_BIG)).cast(_BIG).alias("c"),
                                      F.sum(F.col("cum_ib").cast(_BIG)).cast(_BIG).alias("p"))


def _tried(low: Column, high: Column) -> Column:
    """Thresholds strictly inside an interval."""
    a, b = F.asinh(low * FINE), F.asinh(high * FINE)
    by_size = [F.sinh(a + (b - a) * (i / (BY_SIZE + 1))) / FINE for i in range(1, BY_SIZE + 1)]
    even = [low + (high - low) * (i / (EVEN + 1)) for i in range(1, EVEN + 1)]
    half = low / 2 + high / 2
    return F.array_distinct(F.filter(F.array(*even, *by_size, half), lambda t: (t > low) & (t < high)))


def median_margins(df: DataFrame, dims: Sequence[str], mode: str, a, b, value: str, min_obs: int = 5, listed: float = 8.0) -> DataFrame:
    """Per bucket the exact median of b - a over the pairs that ``a`` wins, and of a - b over the others;
    null where a side never wins. ``listed``: pairs an interval may hold per value of its bucket before it is listed.

    Null buckets are buckets; rows without a value or of another mode do not count; an empty table gives no rows.
    """
    dims = names_of(dims)
    key = F.struct(*dims) if dims else F.struct(F.lit(0).alias("_all"))
    values = value_counts(df, dims, mode, a, b, value).select(
        key.alias("_k"), F.col("_v").cast("double").alias("_v"), F.col("na").cast("long").alias("na"), F.col("nb").cast("long").alias("nb"))
    values = cut_lineage(values)
    cuts = range_cuts(values, "_v")
    of_a, of_b = F.when(F.col("na") > 0, F.col("_v")), F.when(F.col("nb") > 0, F.col("_v"))
    totals = values.groupBy("_k").agg(F.sum("na").alias("n_a"), F.sum("nb").alias("n_b"), F.count(F.lit(1)).alias("size"),
                                      (F.min(of_b) - F.max(of_a)).alias("low"), (F.max(of_b) - F.min(of_a)).alias("high"),
                                      F.max(F.abs("_v")).alias("far"))
    totals = cut_lineage(totals.where((F.col("n_a") >= min_obs) & (F.col("n_b") >= min_obs)))
    zero = _counted(values, totals.select("_k", F.array(F.lit(0.0)).alias("ts")), cuts).select("_k", F.col("c").alias("z"), F.col("p").alias("pz"))
    start = totals.join(zero, "_k").withColumn("n", F.col("n_a").cast(_BIG) * F.col("n_b").cast(_BIG))
    # Two middle ranks of each side; the pair of lowest rank counts 0.
    room = F.col("far") * 1e-12 + 1

    def ranks(side, first, count, low, high, below, upto, p_low, p_high):
        odd = (count - 1) / 2
        return [F.struct(F.lit(side).alias("side"), F.lit(i).alias("part"), (first + r(odd)).cast(_BIG).alias("rank"), count.cast(_BIG).alias("count"),
                         low.alias("low"), high.alias("high"), below.cast(_BIG).alias("below"), upto.cast(_BIG).alias("upto"),
                         p_low.cast(_BIG).alias("p_low"), p_high.cast(_BIG).alias("p_high")) for i, r in enumerate((F.floor, F.ceil))]

    none, every = F.lit(0), F.col("size").cast(_BIG) * F.col("size").cast(_BIG)
    states = start.select("_k", "size", F.explode(F.array(
        *ranks("b", none, F.col("z"), F.col("low") - room, F.lit(0.0), none, F.col("z"), none, F.col("pz")),
        *ranks("a", F.col("z"), F.col("n") - F.col("z"), F.lit(0.0), F.col("high") + room, F.col("z"), F.col("n"), F.col("pz"), every))).alias("s"))
    states = cut_lineage(states.select("_k", "size", "s.*").where("count > 0").withColumn(
        "done", (F.col("p_high") - F.col("p_low")) <= F.col("size") * listed))
    while not states.where("NOT done").isEmpty():
        tried = states.where("NOT done").select("_k", F.explode(_tried(F.col("low"), F.col("high"))).alias("t"))
        counts = _counted(values, tried.groupBy("_k").agg(F.collect_set("t").alias("ts")), cuts)
        seen = counts.groupBy("_k").agg(F.collect_list(F.struct("t", "c", "p")).alias("seen"))
        inside = F.filter("seen", lambda x: (x["t"] > F.col("low")) & (x["t"] < F.col("high")))
        under = F.array_max(F.filter(inside, lambda x: x["c"] <= F.col("rank")))
        over = F.array_min(F.filter(inside, lambda x: x["c"] > F.col("rank")))
        new = states.join(seen, "_k", "left").withColumn("u", F.when(~F.col("done"), under)).withColumn("o", F.when(~F.col("done"), over))
        still = F.col("done") | (F.col("u").isNull() & F.col("o").isNull())  # no number lies between the bounds
        new = new.select("_k", "size", "side", "part", "rank", "count",
                         *[F.coalesce(F.col(s)[f], F.col(c)).alias(c) for s, f, c in
                           (("u", "t", "low"), ("o", "t", "high"), ("u", "c", "below"), ("o", "c", "upto"), ("u", "p", "p_low"), ("o", "p", "p_high"))],
                         still.alias("still"))
        states = cut_lineage(new.withColumn("done", F.col("still") | ((F.col("p_high") - F.col("p_low")) <= F.col("size") * listed)).drop("still"))

    # List the pairs of each interval: positions of b between a + low and a + high.
    spans = states.select("_k", "low", "high").distinct()
    ends = cut_lineage(_merged(values, spans.groupBy("_k").agg(F.array_distinct(F.flatten(F.collect_list(F.array("low", "high")))).alias("ts")), cuts))
    places = ends.where("t IS NULL").select("_k", F.col("cum_ib").alias("i"), F.col("_v").alias("vb"), "nb")
    asked = ends.where("t IS NOT NULL").select("_k", F.col("_v").alias("va"), "na", "t", F.col("cum_ib").alias("i"))
    pairs = (asked.join(spans, "_k").where((F.col("t") == F.col("low")) | (F.col("t") == F.col("high")))
             .groupBy("_k", "low", "high", "va", "na").agg(F.max(F.when(F.col("t") == F.col("low"), F.col("i"))).alias("i_low"),
                                                           F.max(F.when(F.col("t") == F.col("high"), F.col("i"))).alias("i_high")))
    pairs = pairs.where("i_high > i_low").withColumn("i", F.explode(F.sequence(F.col("i_low") + 1, F.col("i_high")))).join(places, ["_k", "i"])
    found = pairs.groupBy("_k", "low", "high", (F.col("vb") - F.col("va")).alias("d")).agg(
        F.sum(F.col("na").cast(_BIG) * F.col("nb").cast(_BIG)).cast(_BIG).alias("c"))
    found = split_cumsum(cut_lineage(found), ["_k", "low", "high"], "d", ["c"])
    at = states.join(found, ["_k", "low", "high"])
    rank = F.col("rank") - F.col("below")
    hit = at.where((rank < F.col("cum_c")) & (rank >= F.col("cum_c") - F.col("c")))
    medians = hit.groupBy("_k", "side").agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
    middle = F.col("d0") + (F.col("d1") - F.col("d0")) / 2
    out = medians.groupBy("_k").agg(F.max(F.when(F.col("side") == "a", middle)).alias("median_margin_a_wins"),
                                    F.max(F.when(F.col("side") == "b", F.lit(0.0) - middle)).alias("median_margin_b_wins"))
    out = totals.select("_k", "n_a", "n_b").join(out, "_k", "left")
    return out.select(*[F.col("_k")[d].alias(d) for d in dims], "n_a", "n_b", "median_margin_a_wins", "median_margin_b_wins")
