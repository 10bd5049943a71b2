"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled (order of a keyed hash of id and text) and queued, up to
``max_epochs`` times round. A copy's virtual finish time is the source's words
up to and including it divided by the source's target. Serving all queues by
finish time and stopping at the total budget gives each source its target.

All DataFrame functions. The running sum of a source is split over hash
buckets, so a source with a third of all rows spreads over many tasks; the
global stop is found from one total per slice of virtual time plus the rows of
the single slice in which the budget runs out.

Defined results: a null or empty text has size 0 and is never counted; a null
source is a source of its own, last in order; repeated rows are queued as
separate documents; ties in the shuffle order fall to id, then size, then a hash
of the other columns, so a mix repeats whatever the partitioning; an empty
table or a zero budget takes nothing. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import stage, table, word_count

SEED = "mix-1"
WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
#: Rows aimed at in one hash bucket or slice of virtual time; at least 64 buckets, so that a source with a
#: third of all rows is dealt evenly on small tables too.
ROWS_PER_BUCKET = 20_000


def targets(queued: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``q_key``, ``source_size``, ``target``.

    Weights repeat over the sources in code-point order. Sources are filled in
    order of (cap / weight): those at or under the common level stop at their
    cap, the rest share what is left by weight.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    rank = Window.orderBy(F.col("q_source").asc_nulls_last())
    before = Window.orderBy("ratio", "q_key").rowsBetween(Window.unboundedPreceding, -1)
    out = (queued.groupBy("q_key").agg(F.first("q_source").alias("q_source"), F.sum("q_size").alias("source_size"))
           .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                              ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int")).cast("double"))
           .withColumn("budget", share * total)
           .withColumn("cap", max_epochs * F.col("source_size"))
           .withColumn("ratio", F.col("cap") / F.col("weight"))
           .withColumn("all_weight", F.sum("weight").over(Window.partitionBy()))
           .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                       / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
           .withColumn("free_level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(Window.partitionBy())))
    return out.select("q_key", "source_size", "budget",
                      F.when(F.col("ratio") <= F.col("level"), F.col("cap").cast("double"))
                      .otherwise(F.col("free_level") * F.col("weight")).alias("target"))


def _keyed(docs: DataFrame, size: Column, buckets: int) -> DataFrame:
    order = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("mark")))
    return (docs.withColumn("q_size", size).withColumn("q_source", F.col("source"))
            .withColumn("q_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
            .withColumn("q_order", order)
            .withColumn("q_bucket", F.floor(F.conv(F.substring("q_order", 1, 8), 16, 10).cast("long") * buckets / F.lit(2.0 ** 32))))


def text_mark(text: Column) -> Column:
    """Hash that tells the texts of one id apart; rows of equal id and mark share a bucket."""
    return F.md5(F.coalesce(text, F.lit("")))


class FairMix:
    """Plan of one mix: targets, bucket offsets and the cut, all from (doc_id, source, size, mark) rows.

    The rows are staged once in the shared folder; on the driver are only their
    number, the budget and the one copy at which the budget runs out.
    """

    def __init__(self, rows: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS,
                 rows_per_bucket: int = ROWS_PER_BUCKET):
        self.max_epochs = max_epochs
        mark = F.col("mark") if "mark" in rows.columns else F.lit("")
        rows = stage(rows.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), mark.alias("mark")), "mix-rows")
        self.buckets = max(64, -(-rows.count() // rows_per_bucket))
        keyed = _keyed(rows, F.col("size"), self.buckets)
        totals = keyed.groupBy("q_key", "q_bucket").agg(F.first("q_source").alias("q_source"), F.sum("q_size").alias("q_size"))
        earlier = Window.partitionBy("q_key").orderBy("q_bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = stage(totals.join(targets(totals, weights, share, max_epochs), "q_key")
                       .withColumn("q_offset", F.coalesce(F.sum("q_size").over(earlier), F.lit(0)))
                       .select("q_key", "q_bucket", "q_offset", "source_size", "budget", "target"), "mix-offsets")
        self.offsets = totals
        self.budget = totals.agg(F.max("budget")).first()[0] or 0.0
        self.rows = rows
        self.cut = self._cut(self.queue(rows, F.col("size")))

    def queue(self, docs: DataFrame, size: Column, *ties: Column) -> DataFrame:
        """``docs`` with its place in the queue: q_* columns, ``source_size``, ``target``."""
        line = Window.partitionBy("q_key", "q_bucket").orderBy("q_order", "doc_id", "q_size", *ties)
        return (_keyed(docs, size, self.buckets).join(self.offsets, ["q_key", "q_bucket"])
                .withColumn("q_seq", F.row_number().over(line))
                .withColumn("q_cum", F.col("q_offset") + F.sum("q_size").over(line.rowsBetween(Window.unboundedPreceding, 0))))

    def finish(self, epoch) -> Column:
        epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
        return F.when(F.col("target") > 0, (epoch * F.col("source_size") + F.col("q_cum")) / F.col("target")).otherwise(F.lit(0.0))

    def place(self, epoch) -> Column:
        """Sort key of a copy; unique, so that the cut is exact among ties."""
        epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
        return F.struct(self.finish(epoch).alias("finish"), F.col("q_key"), epoch.cast("int").alias("epoch"),
                        F.col("q_bucket"), F.col("q_seq"))

    def _cut(self, queued: DataFrame):
        copies = (queued.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(self.max_epochs - 1))))
                  .withColumn("place", self.place(F.col("epoch")))
                  .withColumn("slice", F.floor(F.col("place.finish") * self.buckets)))
        copies = stage(copies.select("place", "slice", "q_size"), "mix-copies")
        sums = copies.groupBy("slice").agg(F.sum("q_size").alias("words"))
        upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
        over = (sums.withColumn("upto", F.sum("words").over(upto)).where(F.col("upto") > F.lit(self.budget))
                .orderBy("slice").select("slice", (F.col("upto") - F.col("words")).alias("before")).first())
        if over is None:
            return None
        run = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        return (copies.where(F.col("slice") == over["slice"]).withColumn("upto", over["before"] + F.sum("q_size").over(run))
                .where(F.col("upto") > F.lit(self.budget)).orderBy("place").select("place.*").first())

    def copies_taken(self) -> list[Column]:
        """For each epoch whether the copy is in the mix; columns over a ``queue`` result."""
        if self.cut is None:
            return [F.lit(True)] * self.max_epochs
        c = self.cut
        cut = F.struct(F.lit(c["finish"]).alias("finish"), F.lit(c["q_key"]).alias("q_key"), F.lit(c["epoch"]).cast("int").alias("epoch"),
                       F.lit(c["q_bucket"]).cast("long").alias("q_bucket"), F.lit(c["q_seq"]).cast("int").alias("q_seq"))
        return [self.place(e) < cut for e in range(self.max_epochs)]

    def mixed(self, docs: DataFrame, size: Column, mark: Column | None = None) -> DataFrame:
        """The mix itself: rows of ``docs``, once per copy taken, range-sorted by finish time; ``mark`` as in the plan."""
        rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
        names = [F.col(f"d.`{c}`") for c in docs.columns]
        wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                              F.col("doc_id"), F.col("source"), size.alias("size"), (F.lit("") if mark is None else mark).alias("mark"),
                              F.md5(F.to_json(F.struct(*rest))).alias("rest"))
        taken = F.array(*[F.when(t, e) for e, t in enumerate(self.copies_taken())])
        return (self.queue(wrapped, F.col("size"), F.col("rest")).withColumn("epoch", F.explode(F.array_compact(taken)))
                .orderBy(self.place(F.col("epoch"))).select(*names))


def op4_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = FairMix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_mark(F.col("text")).alias("mark")))
    taken = sum((F.when(t, F.col("q_size")).otherwise(F.lit(0)) for t in mix.copies_taken()), F.lit(0))
    return (mix.queue(mix.rows, F.col("size"))
            .select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")))


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS ord, coalesce('=' || source, '') AS skey
  FROM documents),
s AS (
  SELECT skey, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (
  SELECT skey, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
l AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio, sum(weight) OVER () AS all_weight FROM w),
m AS (
  SELECT *, (budget - coalesce(sum(cap) OVER b, 0)::DOUBLE) / (all_weight - coalesce(sum(weight) OVER b, 0)) AS level
  FROM l WINDOW b AS (ORDER BY ratio, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT skey, source_size, budget, CASE WHEN ratio <= level THEN cap::DOUBLE
         ELSE max(CASE WHEN ratio > level THEN level END) OVER () * weight END AS target FROM m),
q AS (
  SELECT d.*, t.source_size, t.target, t.budget,
         row_number() OVER o AS seq, sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM d JOIN t USING (skey) WINDOW o AS (PARTITION BY skey ORDER BY ord, doc_id, size)),
c AS (
  SELECT q.*, e.epoch, CASE WHEN target > 0 THEN (e.epoch * source_size + cum)::DOUBLE / target ELSE 0 END AS fin
  FROM q, (VALUES (0), (1)) e(epoch)),
r AS (
  SELECT *, sum(size) OVER (ORDER BY fin, skey, epoch, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM c)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN upto <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM r GROUP BY skey, seq, doc_id, size
"""
