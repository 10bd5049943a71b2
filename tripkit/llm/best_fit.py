"""Conflict-constrained best-fit packing.

Documents (split where longer than a bin) are dealt by hash to groups of
bounded size, each packed on its own in decreasing size. Bins are kept by
residual capacity, with a bitmap of the residuals that have bins; a bin carries
a bitmap of duplicate clusters and one bitmap per allowed repeat of a source.
From the smallest sufficient residual the successor search goes on until the
tightest compatible bin is found; if there is none, a bin is opened. In a run of
equal items of one cluster the search resumes where it ended: all bins before
that hold the cluster already, so a large group of copies costs one pass.

Defined results: a null or zero size is a piece of no words, in some bin;
repeated rows are packed separately; null sources are a source, a null cluster
has no duplicates; ties go by cluster, source, id, piece; an empty table gives
no rows. A group that outgrows its bound (many equal rows) is packed in parts,
each whole. Only the named columns are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, stage, table
from tripkit.llm.near_classes import near_classes

CAPACITY = 2048
MAX_PER_SOURCE = 2
#: Pieces aimed at in a group; a group is closed at four times this.
GROUP = 8_000


class Bins:
    """Open bins of one group, by residual."""

    def __init__(self, capacity: int, max_per_source: int):
        self.capacity, self.max = capacity, max_per_source
        self.by_residual: dict[int, list[int]] = {}
        self.present = 0  # bit r: some bin has residual r
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.slots: list[int] = []
        self.run: tuple | None = None
        self.resume = (0, 0)

    def _place(self, b: int, residual: int, size: int, cluster: int, source: int) -> tuple[int, int, int]:
        left = residual - size
        self.by_residual.setdefault(left, []).append(b)
        self.present |= 1 << left
        self.clusters[b] |= cluster
        for plane in range(self.max):  # unary count of the source
            if not self.sources[b][plane] & source:
                self.sources[b][plane] |= source
                break
        self.slots[b] += 1
        return b, self.slots[b] - 1, self.capacity - residual

    def put(self, size: int, cluster: int, source: int) -> tuple[int, int, int]:
        """(bin, slot, words before it) of an item; cluster and source are single bits, cluster 0 is none."""
        item = (size, cluster, source)
        residual, at = self.resume if cluster and self.run == item else (size, 0)
        self.run = item
        while rest := self.present >> residual:
            step = (rest & -rest).bit_length() - 1
            if step:
                residual, at = residual + step, 0
            bins = self.by_residual[residual]
            for i in range(at, len(bins)):
                b = bins[i]
                if not self.clusters[b] & cluster and not self.sources[b][-1] & source:
                    del bins[i]
                    if not bins:
                        self.present &= ~(1 << residual)
                    self.resume = (residual, i)
                    return self._place(b, residual, size, cluster, source)
            residual, at = residual + 1, 0
        self.resume = (residual, at)
        self.clusters.append(0)
        self.sources.append([0] * self.max)
        self.slots.append(0)
        return self._place(len(self.slots) - 1, self.capacity, size, cluster, source)


def pack_group(items: list[tuple], capacity: int, max_per_source: int) -> list[tuple[int, int, int]]:
    """Place (size, cluster, source) items, given in decreasing size, one by one."""
    bins, times, source_bit = Bins(capacity, max_per_source), {}, {}
    for _, c, _ in items:
        times[c] = times.get(c, 0) + 1
    shared = {c: 1 << i for i, c in enumerate(c for c, n in times.items() if n > 1 and c is not None)}
    return [bins.put(size, shared.get(c, 0), source_bit.setdefault(s, 1 << len(source_bit))) for size, c, s in items]


_OUT = "bin_id long, slot int, bin_start int, doc_id long, piece int, start long, n_words int, source string, cluster long"


def pack(rows: DataFrame, capacity: int = CAPACITY, max_per_source: int = MAX_PER_SOURCE, group: int = GROUP) -> DataFrame:
    """Pieces of ``rows`` (doc_id, size, source, cluster) with their place: ``bin_id``,
    ``slot`` and ``bin_start`` (words before it) in the bin, ``start`` in the document."""
    if group > 16_000:
        raise ValueError("a group holds at most 16000 pieces")
    rows = stage(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("size", F.lit(0)).cast("long").alias("size"),
                             F.col("source").cast("string").alias("source"), F.col("cluster").cast("long").alias("cluster")), "pack-rows")
    pieces = (rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("size") / capacity) - 1))).alias("piece"))
              .withColumn("start", F.col("piece") * capacity)
              .withColumn("n", F.least(F.lit(capacity), F.col("size") - F.col("start")).cast("int")))
    total = rows.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)))).first()[0] or 0
    groups = max(1, -(-total // group))
    width = shuffle_width(rows.sparkSession)

    def run(batches):
        held, key, part = [], None, 0

        def close():
            places = pack_group([(r["n"], r["cluster"], r["source"]) for r in held], capacity, max_per_source)
            base = key << 40 | part << 16
            cols = [[base + p[0] for p in places], [p[1] for p in places], [p[2] for p in places],
                    *([r[c] for r in held] for c in ("doc_id", "piece", "start", "n", "source", "cluster"))]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["bin_id", "slot", "bin_start", "doc_id", "piece", "start", "n_words", "source", "cluster"])

        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["g"] != key or len(held) >= 4 * group):
                    yield close()
                    part = part + 1 if r["g"] == key else 0
                    held = []
                key = r["g"]
                held.append(r)
        if held:
            yield close()

    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(groups)))
    return (dealt.repartition(width, "g")
            .sortWithinPartitions("g", F.col("n").desc(), "cluster", "source", "doc_id", "piece")
            .select("g", "doc_id", F.col("piece").cast("int").alias("piece"), "start", "n", "source", "cluster").mapInArrow(run, _OUT))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, max_per_source: int = MAX_PER_SOURCE) -> DataFrame:
    """``pack`` by words, near-duplicate texts being duplicates of each other."""
    near = near_classes(docs)
    return pack(near.select("doc_id", "source", "size", F.col("near_class").alias("cluster")), capacity, max_per_source)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
