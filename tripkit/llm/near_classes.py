"""Near-duplicate classes of documents by banded MinHash over word triples.

A text's triples of neighbouring words (lower case, whatever space is between
them) get 192 MinHash values in 24 bands of 8. Texts that agree in a band are
linked, and a class is what the links connect; texts of the same triples always
share one. By the banding a pair is linked with probability 0.988 at a Jaccard
similarity of 0.8, 0.9999 at 0.87 and 0.09 at 0.5. A text without words is
in a class with its equals only, an empty or null one in none. Copies count once
per distinct signature, and a band links all its signatures to the smallest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.common import stage
from tripkit.llm.packs import grouped, token_numbers
from tripkit.llm.simhash import components

BANDS, ROWS = 24, 8
#: Text bytes whose signatures are taken at once.
SLICE_BYTES = 1 << 19
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_TURNS = np.random.default_rng(11).integers(0, 1 << 32, (2, BANDS * ROWS), np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C
    return x ^ (x >> np.uint64(29))


def band_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the bands, a row per text that has words; words per text)."""
    from xxhash import xxh64_intdigest
    x, lens, words = token_numbers(texts, lower=True)
    hashes = np.array([*(xxh64_intdigest(w, 7) for w in words), 1], np.uint64)
    # Two ends after each text: a triple begins at every word.
    seq = hashes[np.insert(x, np.repeat(np.cumsum(lens), 2), len(words))]
    some = lens[lens > 0]
    at = np.arange(len(x)) + np.repeat(2 * np.arange(len(lens)), lens)
    triples = (_mixed(_mixed(seq[at] * _A + seq[at + 1]) * _B + seq[at + 2]) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum(some) - some
    keys = np.zeros((len(some), BANDS), np.uint64)
    for i in range(BANDS * ROWS if len(some) else 0):
        turned = triples ^ _TURNS[0, i]
        turned *= _TURNS[1, i] | np.uint32(1)
        band = i // ROWS
        keys[:, band] = _mixed(keys[:, band] * _A + np.minimum.reduceat(turned, first) + np.uint64(band + 1))
    return keys.view(np.int64), lens


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, near_class) of every row of ``docs``; size is the number of words."""
    def run(batches):
        for _, _, t in grouped(batches, 2, SLICE_BYTES):
            keys, lens = band_keys(t.column(2).combine_chunks())
            offsets = np.concatenate([[0], np.cumsum((lens > 0) * BANDS)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(t.column(i).combine_chunks() for i in (0, 1)), pa.array(lens, pa.int64()), bands,
                                              t.column(3).combine_chunks()], names=["doc_id", "source", "size", "bands", "exact"])

    text = F.coalesce("text", F.lit(""))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
                        F.when(F.length(text) > 0, F.xxhash64(text)).alias("exact"))
            .mapInArrow(run, "doc_id long, source string, size long, bands array<long>, exact long"))
    rows = stage(rows.withColumn("node", F.when(F.col("size") > 0, F.xxhash64("bands"))), "near-rows")
    keyed = (rows.where("size > 0").groupBy("node").agg(F.first("bands").alias("bands"))
             .select("node", F.explode("bands").alias("band")))
    keyed = stage(keyed, "near-bands")
    least = keyed.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    edges = keyed.join(least, "band").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    joined = rows.join(components(edges), "node", "left")
    return joined.select("doc_id", "source", "size", F.coalesce("root", "node", "exact").alias("near_class"))
