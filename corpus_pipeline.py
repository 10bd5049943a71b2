"""Corpus pipeline over ``documents``: quality rules, SimHash near-dedup, substring
dedup, mixing to target weights, best-fit packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and rereads for the next.
All but the last return the columns of ``documents``; the last returns the
pieces of the packed bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm import best_fit, decision_list, fair_mix, simhash, substrings
from tripkit.llm.common import stage, table, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return decision_list.filter_documents(docs, decision_list.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, k=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that a document with a smaller id has too go."""
    return substrings.dedupe(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in order of virtual finish time; a repeated document is a repeated row."""
    size, mark = word_count(F.col("text")), fair_mix.text_mark(F.col("text"))
    return fair_mix.FairMix(docs.select("doc_id", "source", size.alias("size"), mark.alias("mark"))).mixed(docs, size, mark)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2048 words; repeats of a document count as duplicates of each other."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_bins),
]
#: The learned list has no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` applied to ``documents`` one after the other."""
    out = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        out = stage(step(spark, out, sf_dir), f"pipeline-{i}")
    return out
