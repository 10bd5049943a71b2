"""Helpers shared by the operators: staging in the shared folder, words, sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.session import shared_dir, table_path

#: One word: a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: The six separators of ``WORD`` as bytes; ``bytes.split()`` splits on just these.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


#: Spark's setting that drops a query's shuffle files once the query has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at committed files.

    The shuffle files of the write go when it has ended, as nothing reads them again.
    """
    spark = df.sparkSession
    path, before = work_path(spark, name), spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, compared without case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
