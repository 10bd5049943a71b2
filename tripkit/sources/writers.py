"""Sinks and table maintenance (inventory group B).

Every writer is a DataFrameWriter call; output folders are supplied by the
caller (shared storage on a cluster). Re-running a file's load is
idempotent through dynamic partition overwrite keyed by the source file.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """B1: materialise a query as a Parquet table (CTAS)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None,
           partition_by: Sequence[str] = ()) -> None:
    """B2: INSERT ... SELECT with an explicit column list."""
    write_table(df.select(*columns) if columns else df, path, partition_by, mode="append")


def replace_by_file(df: DataFrame, table_dir: str, file_col: str = "filename", files: Sequence[str] = ()) -> None:
    """Idempotent reload: rows of the same source file are replaced, all
    other files' rows are kept (dynamic partition overwrite). ``files`` names the
    files being reloaded: one that now yields no rows loses its old ones (a second
    step; ``managed.ManagedTables`` reloads in one). ``df`` is evaluated once."""
    seen = Observation()
    out = df.observe(seen, F.collect_set(file_col).alias("files")) if files else df  # one value per reloaded file
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(file_col).parquet(table_dir)
    if files:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for f in set(files) - set(seen.get["files"]):
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(f)
            path = jvm.org.apache.hadoop.fs.Path(table_dir, f"{file_col}={name}")
            path.getFileSystem(conf).delete(path, True)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` sends the (small, aggregated) result to one
    last task, after the work; leave it False for anything that grows with data."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned_csv(df: DataFrame, by: str, path: str, files_per_key: int | None = None) -> None:
    """One CSV folder per key value (a single job, no per-key loop). ``files_per_key`` files a key at
    most (1: a file a key, as a loop over the keys would write); left out, rebalancing
    splits a key that holds much of the data over several files."""
    if files_per_key:
        rest = [F.col(f"`{c}`") for c in df.columns]
        out = df.repartition(F.col(by), F.pmod(F.xxhash64(*rest), F.lit(files_per_key)))
    else:
        out = df.hint("rebalance", by)
    out.write.mode("overwrite").option("header", True).partitionBy(by).csv(path)


def write_json_lines(df: DataFrame, path: str, json_col: str = "json") -> None:
    """One JSON document per line (documents built with ``to_json``)."""
    df.select(json_col).write.mode("overwrite").text(path)


#: Rows that one task of a clustered layout sorts, about.
ROWS_A_FILE = 500_000


def cluster_layout(df: DataFrame, by: Sequence[str], sort: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by (type, time) and sort within partitions so the
    written Parquet row groups carry tight min/max statistics for pruning. ``partitions`` files, more when
    they would hold over ROWS_A_FILE rows each (rows are counted first): what a task sorts does not grow with the table."""
    cols = [*by, *sort]
    if partitions:
        partitions = max(partitions, -(-df.count() // ROWS_A_FILE))
    out = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return out.sortWithinPartitions(*cols)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Logical view."""
    df.createOrReplaceTempView(name)
    return df


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """Post-load predicate delete, as a filter keeping the complement."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
