"""Readers with load-time repair (inventory group A).

Monthly files drift: a column can arrive with a null/other physical type,
with a different case or spelling, or next to a stray index column. Rather
than rewriting source files, files are grouped by their physical schema
(footers are read by tasks, one row a file), each group is read in one scan,
conformed to the declared schema, and the groups are combined with
``unionByName``. The number of scans equals the number of distinct schemas (a
handful of eras), not the number of files.
"""

from __future__ import annotations

import re
import sys as _sys
from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp
from .schemas import DATASETS, SOURCE_NAMES

# The footer reader below runs in Python workers and is shipped by value with this module.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

STRAY_COLUMNS = ("__index_level_0__",)
FILE_YEAR = re.compile(r"tripdata_(\d{4})-(\d{2})")


def file_name(path: Column) -> Column:
    """Basename of a path (split + element_at(-1))."""
    return F.element_at(F.split(path, "/"), -1)


def data_set_name(path: Column) -> Column:
    """Name of the data set a file belongs to: the folder above it if that is named as a Parquet file, else its own."""
    above = F.element_at(F.split(path, "/"), -2)
    return F.when(above.rlike(r"^[^=]+\.parquet$"), above).otherwise(file_name(path))


def with_source_file(df: DataFrame, out: str = "filename") -> DataFrame:
    """A3: basename of the source file."""
    return df.withColumn(out, file_name(F.col("_metadata.file_path")))


def row_key(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Stable row key (full path, row index in the file): exact, no global counter, no hash."""
    return df.withColumn(out, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def conform(df: DataFrame, schema: T.StructType, rename: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: case-insensitive / mapped names
    (A6), casts to the declared type (null-typed columns become typed nulls,
    A5), missing columns as typed nulls, stray columns dropped (A7)."""
    rename = {**SOURCE_NAMES, **(rename or {})}
    by_lower = {}
    for c in df.columns:
        if c in STRAY_COLUMNS:
            continue
        target = rename.get(c, c)
        by_lower.setdefault(target.lower(), c)
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def split_by_era(paths: Sequence[str], first_zone_year: int = 2011) -> tuple[list[str], list[str]]:
    """A4: split monthly files on the year in ``tripdata_YYYY-MM`` (legacy, modern)."""
    legacy, modern = [], []
    for p in paths:
        m = FILE_YEAR.search(p)
        (legacy if m and int(m.group(1)) < first_zone_year else modern).append(p)
    return legacy, modern


def list_files(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """A2: (path) of every file under folders, globs or a list of either. Spark's own listing, on
    executors where there are many; no content is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")


def file_schemas(files: DataFrame) -> DataFrame:
    """(path, shape) of Parquet files: each task reads the footers of its files. ``shape`` is null
    where a task cannot open the file's store by itself."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq
        for b in batches:
            paths, shapes = b.column("path").to_pylist(), []
            for p in paths:
                try:
                    store, inner = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", p))
                    with store.open_input_file(inner) as f:
                        shapes.append("\n".join(f"{x.name}\t{x.type}" for x in pq.read_schema(f)))
                except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
                    shapes.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(shapes, pa.string())], names=["path", "shape"])

    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(width, "path").mapInArrow(run, "path string, shape string")


def schema_groups(spark: SparkSession, paths: str | Iterable[str]) -> list[list[str]]:
    """A1 / A2: paths of files of one physical schema each. One job for all files; only their names reach the
    driver, which has to name them in the scans anyway. Files in a store that only Spark can open are
    looked at through Spark, a footer each."""
    got = file_schemas(list_files(spark, paths)).groupBy("shape").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups = {r["shape"]: r["paths"] for r in got if r["shape"] is not None}
    for r in got:
        if r["shape"] is None:
            for p in r["paths"]:
                groups.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    return sorted(groups.values())


def read_trips(spark: SparkSession, paths: str | Iterable[str], dataset: str, provenance: bool = True,
               schema: T.StructType | None = None, name: Callable[[Column], Column] = file_name) -> DataFrame:
    """A1/A2: Parquet scan of monthly files (a folder, a glob or a list) for one dataset,
    repaired to the declared schema, with the source file name (A3; ``name`` makes it of the path). With dataset
    ``yellow_any``, months of either era (A4) come out with the columns of both."""
    target = schema or DATASETS[dataset]
    frames = []
    for group in schema_groups(spark, paths):
        raw = spark.read.parquet(*group)
        df = conform(raw, target)
        if provenance:
            df = df.withColumn("filename", name(raw["_metadata.file_path"]))
        frames.append(df)
    if not frames:
        raise ValueError("no input files")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dense_row_id(df: DataFrame, out: str = "id") -> DataFrame:
    """Serial numbers 1 to n without a gap over the rows of file scans, in order of (path, place in the file).

    Two passes: rows per file (footers only), added up over the files before; then each row adds its own
    place. The same files give the same numbers, whatever the partitioning; only one row a file is ordered.
    ``df`` scans files (filters after the numbering leave gaps).
    """
    from ..operators.stats import split_cumsum
    from ..session import cut_lineage
    files = cut_lineage(df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n")))
    ranked = files.select("_file", "_n", F.conv(F.substring(F.hex("_file"), 1, 12), 16, 10).cast("double").alias("_head"))
    before = split_cumsum(ranked, [], "_head", ["_n"], inclusive=False, ties=["_file"]).select("_file", F.col("cum__n").alias("_before"))
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    return rows.join(before, "_file").select((F.col("_before") + F.col("_place") + 1).alias(out), *[F.col(f"`{c}`") for c in df.columns])


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True,
             names: Sequence[str] | None = None, timestamp_format: str | None = None,
             null_value: str = "") -> DataFrame:
    """CSV with a declared schema (never inferred), optional
    explicit column names, month-first timestamps, '' as null."""
    r = spark.read.schema(schema).option("header", header).option("nullValue", null_value)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    df = r.csv(path)
    return df.toDF(*names) if names else df


def parse_us_timestamp(c, fmt: str = "M/d/yyyy H:mm:ss") -> Column:
    """A10: month-first text timestamp -> timestamp_ntz."""
    return F.to_timestamp_ntz(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def read_election_results(spark: SparkSession, path: str) -> DataFrame:
    """All-text election CSV -> typed: district key = ad || ed as int,
    tally without thousands separators, candidate without its first
    parenthetical (trap T10); the text tally column is dropped (B10)."""
    from .schemas import ELECTION_CSV
    raw = read_csv(spark, path, ELECTION_CSV)
    return (raw.withColumn("election_district", F.concat("ad", "ed").cast("int"))
               .withColumn("tally", F.regexp_replace("tally_as_text", ",", "").cast("int"))
               .withColumn("candidate", F.trim(tp.replace_first("unit_name", r"\(.+?\)")))
               .drop("tally_as_text"))


def append_row_from(dim: DataFrame, source_filter: Column, overrides: dict) -> DataFrame:
    """Append one synthetic dimension row derived from an existing row."""
    extra = dim.filter(source_filter).withColumns({k: F.lit(v) for k, v in overrides.items()})
    return dim.unionByName(extra)


def dedupe_lines(df: DataFrame) -> DataFrame:
    """Raw-line set dedupe (``sort -u``)."""
    return df.dropDuplicates()


def seed_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """Literal seed table (cab types, licences, holidays, polygons)."""
    return spark.createDataFrame(rows, ddl)
