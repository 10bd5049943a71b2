"""Tables that follow their source files: atomic reloads and roll-ups kept in step.

Every load writes its rows under a folder of its own and then appends one small
file to a log, naming for each source file the load that now holds it. Readers
follow the log, so a load is visible as a whole or not at all: a failure before
the log entry leaves the old rows, and a repeated load only adds a folder that
replaces the one before. Several tables (facts and their roll-ups) go into one
log entry, so they never disagree. A roll-up is stored per source file; a reload
recomputes the contribution of the reloaded files alone, and readers add the
files up. One writer at a time; readers need no lock. Folders that the log no
longer names can be removed at any time (``unused_loads`` lists them).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version long, load string, table string, file string, kept boolean"


class ManagedTables:
    """Tables under ``root``, keyed by source file (column ``file_column``)."""

    def __init__(self, spark: SparkSession, root: str, file_column: str = "filename"):
        self.spark, self.root, self.file_column = spark, root.rstrip("/"), file_column

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def current(self, table: str | None = None) -> DataFrame:
        """(table, file, load, kept): the load that holds each source file; not ``kept``: the file has no rows."""
        log = self._log() if table is None else self._log().where(F.col("table") == table)
        return (log.groupBy("table", "file").agg(F.max(F.struct("version", "load", "kept")).alias("last"))
                .select("table", "file", "last.load", "last.kept"))

    def write(self, tables: dict[str, DataFrame]) -> str:
        """First half of a load: the rows of each table, evaluated once, under a new load. Not visible yet."""
        load = uuid.uuid4().hex
        for name, rows in tables.items():
            rows.write.partitionBy(self.file_column).parquet(f"{self.root}/{name}/load={load}")
        return load

    def commit(self, load: str, tables: Iterable[str], files: Iterable[str] = ()) -> None:
        """Second half: one log file makes the load visible. ``files`` names the files reloaded; one without
        rows in the load loses its old ones. Others are taken from the folders written."""
        version = (self._log().agg(F.max("version")).first()[0] or 0) + 1
        entries = []
        for name in tables:
            written = {r[0] for r in self._rows(name, load).select(self.file_column).distinct().collect()}  # one value per reloaded file
            entries += [(version, load, name, f, f in written) for f in sorted(written | set(files))]
        if entries:
            self.spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def replace(self, tables: dict[str, DataFrame], files: Iterable[str] = ()) -> None:
        """Load: the rows of each table replace those of the same source files, all at once."""
        self.commit(self.write(tables), tables, files)

    def _rows(self, table: str, load: str) -> DataFrame:
        path = f"{self.root}/{table}/load={load}"
        try:
            rows = self.spark.read.option("basePath", path).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return self.spark.createDataFrame([], f"{self.file_column} string")  # a load without rows
        return rows.withColumn(self.file_column, F.col(self.file_column).cast("string"))

    def read(self, table: str) -> DataFrame:
        """The rows of the current loads; folders of other loads are not scanned."""
        held: dict[str, list[str]] = {}
        for r in self.current(table).where("kept").collect():  # one row per source file
            held.setdefault(r["load"], []).append(r["file"])
        if not held:
            raise ValueError(f"table {table} has no rows")
        mine = F.lit(False)
        for load, files in held.items():
            mine = mine | ((F.col("load") == load) & F.col(self.file_column).cast("string").isin(files))
        path = f"{self.root}/{table}"
        rows = self.spark.read.option("basePath", path).parquet(*[f"{path}/load={load}" for load in held]).where(mine)
        return rows.drop("load").withColumn(self.file_column, F.col(self.file_column).cast("string"))

    def unused_loads(self, table: str) -> DataFrame:
        """(load) folders of ``table`` that no reader follows any more, or never did."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.root}/{table}")
        found = files.select(F.regexp_extract("path", "/load=([0-9a-f]{32})/", 1).alias("load")).distinct()
        return found.join(self.current(table).where("kept"), "load", "left_anti")


def replace_with_rollups(tables: ManagedTables, name: str, facts: DataFrame, rollups: dict[str, Callable[[DataFrame], DataFrame]],
                         files: Iterable[str] = ()) -> None:
    """Reload source files and their contribution to every roll-up in one commit.

    ``rollups``: table -> function of the facts that groups by the file column among others. The facts are
    evaluated once: roll-ups are computed from the rows just written.
    """
    load = tables.write({name: facts})
    new = tables._rows(name, load)
    if set(new.columns) == {tables.file_column}:  # no rows: an empty table of the same shape
        new = facts.limit(0)
    for table, roll in rollups.items():
        roll(new).write.partitionBy(tables.file_column).parquet(f"{tables.root}/{table}/load={load}")
    tables.commit(load, [name, *rollups], files)
