"""Session helpers.

``get_spark`` builds a session with the settings the operators assume
(UTC session zone, AQE with skew-join handling, UI off). On a cluster the
caller's session is used as is; ``ensure_checkpoint_dir`` only sets a
checkpoint folder when the cluster has not named one in
``spark.checkpoint.dir`` (tests and local runs).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "tripkit",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, from ``spark.checkpoint.dir``.

    Only a local master may leave the setting out (tests); there a fresh scratch
    folder is used. On a cluster an unset folder is an error: a path on the
    driver's disk would be invisible to the executors.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        return cur
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {master})")
    path = tempfile.mkdtemp(prefix="tripkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``checkpoint()`` at the shared folder and return that folder."""
    path = shared_dir(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as committed Parquet files in the shared folder, read back: lineage ends there, a lost
    executor repeats nothing, and the planner knows the size (a checkpoint has no statistics)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_out(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt over the cores by ``cols``: a table small as a file is read by one task, which then does all
    work per row alone. The number is given, as sizes would merge the partitions again."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *cols)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
