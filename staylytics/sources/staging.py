"""Stage intermediate tables in the folder the cluster shares.

A staged table is plain parquet, so it outlives any executor, cuts the lineage,
and gives the planner a real size: a staged table below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is joined by
shuffle (with adaptive skew handling). No operator forces a broadcast by hint.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Files that a task holds open while it writes a partitioned table; a task that meets more values sorts the rest of its rows.
_OPEN_FILES = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

_local_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a fresh local folder only in local mode without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_root[app] = tempfile.mkdtemp(prefix="staylytics-")
    return _local_root[app]


def _app_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/staylytics/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{_app_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and return the scan of it.

    With ``partition_by`` a task keeps a file open for each of up to ``_OPEN_FILES`` values instead of putting its rows in order first.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_WRITERS)
    if partition_by:
        spark.conf.set(_WRITERS, _OPEN_FILES)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(_WRITERS, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; call when no DataFrame built on them is needed any more."""
    remove(spark, _app_root(spark))
