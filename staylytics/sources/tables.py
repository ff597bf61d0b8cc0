"""Table readers and writers: CSV, parquet, JSON."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.constants import FEATURE_CENTERS
from staylytics.sources.staging import materialize

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path or glob matches something, on any file system Spark can reach."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(jvm_path)
    return matches is not None and len(matches) > 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path``, in order, on any file system Spark can reach."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"missing input: {path}")
    names = (s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory())
    return sorted(n for n in names if not n.startswith((".", "_")))


def _beside(path: str, mark: str) -> str:
    """A hidden folder beside ``path``: readers of the parent folder pass over it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}-{mark}" if parent else f".{name}-{mark}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; a target that exists is deleted first."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``. The old one is moved aside, so that one of the two always exists whole."""
    old = _beside(path, "old")
    if path_exists(spark, path):
        _rename(spark, path, old)
    _rename(spark, fresh, path)
    _delete(spark, old)
    spark.catalog.refreshByPath(path)


def _present(spark: SparkSession, paths: Iterable[str], on_missing: str) -> list[str]:
    if on_missing not in ("fail", "skip"):
        raise ValueError(f"on_missing must be 'fail' or 'skip', not {on_missing!r}")
    found, missing = [], []
    for path in paths:
        (found if path_exists(spark, path) else missing).append(path)
    if missing and on_missing == "fail":
        raise FileNotFoundError(f"missing input: {', '.join(missing)}")
    if not found:
        raise FileNotFoundError("none of the inputs exists")
    return found


def read_listings(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    on_missing: str = "fail",
    multi_line: bool = True,
) -> DataFrame:
    """Listing CSV with a header, every column as string.

    ``multi_line`` lets a quoted field hold line breaks, but then one file is one
    task: deliver a large source as many files, or pass ``False`` when no field
    holds a line break, so that Spark can split the files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(_present(spark, paths, on_missing))


def read_sources(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", on_missing: str = "skip", **kwargs
) -> dict[str, DataFrame]:
    """One DataFrame per source name; absent sources are skipped, but not all of them."""
    found = set(_present(spark, paths.values(), on_missing))
    read = (lambda p: read_listings(spark, p, **kwargs)) if fmt == "csv" else (lambda p: read_table(spark, p, fmt))
    return {name: read(path) for name, path in paths.items() if path in found}


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    empty_schema: T.StructType | str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read the first of ``path`` that exists; with ``empty_schema`` an absent table is an empty one."""
    candidates = [path] if isinstance(path, str) else list(path)
    for wanted in candidates:
        # a job that died while it replaced a table left the old one beside
        candidate = next((p for p in (wanted, _beside(wanted, "old")) if path_exists(spark, p)), None)
        if candidate is not None:
            reader = spark.read
            if schema is not None:
                reader = reader.schema(schema)
            if fmt == "csv":
                reader = reader.options(**CSV_OPTIONS).option("multiLine", True)
            return reader.format(fmt).load(candidate)
    if empty_schema is None:
        raise FileNotFoundError(f"missing input: {', '.join(candidates)}")
    return spark.createDataFrame([], empty_schema)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    max_records_per_file: int | None = None,
    rebalance: bool = False,
) -> None:
    """Overwrite ``path``: write beside it, then switch folders.

    A job that fails leaves the old table as it was, and ``df`` may read the table that it replaces. A DataFrame
    built on the old files before must be read anew. The switch is two renames, so on a store where
    renaming copies it takes time; a reader that meets the moment between them finds the old table beside (``read_table``).

    File count follows the plan's partitions; ``max_records_per_file`` bounds the
    size of each file without another shuffle. ``rebalance`` adds one, for
    a partitioning with many values: small ones then share a task, and adaptive
    execution splits one that holds much of the table. With few values each task
    writes large files anyway and the shuffle would be wasted.

    ``single_file`` gives one file, written by one task: ask for it only where the rows are
    bounded, as those of a metrics table are. The table is staged first, so only that last copy is one task.
    """
    if single_file:
        df = materialize(df, "single").coalesce(1)
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    fresh = _beside(path, uuid.uuid4().hex)
    try:
        writer.save(fresh)
    except Exception:
        _delete(df.sparkSession, fresh)
        raise
    _replace(df.sparkSession, fresh, path)


def write_bucketed(df: DataFrame, path: str, by: str, buckets: int) -> DataFrame:
    """Overwrite ``path`` with a parquet table hashed by ``by`` into ``buckets`` sorted files, and return the scan of it.

    Two such tables with the same number of buckets join and group by ``by`` without a shuffle. The one
    shuffle is here. Choose ``buckets`` by the table's size (about 0.2 to 1 GB each). The layout is kept in the column's
    metadata, so :func:`read_bucketed` needs the path only. A key with a large share of the rows makes one large file: use it for keys.
    """
    spark, fresh = df.sparkSession, _beside(path, uuid.uuid4().hex)
    name = f"staylytics_{uuid.uuid4().hex}"
    marked = df.withMetadata(by, {**df.schema[by].metadata, "buckets": buckets})
    writer = marked.repartition(buckets, by).write.format("parquet").bucketBy(buckets, by).sortBy(by)
    try:
        writer.option("path", fresh).saveAsTable(name)
    except Exception:
        _delete(spark, fresh)
        raise
    finally:
        spark.sql(f"drop table if exists {name}")
    _replace(spark, fresh, path)
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`write_bucketed` wrote, with its layout known to the planner (an external table of this session)."""
    schema = spark.read.parquet(path).schema
    layout = [(f.name, f.metadata["buckets"]) for f in schema.fields if "buckets" in f.metadata]
    if not layout:
        raise ValueError(f"not a bucketed table: {path}")
    (by, buckets), name = layout[0], f"staylytics_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    layout = f"clustered by (`{by}`) sorted by (`{by}`) into {buckets} buckets"
    spark.sql(f"create table {name} ({columns}) using parquet {layout} location '{where}'")
    return spark.table(name)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small table of given rows: model coefficients, parameters, constants."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def centers_table(
    spark: SparkSession,
    centers: Mapping[str, tuple[float, float]] | None = None,
    cities: Sequence[str] | None = None,
) -> DataFrame:
    """City centres as a table ``city, center_lat, center_lng``, built from literals."""
    centers = FEATURE_CENTERS if centers is None else centers
    names = list(centers) if cities is None else [c for c in cities if c in centers]
    rows = []
    for c in names:
        lat, lng = centers[c]
        rows.append(F.struct(F.lit(c).alias("city"), F.lit(lat).alias("center_lat"), F.lit(lng).alias("center_lng")))
    return spark.range(1).select(F.inline(F.array(*rows)))
