"""Small result tables: ranking, metrics records, categories, key figures."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.functions.shape import feature_category
from staylytics.sources.tables import literal_table

METRIC_SCHEMA = "run string, model string, split string, segment string, metric string, value double"


def metrics_table(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Metric records as the long table ``run, model, split, segment, metric, value``."""
    names = [f.split()[0] for f in METRIC_SCHEMA.split(", ")]
    return literal_table(spark, ([r.get(n) for n in names] for r in records), METRIC_SCHEMA)


def metrics_long(metrics: DataFrame, run: str, split: str | None = None, segment: str | None = None) -> DataFrame:
    """A wide metrics table (one row per model) in the long form."""
    names = [c for c in metrics.columns if c not in ("model", split, segment)]
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    side = F.col(split) if split else F.lit(None).cast("string")
    part = F.col(segment) if segment else F.lit(None).cast("string")
    return metrics.select(
        F.lit(run).alias("run"), "model", side.alias("split"), part.alias("segment"), F.inline(cells)
    )


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, absolute: bool = False, then: str | None = None) -> DataFrame:
    """First ``k`` rows by one column (by its size with ``absolute``); each task keeps only ``k``."""
    key = F.abs(by) if absolute else F.col(by)
    order = [key.asc() if ascending else key.desc()] + ([F.col(then)] if then else [])
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest keys: the same sample every time."""
    return df.orderBy(key).limit(n)


def importance_by_category(df: DataFrame, value: str = "importance") -> DataFrame:
    """Sum, mean and count of feature importance per feature group."""
    grouped = df.groupBy(feature_category("feature").alias("category"))
    return grouped.agg(F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.count(value).alias("count"))


def kpis(importance: DataFrame, city_segments: DataFrame) -> DataFrame:
    """Number of features and of cities."""
    features = importance.agg(F.count(F.lit(1)).alias("features"))
    return features.withColumn("cities", city_segments.agg(F.count_distinct("city")).scalar())
