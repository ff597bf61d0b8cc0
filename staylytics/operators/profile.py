"""Profiling reports. Each report is one aggregation over the table, not one job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from staylytics.operators.quantiles import quantile_table


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long(one_row: DataFrame, names: Sequence[str], fields: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Turn one wide row into a row per name: ``fields`` maps output column to column prefix."""
    rows = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{p}{i}").alias(f) for f, p in fields.items()])
        for i, n in enumerate(names)
    ]
    return one_row.select(*keep, F.inline(F.array(*rows)))


def row_stats(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def type_census(df: DataFrame) -> DataFrame:
    """Columns per type, with the table's row count beside."""
    names = sorted({f.dataType.simpleString() for f in df.schema.fields})
    counts = [sum(f.dataType.simpleString() == n for f in df.schema.fields) for n in names]
    rows = [F.struct(F.lit(n).alias("type"), F.lit(c).cast("bigint").alias("columns")) for n, c in zip(names, counts)]
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(F.array(*rows)))


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("count")).orderBy(by)


def group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count of values, mean, min and max per group."""
    return (
        df.groupBy(by)
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("avg_price"),
            F.min(value).alias("min_price"),
            F.max(value).alias("max_price"),
        )
        .orderBy(by)
    )


def null_profile(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Null count and percent of the columns that have nulls, most first."""
    names = df.columns
    counts = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]
    one = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    out = _long(one, names, {"nulls": "n"}, ["total"]).where("nulls > 0")
    out = out.select("column", "nulls", (F.col("nulls") / F.col("total") * 100).alias("null_pct"))
    out = out.orderBy(F.desc("nulls"), "column")
    return out if top is None else out.limit(top)


def target_summary(df: DataFrame, col: str, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Mean, sample deviation, range and quartiles of one column, as one row."""
    whole = [F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max")]
    names = ["q1", "median", "q3"]
    found = quantile_table(df, col, [0.25, 0.5, 0.75], (), exact, accuracy, names, whole)
    return found.select("mean", "std", "min", "max", *names)


def correlations(
    df: DataFrame, target: str, cols: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Correlation of ``target`` with each numeric column, all from one scan; undefined ones left out.

    Pairs with a missing side do not count. A constant column has no correlation;
    range, not deviation, tells it, since merging partial means can leave a deviation
    of a rounding error instead of 0. Each row becomes one (column, value) pair per column and each task
    folds them into one partial result per column: unlike one aggregate per column
    side by side, the generated code does not grow with the number of columns.
    """
    names = [c for c in (numeric_columns(df) if cols is None else cols) if c != target][:limit]
    values = F.array(*[F.col(c).cast("double") for c in names])
    pairs = df.select(F.col(target).cast("double").alias("t"), F.posexplode(values).alias("i", "x"))
    varies = (F.min("t") < F.max("t")) & (F.min("x") < F.max("x"))
    spread = F.when(varies, F.stddev_pop("t") * F.stddev_pop("x"))
    found = pairs.where("t is not null and x is not null").groupBy("i").agg(
        F.try_divide(F.covar_pop("t", "x"), spread).alias("correlation")
    )
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return found.where("correlation is not null").select(label.alias("column"), "correlation")


def top_correlations(corr: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest and the ``k`` lowest correlations, tagged by side.

    ``corr`` has one row per column, so ranking it twice in one task is cheap, and
    the aggregation behind it runs once.
    """
    high = F.row_number().over(Window.orderBy(F.desc("correlation"), "column"))
    low = F.row_number().over(Window.orderBy("correlation", "column"))
    ranked = corr.withColumns({"__high": high, "__low": low})
    sides = F.array(F.when(F.col("__high") <= k, "positive"), F.when(F.col("__low") <= k, "negative"))
    tagged = ranked.withColumn("side", F.explode(F.array_compact(sides)))
    return tagged.select("column", "correlation", "side").orderBy(F.desc("side"), F.desc("correlation"), "column")


def category_summary(df: DataFrame, by: str, value: str, top: int | None = None) -> DataFrame:
    """Rows and mean value per category, largest first."""
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("listings"), F.avg(value).alias("avg_price"))
    out = out.orderBy(F.desc("listings"), by)
    return out if top is None else out.limit(top)


def top_categories(df: DataFrame, by: str, top: int = 10) -> DataFrame:
    """The most frequent categories."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), by).limit(top)


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, min and max per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"a{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
    return _long(df.agg(*aggs), cols, {"avg": "a", "min": "l", "max": "h"})


def flag_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percent of all rows where each 0/1 column is 1."""
    aggs = [F.count_if(F.col(c) == 1).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("total"), *aggs)
    share = F.try_divide(F.col("ones") * F.lit(100.0), F.col("total"))
    return _long(one, cols, {"ones": "n"}, ["total"]).select("column", share.alias("pct"))


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct values per column, null counting as one value.

    Exact counting first reduces each task's rows to its distinct (column, value)
    pairs. ``approx`` uses a fixed-size sketch per column and needs no such shuffle.
    """
    names = list(cols)
    if approx:
        aggs = []
        for i, c in enumerate(names):
            aggs.append((F.approx_count_distinct(c, rsd) + F.max(F.col(c).isNull().cast("int"))).alias(f"d{i}"))
        return _long(df.agg(*aggs), names, {"n_distinct": "d"})
    pairs = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(names)]
    seen = df.select(F.inline(F.array(*pairs))).distinct()
    counted = seen.groupBy("i").agg(F.count(F.lit(1)).alias("n_distinct"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return counted.select(label.alias("column"), "n_distinct")
