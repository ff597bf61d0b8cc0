"""Row cleaning: null keys, duplicates, outliers, keep rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylytics.operators.quantiles import attach, quantile_table


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are all present (NaN counts as absent)."""
    return df.na.drop(subset=list(cols))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose columns are all not null."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, so the survivor is always the same.

    The ``= 1`` test on the row number is pushed below the shuffle as a group limit:
    each task sends at most one row per key, however often a key repeats.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def dedupe_counting(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], by: Sequence[str], present: Column) -> DataFrame:
    """``dedupe`` of the rows where ``present`` holds, with ``__present`` and ``__rows``: how many rows each one stands for.

    The other rows come back as one row per group of ``by``, ``__present`` false and everything but ``by`` null. So ``__rows``
    sums up to all rows that came in, and one pass both cleans and counts. Both parts are combined in each task before the shuffle.
    """
    held = F.coalesce(present, F.lit(False))
    rest = [c for c in keys if c not in by]
    tagged = df.select(*by, held.alias("__present"), *[F.when(held, F.col(c)).alias(f"__key_{i}") for i, c in enumerate(rest)],
                       F.when(held, F.struct(*df.columns)).alias("__row"), F.struct(*order_by).alias("__first"))
    grouped = tagged.groupBy(*by, "__present", *[f"__key_{i}" for i in range(len(rest))])
    one = grouped.agg(F.min_by("__row", "__first").alias("__row"), F.count(F.lit(1)).alias("__rows"))
    columns = [F.col(c) if c in by else F.col("__row")[c].alias(c) for c in df.columns]
    return one.select(*columns, "__present", "__rows")


def iqr_filter(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    k: float = 1.5,
    exact: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Keep values within ``k`` interquartile ranges of the quartiles, ends included."""
    q = quantile_table(df, value, [0.25, 0.75], by, exact, accuracy, ["__q1", "__q3"])
    reach = F.lit(float(k)) * (F.col("__q3") - F.col("__q1"))
    bounds = q.select(*by, (F.col("__q1") - reach).alias("__lo"), (F.col("__q3") + reach).alias("__hi"))
    return _within(df, value, bounds, by)


def quantile_trim(
    df: DataFrame,
    value: str,
    lo: float,
    hi: float,
    by: Sequence[str] = (),
    exact: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Keep values between two quantiles, ends included; null values go."""
    return _within(df, value, quantile_table(df, value, [lo, hi], by, exact, accuracy, ["__lo", "__hi"]), by)


def _within(df: DataFrame, value: str, bounds: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        # one stored row: as literals the bounds are pushed into the scan
        row = bounds.select("__lo", "__hi").first()
        if row is None or row["__lo"] is None:
            return df.where(F.lit(False))
        return df.where((F.col(value) >= F.lit(row["__lo"])) & (F.col(value) <= F.lit(row["__hi"])))
    kept = attach(df, bounds, list(by)).where((F.col(value) >= F.col("__lo")) & (F.col(value) <= F.col("__hi")))
    return kept.drop("__lo", "__hi")


def keep_rate(before: DataFrame, after: DataFrame, by: Sequence[str] = (), counted: str | None = None) -> DataFrame:
    """Rows before, rows after and percent kept, per group; an empty input gives a null rate.

    With ``counted`` that column of ``before`` tells how many rows each of its rows stands for.
    """
    one = F.count(F.lit(1))
    rows = one if counted is None else F.sum(counted).cast("bigint")
    sides = [
        before.groupBy(*by).agg(rows.alias("rows_before"), F.lit(0).cast("bigint").alias("rows_after")),
        after.groupBy(*by).agg(F.lit(0).cast("bigint").alias("rows_before"), one.alias("rows_after")),
    ]
    total = sides[0].unionByName(sides[1]).groupBy(*by)
    out = total.agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
    return out.withColumn("keep_pct", F.try_divide(F.col("rows_after") * F.lit(100.0), F.col("rows_before")))
