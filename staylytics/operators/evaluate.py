"""Regression metrics, segments, error distribution and model comparison.

``preds`` maps a model name to its prediction column, so any number of models is
measured in one pass over one scored table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.operators.quantiles import quantile_table

METRICS = (
    "rmse",
    "mae",
    "r2",
    "mape",
    "actual_mean",
    "pred_mean",
    "actual_std",
    "pred_std",
    "max_error",
    "n_samples",
)


def _pct_error(actual: Column, pred: Column) -> Column:
    """Absolute percent error; null where the actual is 0."""
    return F.abs(F.try_divide(actual - pred, actual)) * 100


def _measures(actual: Column, pred: Column) -> dict[str, Column]:
    """Metrics over rows where both sides are present."""
    both = actual.isNotNull() & pred.isNotNull()
    y, p = F.when(both, actual.cast("double")), F.when(both, pred.cast("double"))
    squared = (y - p) * (y - p)
    n = F.count(y)
    total = F.when(F.min(y) < F.max(y), F.var_pop(y) * n)  # a constant actual has no R²
    return {
        "rmse": F.sqrt(F.avg(squared)),
        "mae": F.avg(F.abs(y - p)),
        "r2": F.lit(1.0) - F.try_divide(F.sum(squared), total),
        "mape": F.avg(_pct_error(y, p)),
        "actual_mean": F.avg(y),
        "pred_mean": F.avg(p),
        "actual_std": F.stddev_samp(y),
        "pred_std": F.stddev_samp(p),
        "max_error": F.max(F.abs(y - p)),
        "n_samples": n,
    }


def regression_metrics(
    df: DataFrame, actual: str, preds: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per model (and group) with every metric, from one aggregation."""
    aggs, rows = [], []
    for i, (model, pred) in enumerate(preds.items()):
        parts = _measures(F.col(actual), F.col(pred))
        aggs += [m.alias(f"{name}_{i}") for name, m in parts.items()]
        rows.append(F.struct(F.lit(model).alias("model"), *[F.col(f"{name}_{i}").alias(name) for name in METRICS]))
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def segment_metrics(
    df: DataFrame,
    actual: str,
    preds: Mapping[str, str],
    by: str,
    metrics: Sequence[str] = ("rmse", "mae"),
    order_by: str | None = None,
) -> DataFrame:
    """Rows, mean actual and ``<model>_<metric>`` per segment."""
    aggs = [F.count(F.lit(1)).alias("count"), F.avg(actual).alias("avg_price")]
    for metric in metrics:
        for model, pred in preds.items():
            aggs.append(_measures(F.col(actual), F.col(pred))[metric].alias(f"{model}_{metric}"))
    return df.groupBy(by).agg(*aggs).orderBy(order_by or by)


def with_errors(df: DataFrame, actual: str, preds: Mapping[str, str]) -> DataFrame:
    """``<model>_error`` (prediction minus actual), ``_abs_error`` and ``_error_pct``."""
    y, new = F.col(actual), {}
    for model, pred in preds.items():
        error = F.col(pred) - y
        new[f"{model}_error"] = error
        new[f"{model}_abs_error"] = F.abs(error)
        new[f"{model}_error_pct"] = F.try_divide(F.abs(error), y) * 100
    return df.withColumns(new)


def error_distribution(
    df: DataFrame, actual: str, preds: Mapping[str, str], exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Per model: mean and max absolute error, deviation of the signed error, median and 90% percent error."""
    wide = with_errors(df, actual, preds)
    rows = [
        F.struct(
            F.lit(m).alias("model"),
            F.col(f"{m}_error").alias("error"),
            F.col(f"{m}_abs_error").alias("abs_error"),
            F.col(f"{m}_error_pct").alias("error_pct"),
        )
        for m in preds
    ]
    long = wide.select(F.inline(F.array(*rows)))
    whole = [
        F.avg("abs_error").alias("avg_abs_error"),
        F.stddev_samp("error").alias("error_std"),
        F.max("abs_error").alias("max_error"),
    ]
    names = ["median_error_pct", "p90_error_pct"]
    found = quantile_table(long, "error_pct", [0.5, 0.9], ["model"], exact, accuracy, names, whole)
    return found.select("model", "avg_abs_error", "error_std", "max_error", *names)


def improvement(
    metrics: DataFrame, base: str = "baseline", other: str = "gbt", fallback: float | None = None
) -> DataFrame:
    """Percent by which ``other`` beats ``base``; positive is better for every metric.

    ``r2_gain_pct`` is the gain over a positive base R², else ``fallback``, by default null.
    """

    def of(model: str, metric: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(metric)))

    lower = [
        (F.try_divide(of(base, m) - of(other, m), of(base, m)) * 100).alias(f"{m}_improvement_pct")
        for m in ("rmse", "mae", "mape")
    ]
    gain = of(other, "r2") - of(base, "r2")
    r2 = (F.try_divide(gain, F.abs(of(base, "r2"))) * 100).alias("r2_improvement_pct")
    over = F.when(of(base, "r2") > 0, F.try_divide(gain, of(base, "r2")) * 100).otherwise(F.lit(fallback).cast("double"))
    return metrics.agg(*lower, r2, over.alias("r2_gain_pct"))


def winner(
    improvements: DataFrame, base: str = "baseline", other: str = "gbt",
    strong: float = K.STRONG_IMPROVEMENT, fair: float = K.FAIR_IMPROVEMENT,
) -> DataFrame:
    """Model with the lower RMSE and what to do: use the other, consider it, or keep the base."""
    gain = F.col("rmse_improvement_pct")
    advice = F.when(gain > strong, f"use {other}").when(gain > fair, f"consider {other}").otherwise(f"keep {base}")
    return improvements.select(
        F.when(gain > 0, other).otherwise(base).alias("winner"), advice.alias("advice"), gain
    )


def comparison(
    metrics: DataFrame,
    models: Sequence[str] = ("baseline", "gbt"),
    names: Sequence[str] = ("rmse", "mae", "r2", "mape"),
    defaults: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """One row per metric, one column per model.

    A model without a row in ``metrics`` takes its ``defaults`` (model to metric to value), where they are given.
    A metric that was computed and is undefined stays null.
    """
    defaults = defaults or {}
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])
    long = metrics.select("model", F.inline(cells))
    picked = []
    for model in models:
        own = F.col("model") == model
        fallback = F.lit(None).cast("double")
        for name, default in defaults.get(model, {}).items():
            fallback = F.when(F.col("metric") == name, F.lit(float(default))).otherwise(fallback)
        value = F.first(F.when(own, F.col("value")), ignorenulls=True)
        picked.append(F.when(F.count_if(own) > 0, value).otherwise(F.first(fallback)).alias(model))
    return long.groupBy("metric").agg(*picked)
