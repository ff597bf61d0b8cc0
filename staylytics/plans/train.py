"""Train, score and compare the price models on one shared split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.functions import band
from staylytics.operators import evaluate, models, profile, results, selection
from staylytics.operators.cleaning import quantile_trim
from staylytics.operators.split import hash_split
from staylytics.sources import literal_table, materialize

PREDS = {"baseline": "baseline_pred", "gbt": "gbt_pred"}


@dataclass(frozen=True)
class Features:
    numeric: list[str]
    categorical: list[str]

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def _learned(df: DataFrame, key: str) -> DataFrame:
    """The training side of the shared split: test rows have no say in what is chosen."""
    return hash_split(df, key).where("split = 'train'").drop("split")


def baseline_features(df: DataFrame, target: str = "price_clean", key: str = "id") -> Features:
    """The numeric columns most correlated with the target, and every category column that passes the gate, on training rows only."""
    names = selection.select_numeric(df, target, limit=None)
    rows = _learned(df, key)
    ranking = materialize(profile.correlations(rows, target, names), "ranking")
    chosen = Features(selection.select_numeric(df, target, ranking=ranking), selection.select_categorical(rows, limit=None))
    selection.assert_no_leak(chosen.all)
    return chosen


def explain_features(df: DataFrame, key: str = "id") -> Features:
    """One list for both explained models, so that their importances rank the same features."""
    numeric = selection.select_preferred(df, banned=K.EXPLAIN_BANNED, min_n=0)
    chosen = Features(numeric, selection.select_categorical(_learned(df, key), K.EXPLAIN_CATEGORICAL))
    selection.assert_no_leak(chosen.all)
    return chosen


def gbt_features(df: DataFrame, key: str = "id") -> Features:
    chosen = Features(selection.select_preferred(df), selection.select_categorical(_learned(df, key), K.GBT_CATEGORICAL))
    selection.assert_no_leak(chosen.all)
    return chosen


def features_table(spark: SparkSession, chosen: Mapping[str, Features]) -> DataFrame:
    """What was chosen for each model, as a table to store beside the fitted models."""
    rows = [
        (model, kind, i, name)
        for model, features in chosen.items()
        for kind in ("numeric", "categorical")
        for i, name in enumerate(getattr(features, kind))
    ]
    return literal_table(spark, rows, "model string, kind string, position int, feature string")


def stored_features(table: DataFrame, model: str) -> Features:
    """The features of one model out of a stored :func:`features_table`."""
    rows = table.where(F.col("model") == model).orderBy("position").collect()
    numeric, categorical = ([r["feature"] for r in rows if r["kind"] == kind] for kind in ("numeric", "categorical"))
    return Features(numeric, categorical)


def training_rows(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "id",
    target: str = "price_clean",
    lo: float = 0.01,
    hi: float = 0.99,
    exact: bool = True,
) -> DataFrame:
    """Trimmed, split and cut down to the columns that models and segments read."""
    wanted = dict.fromkeys([key, target, *columns, "city", "room_type", "accommodates"])
    narrow = df.select(*[c for c in wanted if c in df.columns])
    return hash_split(quantile_trim(narrow, target, lo, hi, exact=exact), key)


def training_table(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """``training_rows`` stored by split: fitting passes over this narrow table many times,
    and a pass over one side reads that side's files only."""
    return materialize(training_rows(df, columns, **options), "training", ["split"])


def train_baseline(table: DataFrame, features: Features, target: str = "price_clean", trim=(0.025, 0.975)) -> PipelineModel:
    """Linear model; its training rows are trimmed further than the shared table."""
    rows = table if trim is None else quantile_trim(table, target, *trim)
    return models.fit(models.linear_pipeline(features.numeric, features.categorical, target), rows)


def train_gbt(table: DataFrame, features: Features, target: str = "price_clean", **params) -> PipelineModel:
    return models.fit(models.gbt_pipeline(features.numeric, features.categorical, target, **params), table)


def score_models(fitted: Mapping[str, PipelineModel], table: DataFrame) -> DataFrame:
    """Predictions of all models side by side (``<model>_pred``), stored once for the many reports."""
    return materialize(models.score_all({f"{m}_pred": model for m, model in fitted.items()}, table), "scored")


def compare_runs(before: DataFrame, after: DataFrame, pred: str = "gbt_pred", key: str = "id", actual: str = "price_clean") -> DataFrame:
    """Rows that two runs scored, with both predictions and by how much the absolute error changed (negative is better).

    Over two tables of ``write_bucketed`` with one number of buckets the join needs no shuffle.
    """
    old = before.select(key, F.col(pred).alias("before"))
    both = after.select(key, actual, F.col(pred).alias("after")).join(old, key)
    change = F.abs(F.col("after") - F.col(actual)) - F.abs(F.col("before") - F.col(actual))
    return both.select(key, actual, "before", "after", change.alias("abs_error_change"))


def reports(scored: DataFrame, actual: str = "price_clean", preds: Mapping[str, str] = PREDS) -> dict[str, DataFrame]:
    """Every comparison table over the scored test rows."""
    scored = scored.withColumn("price_range", band(actual, K.PRICE_BOUNDS, K.PRICE_RANGE_LABELS))
    test = scored.where("split = 'test'") if "split" in scored.columns else scored
    metrics = evaluate.regression_metrics(test, actual, preds)
    better = evaluate.improvement(metrics)
    split_metrics = (
        evaluate.regression_metrics(scored, actual, preds, ["split"]) if "split" in scored.columns else metrics
    )
    return {
        "metrics_by_split": split_metrics,
        "metrics": metrics,
        "improvement": better,
        "winner": evaluate.winner(better),
        "comparison": evaluate.comparison(metrics),
        "city_performance": evaluate.segment_metrics(test, actual, preds, "city"),
        "room_type_performance": evaluate.segment_metrics(test, actual, preds, "room_type", ["rmse"], "avg_price"),
        "price_range_performance": evaluate.segment_metrics(
            test, actual, preds, "price_range", ["rmse", "mape"], "avg_price"
        ),
        "error_distribution": evaluate.error_distribution(test, actual, preds),
        "sample_predictions": results.first_rows(
            test.select("id", actual, *preds.values(), "city", "room_type", "accommodates"), "id", 1000
        ),
    }

