"""Dependence curves of boosted trees, for any number of features in one pass over the rows.

A leaf's tests split each feature's values into few codes. With feature ``f`` set to a value, a row reaches a leaf if it passes the
leaf's tests on all *other* features and the value passes the one on ``f``. So a curve needs of each leaf only how many rows pass everything, and how
many fail nothing but ``f``; both are counted for all features together, from the same patterns of passed tests that
attributions use. A task adds up its leaves by feature and code and hands on these few sums; rows are neither repeated nor scored again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import prod

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.operators.explain import Lookup, cells, coded_rows, encode, leaves_of, lookup, patterns
from staylytics.operators.models import feature_names
from staylytics.operators.quantiles import quantile_table
from staylytics.sources.staging import materialize
from staylytics.sources.tables import literal_table

_TILE_ROWS = 1 << 15


def curve_sums(x: np.ndarray, ready: Lookup, slots: Sequence[int]) -> dict[int, np.ndarray]:
    """For each feature of ``slots`` the sum of the rows' predictions with it set to each of its codes (one code if no leaf tests it)."""
    reached = {f: np.zeros(t.shape[0]) for f, t in ready.tests.items() if f in slots}  # by the feature's test: outputs of rows that pass all others
    every = {f: np.zeros(t.shape[0]) for f, t in ready.tests.items() if f in slots}  # outputs of rows that pass that one too
    codes = coded_rows(x, ready)
    constant = ready.constant * len(x)
    for unit in ready.units:
        rows = np.bincount(cells(unit, codes), minlength=prod(unit.shape)).reshape(unit.shape)
        for output, part, m, pattern in zip(unit.output.tolist(), unit.parts(), unit.sizes, patterns(unit, ready)):
            tests = unit.tests[part].tolist()
            full = (1 << m) - 1
            tested = {axis for axis, _ in tests}
            own = rows.sum(axis=tuple(i for i in range(rows.ndim) if i not in tested), keepdims=True)
            passed = np.bincount(pattern.ravel(), weights=own.ravel(), minlength=1 << m)
            constant += output * passed[full]
            for i, (axis, test) in enumerate(tests):
                f = unit.features[axis]
                if f in reached:
                    reached[f][test] += output * (passed[full] + passed[full ^ (1 << i)])
                    every[f][test] += output * passed[full]
    out = {f: np.full(1, constant) for f in slots}
    for f, sums in reached.items():
        out[f] = constant - every[f].sum() + sums @ ready.tests[f]
    return out


def _sums(model: PipelineModel, df: DataFrame, slots: Sequence[int], ready: Lookup) -> DataFrame:
    """(slot, code, total, n): sums of predictions over the rows that count for the slot.

    As in the model, a row with a missing number is left out, but not for the curve of the feature that is missing, which is set.
    """
    shared = df.sparkSession.sparkContext.broadcast(ready)
    names = feature_names(model)
    cells = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names])

    def tile(x: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        lost = np.isnan(x).sum(axis=1)
        whole = x[lost == 0]
        if len(whole):
            yield from ((f, s, len(whole)) for f, s in curve_sums(whole, shared.value, slots).items())
        for f in slots:
            own = x[(lost == 1) & np.isnan(x[:, f])]
            if len(own):
                own[:, f] = 0.0
                yield f, curve_sums(own, shared.value, [f])[f], len(own)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        total: dict[int, tuple[np.ndarray, int]] = {}

        def add() -> None:
            for f, s, n in tile(np.concatenate(held)):
                before, many = total.get(f, (0.0, 0))
                total[f] = (before + s, many + n)
            held.clear()

        for frame in frames:
            if len(frame):
                held.append(np.stack(frame["x"].to_numpy()))
                if sum(map(len, held)) >= _TILE_ROWS:
                    add()
        if held:
            add()
        for f, (s, n) in total.items():
            yield pd.DataFrame({"slot": f, "code": np.arange(len(s)), "total": s, "n": n})

    parts = encode(model, df).select(cells.alias("x")).mapInPandas(run, "slot int, code int, total double, n long")
    return parts.groupBy("slot", "code").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def grids(df: DataFrame, features: Sequence[str], points: int = 100, lo: float = 0.05, hi: float = 0.95, exact: bool = True) -> dict[str, list]:
    """The values at which each feature's curve is taken.

    A feature's own values where there are fewer than ``points``, else ``points`` even steps between two quantiles. Distinct values are
    counted for all features in one scan, and listed in another one where they are few; the quantiles of all others take two scans.
    """
    rough = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(features)]).first()
    few = [c for i, c in enumerate(features) if rough[i] <= 2 * points]
    listed = df.agg(*[F.array_sort(F.collect_set(c)).alias(f"c{i}") for i, c in enumerate(few)]).first() if few else ()
    out = {c: list(listed[i]) for i, c in enumerate(few) if 0 < len(listed[i]) < points}
    many = [c for c in features if c not in out]
    ends = quantile_table(df, many, [lo, hi], (), exact).first() if many else ()
    for k, c in enumerate(many):
        low, high = ends[2 * k], ends[2 * k + 1]
        out[c] = [low + (high - low) * i / (points - 1) for i in range(points)]
    return out


def tree_dependence(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    points: int = 100,
    lo: float = 0.05,
    hi: float = 0.95,
    exact: bool = True,
) -> dict[str, DataFrame]:
    """``feature, value, avg_prediction`` of each feature: the mean prediction with it set to each grid value for every row.

    The rows pass once, whatever the number of features and grid values. Features are named as columns of ``df``; a category column stands
    for its indexed slot.
    """
    names, spark = feature_names(model), df.sparkSession
    labels: dict[str, list[str]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            labels.update(zip(stage.getInputCols(), map(list, stage.labelsArray)))
    slots = {c: names.index(f"{c}_indexed" if c in labels else c) for c in features}
    ready = lookup(leaves_of(spark, model))
    sums = materialize(_sums(model, df, sorted(set(slots.values())), ready), "dependence")
    at, out = grids(df, features, points, lo, hi, exact), {}
    for c, f in slots.items():
        value = np.array([labels[c].index(v) if v in labels[c] else len(labels[c]) for v in at[c]] if c in labels else at[c], dtype=float)
        if f not in ready.cuts:
            codes = np.zeros(len(value), dtype=int)
        elif ready.cuts[f] is None:
            codes = np.clip(value, 0, ready.tests[f].shape[1] - 1).astype(int)
        else:
            codes = np.searchsorted(ready.cuts[f], value)
        kind = dict(df.dtypes)[c] if not isinstance(at[c][0], float) else "double"
        grid = literal_table(spark, list(zip(at[c], codes.tolist())), f"value {kind}, code int")
        own = sums.where(F.col("slot") == f).select("code", (F.col("total") / F.col("n")).alias("avg_prediction"))
        out[c] = grid.join(own, "code").select(F.lit(c).alias("feature"), "value", "avg_prediction")
    return out
