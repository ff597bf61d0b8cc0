"""Explain the fitted models on their own test rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.operators import curves as curves_of
from staylytics.operators import explain
from staylytics.operators.models import feature_names
from staylytics.operators.results import top_k
from staylytics.sources import materialize

POSITIONS = (0, 25, 50, 100, 200)


def interpret(
    linear: PipelineModel,
    trees: PipelineModel,
    table: DataFrame,
    key: str = "id",
    target: str = "price_clean",
    positions: Sequence[int] = POSITIONS,
    top: int = 20,
    curves: int = 6,
    curve_side: str | None = "train",
    store: Callable[[DataFrame, str], DataFrame] = materialize,
) -> dict[str, DataFrame]:
    """Attributions, importances, local explanations, dependence curves and the model comparison.

    Attributions cover every test row. ``store`` writes them once, since several
    reports read them; curves use the ``curves`` strongest features of the tree model and the rows of
    ``curve_side`` (all rows if it is None).
    """
    rows = table.where("split = 'test'") if "split" in table.columns else table
    by_line = store(explain.linear_attributions(linear, rows, key, [target]), "linear_attributions")
    by_tree = store(explain.tree_attributions(trees, rows, key, [target]), "tree_attributions")
    line_rank, tree_rank = explain.attribution_importance(by_line), explain.attribution_importance(by_tree)
    out = {
        "linear_attributions": by_line,
        "tree_attributions": by_tree,
        "linear_importance": line_rank,
        "tree_importance": tree_rank,
        "feature_importance_comparison": explain.compare_importances(tree_rank, line_rank),
        "local_explanations": explain.local_explanation(
            by_tree, key, explain.keys_at(rows, key, positions), top, [target]
        ),
    }
    behind = table if curve_side is None or "split" not in table.columns else table.where(F.col("split") == curve_side)
    inputs = [c for c in feature_names(trees) if not c.endswith("_indexed")]
    strongest = [r["feature"] for r in top_k(tree_rank, "importance", curves, then="feature").collect()]
    columns = [name if name in inputs else name.removesuffix("_indexed") for name in strongest]
    for column, curve in curves_of.tree_dependence(trees, behind, columns).items():
        out[f"dependence_{column}"] = curve
    return out
