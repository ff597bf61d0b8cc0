"""Ratios, flags, bands and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylytics.constants import FEATURE_CATEGORIES, OTHER_CATEGORY
from staylytics.functions.parse import as_column


def rate(col: Column | str, n: float) -> Column:
    return as_column(col) / F.lit(float(n))


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean over a row's columns; null counts as 0 and still divides."""
    total = reduce(lambda a, b: a + b, [F.coalesce(as_column(c), F.lit(0.0)) for c in cols])
    return total / F.lit(float(len(cols)))


def positive_flag(col: Column | str) -> Column:
    return F.when(as_column(col) > 0, 1).otherwise(0)


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` where ``den`` is positive, else ``num`` itself."""
    n, d = as_column(num), as_column(den)
    return F.when(d > 0, n / d).otherwise(n)


def one_hot(col: Column | str, values: Mapping[str, str]) -> dict[str, Column]:
    """One 0/1 column per ``{output name: value}``."""
    return {name: F.when(as_column(col) == value, 1).otherwise(0) for name, value in values.items()}


def band(col: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound above the value, the last label from the top bound on."""
    c = as_column(col)
    out = F.lit(labels[-1])
    for bound, label in reversed(list(zip(bounds, labels))):
        out = F.when(c < bound, label).otherwise(out)
    return out


def feature_category(col: Column | str, categories: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Group a feature name by the words in it; the first group with a hit wins."""
    name = F.lower(as_column(col))
    out = F.lit(OTHER_CATEGORY)
    for label, words in reversed(list((categories or FEATURE_CATEGORIES).items())):
        hit = reduce(lambda a, b: a | b, [name.contains(w) for w in words])
        out = F.when(hit, label).otherwise(out)
    return out


def pretty(col: Column | str) -> Column:
    """``has_wifi`` to ``Has Wifi``."""
    return F.initcap(F.replace(as_column(col), F.lit("_"), F.lit(" ")))
