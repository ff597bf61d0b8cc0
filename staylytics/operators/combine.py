"""Put sources and prediction sets together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_source_tag(df: DataFrame, name: str, tag: str) -> DataFrame:
    """Add the constant column ``name`` unless the table has it."""
    return df if name in df.columns else df.withColumn(name, F.lit(tag))


def union_common(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables on the columns they share, in name order."""
    if not dfs:
        raise ValueError("no tables to combine")
    common = sorted(set.intersection(*(set(d.columns) for d in dfs)))
    return reduce(DataFrame.unionByName, [d.select(*common) for d in dfs])


def join_predictions(
    dfs: Mapping[str, DataFrame], key: str, keep: Sequence[str] = (), prediction: str = "prediction"
) -> DataFrame:
    """Inner join of scored tables on ``key``; each prediction is renamed to its mapping key.

    ``keep`` columns come from the first table. Only the projected columns reach
    the shuffle. Where one DataFrame can be scored by every model in turn, do that
    instead and spare the join.
    """
    (first, head), *rest = dfs.items()
    out = head.select(key, *keep, F.col(prediction).alias(first))
    for name, df in rest:
        out = out.join(df.select(key, F.col(prediction).alias(name)), key, "inner")
    return out
