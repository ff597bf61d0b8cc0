"""Splits and samples decided by a hash of the key.

A row's side depends on its key and the seed alone, not on partitioning, row
order or column order, so every model sees the same split and no sort is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(key: Column, seed: int) -> Column:
    """32-bit hash of ``seed|key`` as bigint."""
    text = F.concat(F.lit(f"{seed}|"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``split``: ``train`` for the given share of keys (in whole percent), else ``test``."""
    side = F.when(key_hash(F.col(key), seed) % 100 < round(train * 100), "train").otherwise("test")
    return df.withColumn("split", side)


def hash_sample(
    df: DataFrame, key: str, n: int | None = None, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Bernoulli sample of keys: a ``fraction`` of them, or about ``n`` rows."""
    if (n is None) == (fraction is None):
        raise ValueError("give n or fraction")
    u = key_hash(F.col(key), seed) / F.lit(4294967296.0)
    if fraction is not None:
        return df.where(u < F.lit(float(fraction)))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    share = total.select(F.try_divide(F.least(F.lit(n).cast("bigint"), F.col("n")), F.col("n"))).scalar()
    return df.where(u < share)
