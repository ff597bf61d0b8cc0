"""Query registry and the helpers shared by Spark queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round the double columns: sums differ in their last bits between engines."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rounded_sql(sql: str, cols: Sequence[str], digits: int = DIGITS) -> str:
    """The same rounding in SQL; adding 0.0 turns a negative zero into zero."""
    parts = ", ".join(f"round({c}, {digits}) + 0.0 as {c}" for c in cols)
    return f"select * replace ({parts}) from ({sql})"
