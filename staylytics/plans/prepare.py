"""Raw listings to the engineered feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.functions import clean_price
from staylytics.operators.cleaning import dedupe, dedupe_counting, drop_null_keys, iqr_filter
from staylytics.operators.combine import union_common, with_source_tag
from staylytics.operators.features import engineer
from staylytics.operators.geo import neighborhood_lookup
from staylytics.sources import centers_table, materialize


def clean_listings(
    df: DataFrame,
    by: Sequence[str] = ("city",),
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str | Column] | None = None,
    k: float = 1.5,
    exact: bool = True,
    accuracy: int = 10_000,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Price, drop rows without price or position, one row per listing, outliers out, all cities at once.

    ``columns`` are what the caller reads besides ``by``, ``keys`` and the price (default: all): with a few of them
    neither the shuffle nor the staged table carries the rest. ``order_by`` must then be column names.

    A listing is unique within its city. Without ``order_by`` the surviving copy is
    the one with the smallest row hash: arbitrary, but the same in every run. The
    de-duplicated table is staged, so the one wide shuffle happens once and the
    quartile passes read only city and price.
    """
    priced = df.withColumn("price_clean", clean_price("price"))
    present = drop_null_keys(priced, ["price_clean", "latitude", "longitude"])
    order = list(order_by) if order_by else ["__order"]
    if not order_by:
        present = present.withColumn("__order", F.xxhash64(*df.columns))
    kept = [*df.columns, "price_clean"] if columns is None else list(dict.fromkeys([*by, *keys, *columns, "price_clean"]))
    if columns is not None:
        present = present.select(*dict.fromkeys([*kept, *order]))
    unique = materialize(dedupe(present, [*by, *keys], order).select(*dict.fromkeys(kept)), "unique")
    return iqr_filter(unique, "price_clean", by, k, exact, accuracy)


def clean_counted(
    df: DataFrame,
    by: Sequence[str] = ("city",),
    keys: Sequence[str] = ("id",),
    order_by: Sequence[str] | None = None,
    k: float = 1.5,
    exact: bool = True,
    accuracy: int = 10_000,
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What ``clean_listings`` gives, and a table (``by``, ``__rows``) whose counts sum up to all rows of ``df``.

    ``df`` is read once: the staged table of unique listings also tells how many rows came in, so nothing
    parses raw files a second time to count them. Null columns of ``by`` are a group of their own, as in ``groupBy``.
    """
    priced = df.withColumn("price_clean", clean_price("price"))
    order = list(order_by) if order_by else ["__order"]
    if not order_by:
        priced = priced.withColumn("__order", F.xxhash64(*df.columns))
    kept = [*df.columns, "price_clean"] if columns is None else list(dict.fromkeys([*by, *keys, *columns, "price_clean"]))
    valid = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in ("price_clean", "latitude", "longitude")]
    priced = priced.withColumn("__valid", valid[0] & valid[1] & valid[2])
    narrow = priced.select(*dict.fromkeys([*kept, *order, "__valid"]))
    unique = dedupe_counting(narrow, [*by, *keys], order, by, F.col("__valid"))
    unique = materialize(unique.select(*kept, "__present", "__rows"), "unique")
    return iqr_filter(unique.where("__present").select(*kept), "price_clean", by, k, exact, accuracy), unique.select(*by, "__rows")


def unify(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All sources on their common columns, tagged by city."""
    return union_common([with_source_tag(df, "city", city) for city, df in sources.items()])


def combine_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All sources on their common columns, tagged by ``source`` and, where absent, by ``city``."""
    return union_common([with_source_tag(with_source_tag(df, "city", s), "source", s) for s, df in sources.items()])


def clean_sources(raw: DataFrame, exact: bool = True) -> DataFrame:
    """Combined sources cleaned, each against its own quartiles."""
    return clean_listings(raw, by=["source"], exact=exact)


def clean_sources_counted(raw: DataFrame, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """``clean_sources`` and the counts of the rows that came in, from one reading of the files."""
    return clean_counted(raw, by=["source"], exact=exact)


def features(df: DataFrame, as_of: Column | str | None = None, centers: DataFrame | None = None) -> DataFrame:
    return engineer(df, centers_table(df.sparkSession) if centers is None else centers, as_of)


def lookup(df: DataFrame, centers: DataFrame | None = None, decimals: int | None = None) -> DataFrame:
    if centers is None:
        centers = centers_table(df.sparkSession, cities=K.LOOKUP_CITIES)
    return neighborhood_lookup(df, centers, decimals)
