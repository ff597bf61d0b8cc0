"""The engineered feature table, built in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics import constants as K
from staylytics import functions as E


def target_column(df: DataFrame) -> str:
    return "price_clean" if "price_clean" in df.columns else "price"


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Null in numeric columns becomes ``value``; other types are left alone."""
    numeric = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return df.select(
        *[F.coalesce(F.col(c), F.lit(value).cast(numeric[c])).alias(c) if c in numeric else F.col(c) for c in df.columns]
    )


def select_features(
    df: DataFrame, keep: Sequence[str] = K.KEEP_COLUMNS, drop: Sequence[str] = K.DROP_COLUMNS
) -> DataFrame:
    """Must-keep columns first, then the others in their order, less ``drop`` and ``*_date``."""
    first = [c for c in keep if c in df.columns]
    rest = [c for c in df.columns if c not in first and c not in drop and not c.endswith("_date")]
    return df.select(*first, *rest)


def with_center(
    df: DataFrame,
    centers: DataFrame,
    key: str = "city",
    default: float | None = None,
    lat: str = "center_lat",
    lng: str = "center_lng",
) -> DataFrame:
    """Attach the centre of each row's city; an unknown city gets ``default`` (null if none).

    ``centers`` is ``city, center_lat, center_lng``. Its size decides the join: the
    literal table is broadcast, a table above the threshold is shuffled.
    """
    side = centers.select(F.col("city").alias("__city"), F.col("center_lat").alias(lat), F.col("center_lng").alias(lng))
    out = df.join(side, df[key] == F.col("__city"), "left").drop("__city")
    if default is None:
        return out
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(float(default))) for c in (lat, lng)})


def host_features(cols: Sequence[str], as_of: Column | str | None = None) -> dict[str, Column]:
    out = {f"{c}_clean": E.percent(c) for c in K.PERCENT_COLUMNS if c in cols}
    out |= {f"{c}_binary": E.flag_tf(c) for c in K.HOST_FLAG_COLUMNS if c in cols}
    if "host_since" in cols:
        out["host_days_active"] = E.days_since("host_since", as_of)
    return out


def property_features(cols: Sequence[str]) -> dict[str, Column]:
    out = {c: E.to_int(c) for c in K.CAPACITY_COLUMNS if c in cols}
    if "bathrooms_text" in cols:
        out["bathrooms_numeric"] = E.first_number("bathrooms_text")
    elif "bathrooms" in cols:
        out["bathrooms_numeric"] = E.to_double("bathrooms")
    return out


def amenity_features(cols: Sequence[str], col: str = "amenities", word_boundary: bool = False) -> dict[str, Column]:
    if col not in cols:
        return {}
    flags = {name: E.keyword_flag(col, p, word_boundary) for name, p in K.AMENITY_PATTERNS.items()}
    return {"amenities_count": E.list_size(col)} | flags


def availability_features(cols: Sequence[str]) -> dict[str, Column]:
    out = {c: E.to_int(c) for c in K.AVAILABILITY_COLUMNS if c in cols}
    for days in (30, 365):
        name = f"availability_{days}"
        if name in cols:
            out[f"availability_rate_{days}"] = E.rate(out[name], days)
    if "instant_bookable" in cols:
        out["instant_bookable_binary"] = E.flag_tf("instant_bookable")
    return out


def review_features(cols: Sequence[str]) -> dict[str, Column]:
    out = {c: E.to_int(c) for c in K.REVIEW_COUNT_COLUMNS if c in cols}
    scores = {f"{c}_clean": E.to_double(c) for c in K.REVIEW_SCORE_COLUMNS if c in cols}
    out |= scores
    if scores:
        out["avg_review_score"] = E.row_mean(list(scores.values()))
    if "reviews_per_month" in cols:
        out["reviews_per_month"] = E.to_double("reviews_per_month")
    if "number_of_reviews" in cols:
        out["has_reviews"] = E.positive_flag(out["number_of_reviews"])
    return out


def text_features(cols: Sequence[str]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if "name" in cols:
        out["name_length"] = E.text_length("name")
        out["name_word_count"] = E.word_count("name")
    if "description" in cols:
        out["description_length"] = E.text_length("description")
    return out


def price_features(cols: Sequence[str], price: Column) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if "accommodates" in cols:
        out["price_per_person"] = E.guarded_ratio(price, E.to_int("accommodates"))
    if "bedrooms" in cols:
        out["price_per_bedroom"] = E.guarded_ratio(price, E.to_int("bedrooms"))
    if "room_type" in cols:
        out |= E.one_hot("room_type", K.ROOM_TYPES)
    return out


def engineer(df: DataFrame, centers: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """All features of every listing; a feature whose input column is absent is left out.

    One broadcast join for the centres and one projection over it: no shuffle.
    ``as_of`` fixes the day that host age is counted to (today by default).
    """
    cols = df.columns
    if "city" not in cols:
        raise ValueError("listings need a city column")
    new: dict[str, Column] = {}
    if "price" in cols and "price_clean" not in cols:
        new["price_clean"] = E.price_fallback("price")
    price = new.get("price_clean", F.col("price_clean"))
    new |= host_features(cols, as_of)
    new |= property_features(cols)
    new |= amenity_features(cols)
    new |= availability_features(cols)
    new |= review_features(cols)
    new |= text_features(cols)
    new["distance_to_center"] = E.planar_miles("latitude", "longitude", "__clat", "__clng")
    new |= price_features(cols, price)
    placed = with_center(df, centers, "city", 0.0, "__clat", "__clng")
    table = placed.select(
        *[new[c].alias(c) if c in new else F.col(c) for c in cols],
        *[e.alias(c) for c, e in new.items() if c not in cols],
    )
    return fill_numeric(select_features(table))
