"""Column expressions: ``Column -> Column``, built-in functions only, no UDF."""

from staylytics.functions.geo import planar_km, planar_miles
from staylytics.functions.parse import (
    clean_price,
    days_since,
    first_number,
    flag_tf,
    keyword_flag,
    list_size,
    list_text,
    percent,
    price_fallback,
    text_length,
    to_double,
    to_int,
    word_count,
)
from staylytics.functions.shape import (
    band,
    feature_category,
    guarded_ratio,
    one_hot,
    positive_flag,
    pretty,
    rate,
    row_mean,
)

__all__ = [
    "band",
    "clean_price",
    "days_since",
    "feature_category",
    "first_number",
    "flag_tf",
    "guarded_ratio",
    "keyword_flag",
    "list_size",
    "list_text",
    "one_hot",
    "percent",
    "planar_km",
    "planar_miles",
    "positive_flag",
    "pretty",
    "price_fallback",
    "rate",
    "row_mean",
    "text_length",
    "to_double",
    "to_int",
    "word_count",
]
