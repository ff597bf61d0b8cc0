"""Rule-based price quotes for a table of requests."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.functions.shape import band
from staylytics.operators.geo import nearest_in_group
from staylytics.sources.staging import materialize


def _table_value(col: Column, table: Mapping[str, float]) -> Column:
    """Value of a small fixed table by key; null for an unknown key."""
    pairs = [F.lit(x) for k, v in table.items() for x in (k, float(v))]
    return F.element_at(F.create_map(*pairs), col)


def quote(
    requests: DataFrame,
    base_prices: DataFrame | None = None,
    rules: Mapping | None = None,
    r2: float | Column = K.DEFAULT_R2,
) -> DataFrame:
    """Add the price, its interval, market band and components to each request.

    ``base_prices`` (``city, avg_price``) overrides the fixed base prices by city.
    The override is stored first, so its true size (a row per city) picks the join
    and the requests stay where they are. An unknown room type gives a null price. The raw interval ends can be in
    reverse order; ``confidence_low/high`` are the ordered pair.
    """
    rules = K.QUOTE_RULES if rules is None else rules
    r2 = F.lit(float(r2)) if isinstance(r2, (int, float)) else r2
    base = F.coalesce(_table_value(F.col("city"), rules["base_prices"]), F.lit(float(rules["base_default"])))
    df, cols = requests, requests.columns
    if base_prices is not None:
        side = base_prices.select(F.col("city").alias("__city"), F.col("avg_price").alias("__avg"))
        side = materialize(side, "base-prices")
        df = df.join(side, df["city"] == F.col("__city"), "left")
        base = F.coalesce(F.col("__avg"), base)

    room_base = base * _table_value(F.col("room_type"), rules["room_factors"])
    distance = F.col("distance_to_center")
    slope = F.lit(rules["location_top"]) - distance * rules["location_step"]
    location = F.when(distance.isNotNull(), F.greatest(F.lit(rules["location_floor"]), slope))
    amenities = reduce(
        lambda a, b: a + b,
        [F.when(F.col(c).cast("int") == 1, v).otherwise(0) for c, v in rules["amenity_values"].items() if c in cols],
        F.lit(0),
    )
    price = room_base
    price = price * (1 + (F.col("accommodates") - rules["free_guests"]) * rules["guest_step"])
    price = price * (1 + F.col("bedrooms") * rules["bedroom_step"])
    price = price * (1 + (F.col("bathrooms") - rules["free_bathrooms"]) * rules["bathroom_step"])
    price = price * location + amenities
    for flag, factor in rules["flag_factors"].items():
        if flag in cols:
            price = price * F.when(F.col(flag).cast("int") == 1, factor).otherwise(1.0)
    reviews = F.col("number_of_reviews")
    (many, up2), (some, up1), (few, down) = rules["review_many"], rules["review_some"], rules["review_few"]
    price = price * F.when(reviews > many, up2).when(reviews > some, up1).when(reviews < few, down).otherwise(1.0)

    priced = df.select(
        *[df[c] for c in cols],
        price.alias("__price"),
        location.alias("location_factor"),
        amenities.alias("amenity_value"),
        room_base.alias("base_price"),
        r2.alias("confidence_factor"),
    )
    p, r, margin = F.col("__price"), F.col("confidence_factor"), rules["interval_margin"]
    return priced.select(
        *cols,
        F.when(p.isNotNull(), F.greatest(F.lit(float(rules["minimum_price"])), p)).alias("predicted_price"),
        (p * (2 - r - margin)).alias("confidence_lower"),
        (p * (r + margin)).alias("confidence_upper"),
        F.least(p * (2 - r - margin), p * (r + margin)).alias("confidence_low"),
        F.greatest(p * (2 - r - margin), p * (r + margin)).alias("confidence_high"),
        F.when(p.isNotNull(), band(p, K.PRICE_BOUNDS, K.MARKET_LABELS)).alias("market_position"),
        F.when(p.isNotNull(), band(p, K.PRICE_BOUNDS, K.MARKET_COLORS)).alias("market_color"),
        "location_factor",
        "amenity_value",
        "base_price",
        "confidence_factor",
    )


def quote_with_location(
    requests: DataFrame,
    lookup: DataFrame,
    base_prices: DataFrame | None = None,
    rules: Mapping | None = None,
    r2: float | Column = K.DEFAULT_R2,
) -> DataFrame:
    """Quote plus the neighbourhood of the city (in lower case) whose distance is nearest to the request's."""
    side = lookup.select(
        F.lower("city").alias("__key"),
        F.col("neighbourhood_cleansed").alias("mapped_neighborhood"),
        F.col("dist_km").alias("__km"),
        F.col("n").alias("__n"),
        F.col("lat").alias("mapped_lat"),
        F.col("lng").alias("mapped_lng"),
    )
    priced = quote(requests, base_prices, rules, r2)
    cols = priced.columns
    placed = nearest_in_group(
        priced.withColumn("__key", F.lower("city")), side, "__key", "distance_to_center", "__km", "__n", ["mapped_neighborhood"]
    )
    distance = F.coalesce(F.col("__km"), F.col("distance_to_center")).alias("mapped_distance")
    return placed.select(*cols, "mapped_neighborhood", distance, "mapped_lat", "mapped_lng")
