"""Quotes for every request."""

from __future__ import annotations

from staylytics import constants as K
from staylytics.operators import evaluate, pricing
from workload.adapters import REQUESTS_SQL, requests
from workload.evaluate import PREDS, WITH_SCORED, scored
from workload.features import LOOKUP_SQL, lookup
from workload.registry import query, rounded, rounded_sql

_AMENITIES = " + ".join(f"case when {c} = 1 then {v} else 0 end" for c, v in K.QUOTE_RULES["amenity_values"].items())
_PRICE = """room_base * (1 + (accommodates - 2) * 0.15::double) * (1 + bedrooms * 0.08::double) * (1 + (bathrooms - 1) * 0.06::double)
  * location_factor + amenity_value"""


def quote_sql(base: str, requests_sql: str = REQUESTS_SQL, join: str = "", lead: str = "") -> str:
    """The quote in SQL; ``base`` is the base price expression."""
    return f"""{lead}
r as (select q.*, {base} as base0 from ({requests_sql}) q {join}),
f as (select *, base0 * case room_type when 'Entire home/apt' then 1.0::double when 'Private room' then 0.58::double when 'Shared room' then 0.38::double end as room_base,
  greatest(0.6::double, 1.2::double - distance_to_center * 0.04::double) as location_factor, cast({_AMENITIES} as int) as amenity_value from r),
p as (select *, ({_PRICE}) * case when host_is_superhost = 1 then 1.12::double else 1 end * case when instant_bookable = 1 then 1.04::double else 1 end
  * case when number_of_reviews > 100 then 1.08::double when number_of_reviews > 50 then 1.04::double when number_of_reviews < 5 then 0.92::double else 1 end as raw from f)
select * exclude (base0, room_base, raw), case when raw is not null then greatest(25.0::double, raw) end as predicted_price,
  raw * (2 - 0.693::double - 0.22::double) as confidence_lower, raw * (0.693::double + 0.22::double) as confidence_upper,
  least(raw * (2 - 0.693::double - 0.22::double), raw * (0.693::double + 0.22::double)) as confidence_low,
  greatest(raw * (2 - 0.693::double - 0.22::double), raw * (0.693::double + 0.22::double)) as confidence_high,
  case when raw < 75 then 'Budget-Friendly' when raw < 150 then 'Mid-Range' when raw < 250 then 'Premium' when raw is not null then 'Luxury' end as market_position,
  case when raw < 75 then '🟢' when raw < 150 then '🟡' when raw < 250 then '🟠' when raw is not null then '🔴' end as market_color,
  room_base as base_price, 0.693::double as confidence_factor from p"""


_DOUBLES = ["bathrooms", "distance_to_center", "predicted_price", "confidence_lower", "confidence_upper", "confidence_low",
            "confidence_high", "location_factor", "base_price", "confidence_factor"]
_FIXED = "case q.city when 'nyc' then 185.0::double when 'london' then 142 when 'amsterdam' then 230 when 'barcelona' then 165 else 150 end"
_PRICED = f"{WITH_SCORED}, bp as (select city, avg(price_clean) as avg_price from s group by city),"


@query(rounded_sql(quote_sql(_FIXED, lead="with"), _DOUBLES))
def price_quote(spark, sf_dir):
    return rounded(pricing.quote(requests(spark, sf_dir)))


def base_prices(spark, sf_dir):
    return evaluate.segment_metrics(scored(spark, sf_dir), "price_clean", PREDS, "city")


# p is taken by the listings there, so the quote starts from a nested query
_WITH_AVERAGES = f"(select * from ({_PRICED.rstrip(',')} select city, avg_price from bp)) a"


@query(rounded_sql(quote_sql(f"coalesce(a.avg_price, {_FIXED})", join=f"left join {_WITH_AVERAGES} on a.city = q.city", lead="with"), _DOUBLES))
def price_quote_by_segment(spark, sf_dir):
    return rounded(pricing.quote(requests(spark, sf_dir), base_prices(spark, sf_dir)))


@query(
    rounded_sql(
        f"""with q as ({quote_sql(_FIXED, lead='with')}), k as ({LOOKUP_SQL})
select q.*, k.neighbourhood_cleansed as mapped_neighborhood, coalesce(k.dist_km, q.distance_to_center) as mapped_distance,
k.lat as mapped_lat, k.lng as mapped_lng from q left join k on k.city = lower(q.city)
qualify row_number() over (partition by q.request_id order by abs(k.dist_km - q.distance_to_center) nulls last, k.n desc, k.neighbourhood_cleansed) = 1""",
        [*_DOUBLES, "mapped_distance", "mapped_lat", "mapped_lng"],
    )
)
def quote_with_location(spark, sf_dir):
    return rounded(pricing.quote_with_location(requests(spark, sf_dir), lookup(spark, sf_dir)))
