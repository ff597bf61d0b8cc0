"""Engineered features and geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics import functions as E
from staylytics.functions import clean_price
from staylytics.operators import features as ops
from staylytics.operators import geo
from staylytics.plans import prepare
from staylytics.sources import centers_table
from workload.adapters import REQUESTS_SQL, listings, requests, stage
from workload.clean import WITH_CLEAN, WITH_L, WITH_PRICED, cleaned
from workload.registry import query, rounded, rounded_sql, table

AS_OF = "2024-01-01"


def priced(spark, sf_dir):
    return listings(spark, sf_dir).withColumn("price_clean", clean_price("price"))


def engineered(spark, sf_dir):
    """The stored feature table of cleaned listings that profiling and models read."""
    return stage(spark, sf_dir, "engineered", lambda: prepare.features(cleaned(spark, sf_dir), AS_OF))


# --- the same expressions in SQL --------------------------------------------------
def _int(c: str) -> str:
    return f"cast(trunc(try_cast({c} as double)) as int)"


def _flags(text: str) -> dict[str, str]:
    clean = f"lower(regexp_replace({text}, '[\\[\\]{{}}\"]', '', 'g'))"
    return {n: f"case when regexp_matches({clean}, '{p}') then 1 else 0 end" for n, p in K.AMENITY_PATTERNS.items()}


def _parts(text: str, sep: str) -> str:
    return f"cast(case when {text} is null then -1 else len(string_split({text}, '{sep}')) end as int)"


def _center(i: int, centers) -> str:
    return "case city " + " ".join(f"when '{c}' then {v[i]}" for c, v in centers.items()) + " else {default} end"


def _columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in parts.items())


HOST = {
    "host_response_rate_clean": "case when host_response_rate is null then 0.0::double else try_cast(replace(host_response_rate, '%', '') as double) / 100.0 end",
    "host_is_superhost_binary": "case when host_is_superhost = 't' then 1 else 0 end",
    "host_days_active": f"cast(coalesce(date_diff('day', try_cast(host_since as date), date '{AS_OF}'), 0) as int)",
}
CAPACITY = {c: _int(c) for c in ("accommodates", "bedrooms")}
BATHS = {"bathrooms_numeric": "try_cast(regexp_extract(bathrooms_text, '(\\d+\\.?\\d*)', 1) as double)"}
AMENITIES = {"amenities_count": _parts("regexp_replace(amenities, '[\\[\\]{}\"]', '', 'g')", ",")} | _flags("amenities")
AVAILABILITY = {c: _int(c) for c in ("availability_30", "availability_365")}
RATES = {f"availability_rate_{d}": f"{_int(f'availability_{d}')} / {d}.0::double" for d in (30, 365)}
COUNTS = {"number_of_reviews": _int("number_of_reviews")}
SCORES = {f"{c}_clean": f"try_cast({c} as double)" for c in ("review_scores_rating", "review_scores_location")}
REVIEWS = SCORES | {
    "avg_review_score": "(coalesce(try_cast(review_scores_rating as double), 0) + coalesce(try_cast(review_scores_location as double), 0)) / 2.0",
    "has_reviews": f"case when {_int('number_of_reviews')} > 0 then 1 else 0 end",
}
TEXT = {"name_length": "cast(length(name) as int)", "name_word_count": _parts("name", " ")}
_LAT, _LNG = (_center(i, K.FEATURE_CENTERS).format(default=0) for i in (0, 1))
DISTANCE = {"distance_to_center": f"sqrt(pow((latitude - ({_LAT})) * 69.0, 2) + pow((longitude - ({_LNG})) * 54.6, 2))"}


def _ratio(den: str) -> str:
    return f"case when {_int(den)} > 0 then price_clean / {_int(den)} else price_clean end"


PRICES = {"price_per_person": _ratio("accommodates"), "price_per_bedroom": _ratio("bedrooms")}
ROOMS = {n: f"case when room_type = '{v}' then 1 else 0 end" for n, v in K.ROOM_TYPES.items()}


# --- one query per feature group --------------------------------------------------
@query(rounded_sql(f"{WITH_L} select id, {_columns(HOST)} from l", ["host_response_rate_clean"]))
def host_features(spark, sf_dir):
    df = listings(spark, sf_dir)
    return rounded(df.select("id", *[e.alias(n) for n, e in ops.host_features(df.columns, AS_OF).items()]))


@query(
    rounded_sql(
        f"{WITH_PRICED} select id, {_columns(CAPACITY | BATHS | PRICES | ROOMS)} from p",
        ["bathrooms_numeric", "price_per_person", "price_per_bedroom"],
    )
)
def property_features(spark, sf_dir):
    df = priced(spark, sf_dir)
    parts = ops.property_features(df.columns) | ops.price_features(df.columns, F.col("price_clean"))
    return rounded(df.select("id", *[e.alias(n) for n, e in parts.items()]))


@query(f"{WITH_L} select id, {_columns(AMENITIES)} from l")
def amenity_features(spark, sf_dir):
    df = listings(spark, sf_dir)
    return df.select("id", *[e.alias(n) for n, e in ops.amenity_features(df.columns).items()])


_DOC_PARTS = {"amenities_count": _parts("regexp_replace(text, '[\\[\\]{}\"]', '', 'g')", ",")} | _flags("text")


@query(f"select doc_id, {_columns(_DOC_PARTS)} from documents")
def amenity_words_in_documents(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", *[e.alias(n) for n, e in ops.amenity_features(df.columns, "text").items()])


@query(
    rounded_sql(
        f"{WITH_L} select id, {_columns(AVAILABILITY | RATES | COUNTS | REVIEWS)} from l",
        [*RATES, *SCORES, "avg_review_score"],
    )
)
def availability_review_features(spark, sf_dir):
    df = listings(spark, sf_dir)
    parts = ops.availability_features(df.columns) | ops.review_features(df.columns)
    return rounded(df.select("id", *[e.alias(n) for n, e in parts.items()]))


@query(f"{WITH_L} select id, {_columns(TEXT)} from l")
def text_features(spark, sf_dir):
    df = listings(spark, sf_dir)
    return df.select("id", *[e.alias(n) for n, e in ops.text_features(df.columns).items()])


@query(f"select doc_id, cast(length(text) as int) as text_length, {_parts('text', ' ')} as word_count from documents")
def document_lengths(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", E.text_length("text").alias("text_length"), E.word_count("text").alias("word_count"))


@query(rounded_sql(f"{WITH_L} select id, city, {_columns(DISTANCE)} from l", ["distance_to_center"]))
def distance_miles(spark, sf_dir):
    df = ops.with_center(listings(spark, sf_dir), centers_table(spark), "city", 0.0)
    miles = E.planar_miles("latitude", "longitude", "center_lat", "center_lng")
    return rounded(df.select("id", "city", miles.alias("distance_to_center")))


# name -> SQL of every engineered column; numeric ones have null replaced by 0
_TEXT_COLUMNS = ("city", "neighbourhood_cleansed", "property_type", "room_type", "price")
_OTHER_TEXT = ("host_since", "host_response_rate", "host_is_superhost", "bathrooms_text", "review_scores_rating", "review_scores_location", "name")
FEATURE_SQL = (
    HOST | CAPACITY | BATHS | AMENITIES | AVAILABILITY | RATES | COUNTS | REVIEWS | TEXT | DISTANCE | PRICES | ROOMS
)
NUMERIC_SQL = {c: f"coalesce({c}, 0)" for c in ("id", "latitude", "longitude", "price_clean")} | {
    n: f"coalesce({e}, 0)" for n, e in FEATURE_SQL.items()
}
_DOUBLES = ["latitude", "longitude", "price_clean", "host_response_rate_clean", "bathrooms_numeric", *RATES, *SCORES,
            "avg_review_score", *DISTANCE, *PRICES]
# the order in which the feature table has its columns
ENGINEERED_COLUMNS = [
    "id", "latitude", "longitude", *_TEXT_COLUMNS, "price_clean", "host_since", "host_response_rate", "host_is_superhost",
    *CAPACITY, "bathrooms_text", *AVAILABILITY, *COUNTS, "review_scores_rating", "review_scores_location", "name",
    *HOST, *BATHS, *AMENITIES, *RATES, *REVIEWS, *TEXT, *DISTANCE, *PRICES, *ROOMS,
]
_ENGINEERED = _columns({c: NUMERIC_SQL.get(c, c) for c in ENGINEERED_COLUMNS})
# of every listing as it is, and of the cleaned ones
RAW_ENGINEERED_SQL = f"{WITH_PRICED} select {_ENGINEERED} from p"
ENGINEERED_SQL = f"{WITH_CLEAN} select {_ENGINEERED} from c"
ENGINEERED_TEXT = [*_TEXT_COLUMNS, *_OTHER_TEXT]


@query(rounded_sql(RAW_ENGINEERED_SQL, _DOUBLES))
def engineered_features(spark, sf_dir):
    return rounded(prepare.features(priced(spark, sf_dir), AS_OF))


# --- geography ----------------------------------------------------------------------
_LOOKUP_CENTERS = {c: K.FEATURE_CENTERS[c] for c in K.LOOKUP_CITIES}
_CLAT, _CLNG = (_center(i, _LOOKUP_CENTERS).format(default="null") for i in (0, 1))
LOOKUP_SQL = f"""{WITH_L}, g as (select city, neighbourhood_cleansed, round(avg(latitude), 6) as lat, round(avg(longitude), 6) as lng, count(*) as n
      from l where city is not null and neighbourhood_cleansed is not null group by all)
select *, round(111.32 * sqrt(pow(lat - ({_CLAT}), 2) + pow((lng - ({_CLNG})) * cos(radians(lat)), 2)), 6) as dist_km from g"""


def lookup(spark, sf_dir):
    return prepare.lookup(listings(spark, sf_dir), decimals=6)


@query(LOOKUP_SQL)
def neighborhood_lookup(spark, sf_dir):
    return lookup(spark, sf_dir)


NEAREST_SQL = f"""select r.*, k.neighbourhood_cleansed, k.lat, k.lng, k.n, k.dist_km
from ({REQUESTS_SQL}) r left join ({LOOKUP_SQL}) k on k.city = r.city
qualify row_number() over (partition by r.request_id order by abs(k.dist_km - r.distance_to_center) nulls last, k.n desc, k.neighbourhood_cleansed) = 1"""


@query(f"select request_id, city, distance_to_center, neighbourhood_cleansed, lat, lng, n, dist_km from ({NEAREST_SQL})")
def nearest_neighborhood(spark, sf_dir):
    asked = requests(spark, sf_dir).select("request_id", "city", "distance_to_center")
    side = lookup(spark, sf_dir)
    return geo.nearest_in_group(asked, side, "city", "distance_to_center", "dist_km", "n", ["neighbourhood_cleansed"])


@query(
    """with s as (select n_name as nation, s_suppkey, s_acctbal from supplier join nation on s_nationkey = n_nationkey),
c as (select c_custkey, n_name as nation, c_acctbal from customer join nation on c_nationkey = n_nationkey)
select c_custkey, c.nation, c_acctbal, s_suppkey, s_acctbal from c left join s on s.nation = c.nation
qualify row_number() over (partition by c_custkey order by abs(s_acctbal - c_acctbal) nulls last, s_suppkey desc) = 1"""
)
def nearest_supplier_by_balance(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("nation"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    left = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select("c_custkey", "nation", "c_acctbal")
    right = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select("nation", "s_suppkey", "s_acctbal")
    return geo.nearest_in_group(left, right, "nation", "c_acctbal", "s_acctbal", "s_suppkey")
