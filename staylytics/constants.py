"""Fixed values shared by the operators.

Every table below is a fixed value: results are only right when it holds exactly
these numbers, names and patterns. Operators take them as default arguments, so
a caller can pass other ones.
"""

# --- location -------------------------------------------------------------------
# City centres (latitude, longitude) used for the distance feature.
FEATURE_CENTERS = {
    "nyc": (40.7580, -73.9855),
    "london": (51.5074, -0.1278),
    "amsterdam": (52.3676, 4.9041),
    "barcelona": (41.3851, 2.1734),
    "paris": (48.8566, 2.3522),
}
# Cities for which the neighbourhood table has a centre.
LOOKUP_CITIES = ("nyc", "london", "amsterdam", "barcelona")
MILES_PER_LAT_DEGREE = 69.0
MILES_PER_LNG_DEGREE = 54.6
KM_PER_DEGREE = 111.32

# --- listing columns ------------------------------------------------------------
ROOM_TYPES = {
    "is_entire_home": "Entire home/apt",
    "is_private_room": "Private room",
    "is_shared_room": "Shared room",
}
AMENITY_PATTERNS = {
    "has_wifi": "wifi|internet|wi-fi",
    "has_kitchen": "kitchen",
    "has_ac": "air conditioning|ac|a/c",
    "has_heating": "heating|heat",
    "has_washer": "washer|laundry",
    "has_parking": "parking",
    "has_tv": "tv|television",
    "has_pool": "pool",
    "has_gym": "gym|fitness",
}
PERCENT_COLUMNS = ("host_response_rate", "host_acceptance_rate")
HOST_FLAG_COLUMNS = ("host_is_superhost", "host_has_profile_pic", "host_identity_verified")
CAPACITY_COLUMNS = ("accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights")
AVAILABILITY_COLUMNS = ("availability_30", "availability_60", "availability_90", "availability_365")
REVIEW_COUNT_COLUMNS = ("number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d")
REVIEW_SCORE_COLUMNS = (
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
)
KEEP_COLUMNS = (
    "id",
    "latitude",
    "longitude",
    "city",
    "neighbourhood_cleansed",
    "property_type",
    "room_type",
    "price",
    "price_clean",
)
DROP_COLUMNS = ("amenities", "amenities_cleaned")

# --- feature selection ----------------------------------------------------------
LEAKY_FEATURES = ("price_per_person", "price_per_bedroom")
BASELINE_BANNED = (
    "price_per_bedroom",
    "price_per_person",
    "price",
    "id",
    "listing_url",
    "scrape_id",
    "name",
    "description",
)
BASELINE_SKIP_WORDS = ("url", "name", "description", "about")
TOP_UP_SKIP_WORDS = ("id", "url", "name", "description", "price_per")
EXPLAIN_BANNED = ("price_per_bedroom", "price_per_person", "price")
PREFERRED_NUMERIC = (
    "accommodates",
    "bedrooms",
    "bathrooms_numeric",
    "beds",
    "minimum_nights",
    "maximum_nights",
    "availability_30",
    "availability_60",
    "availability_90",
    "availability_365",
    "number_of_reviews",
    "distance_to_center",
    "amenities_count",
    "host_days_active",
    "host_response_rate_clean",
    "host_acceptance_rate_clean",
    "review_scores_rating_clean",
    "review_scores_location_clean",
    "review_scores_cleanliness_clean",
    "host_is_superhost_binary",
    "instant_bookable_binary",
    "has_wifi",
    "has_kitchen",
    "has_ac",
    "has_parking",
    "has_reviews",
)
GBT_CATEGORICAL = ("city", "room_type", "property_type")
EXPLAIN_CATEGORICAL = ("room_type", "city")

# --- reporting ------------------------------------------------------------------
PRICE_BOUNDS = (75, 150, 250)
PRICE_RANGE_LABELS = ("Budget (<$75)", "Mid-range ($75-150)", "Premium ($150-250)", "Luxury (>$250)")
MARKET_LABELS = ("Budget-Friendly", "Mid-Range", "Premium", "Luxury")
MARKET_COLORS = ("🟢", "🟡", "🟠", "🔴")
# Feature groups, first match wins; anything else is OTHER_CATEGORY.
FEATURE_CATEGORIES = {
    "Host Quality": ("host", "superhost"),
    "Review Metrics": ("review", "rating"),
    "Amenities": ("amenity", "wifi", "kitchen"),
    "Property Size": ("bedroom", "bathroom", "accommodate"),
    "Location": ("distance", "city", "location"),
}
OTHER_CATEGORY = "Other"
# Shown when a metric was never written.
DEFAULT_METRICS = {
    "baseline": {"rmse": 89.45, "mae": 67.23, "r2": 0.462, "mape": 34.56},
    "gbt": {"rmse": 52.34, "mae": 38.91, "r2": 0.693, "mape": 18.72},
}
DEFAULT_R2_IMPROVEMENT = 50.0
# Rank-difference limits when two importance tables are compared.
SAME_RANK = 3
DIFFERENT_RANK = 5
# Improvement limits (percent) for the recommendation.
STRONG_IMPROVEMENT = 10
FAIR_IMPROVEMENT = 5

# --- price quotes ---------------------------------------------------------------
DEFAULT_R2 = 0.693
QUOTE_RULES = {
    "base_prices": {"nyc": 185, "london": 142, "amsterdam": 230, "barcelona": 165},
    "base_default": 150,
    "room_factors": {"Entire home/apt": 1.0, "Private room": 0.58, "Shared room": 0.38},
    "guest_step": 0.15,
    "free_guests": 2,
    "bedroom_step": 0.08,
    "bathroom_step": 0.06,
    "free_bathrooms": 1,
    "location_top": 1.2,
    "location_step": 0.04,
    "location_floor": 0.6,
    "amenity_values": {
        "has_wifi": 8,
        "has_kitchen": 15,
        "has_ac": 12,
        "has_parking": 18,
        "has_pool": 25,
        "has_gym": 15,
    },
    "flag_factors": {"host_is_superhost": 1.12, "instant_bookable": 1.04},
    # more than 100 reviews, more than 50, fewer than 5
    "review_many": (100, 1.08),
    "review_some": (50, 1.04),
    "review_few": (5, 0.92),
    "minimum_price": 25,
    "interval_margin": 0.22,
}
