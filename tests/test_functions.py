"""Column expressions against literal rows, with ANSI mode on and off."""

import math

import pytest
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics import functions as E


def values(spark, inputs, expr, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_clean_price(spark, ansi):
    table = {
        "$1,234.56": 1234.56,
        "1.234,56": 1234.56,
        "1.234.567,89": 1234567.89,
        "$1,234,567": 1234567.0,
        "£ 99": 99.0,
        "-$5.00": -5.0,
        "€85,00": 8500.0,
        "1.234": 1.234,
        "USD 50": None,
        "": None,
        None: None,
    }
    assert values(spark, list(table), E.clean_price("c")) == list(table.values())


def test_price_fallback(spark, ansi):
    table = {"$1,234.56": 1234.56, "USD 50": 50.0, "free": None, "1.2.3": None, None: None}
    assert values(spark, list(table), E.price_fallback("c")) == list(table.values())


def test_percent(spark, ansi):
    table = {"97%": 0.97, "100%": 1.0, "N/A": None, "": None, None: 0.0}
    assert values(spark, list(table), E.percent("c")) == list(table.values())


def test_flag(spark, ansi):
    assert values(spark, ["t", "f", "T", "", None], E.flag_tf("c")) == [1, 0, 0, 0, 0]


def test_days_since(spark, ansi):
    got = values(spark, ["2023-12-31", "2024-01-01", "bad", "31/12/2023", None], E.days_since("c", "2024-01-01"))
    assert got == [1, 0, 0, 0, 0]
    assert values(spark, ["2024-01-05"], E.days_since("c", F.lit("2024-01-07").cast("date"))) == [2]


def test_numbers(spark, ansi):
    assert values(spark, ["2", "2.0", "2.9", "x", "", None], E.to_int("c")) == [2, 2, 2, None, None, None]
    assert values(spark, ["2", "4.83", "x", None], E.to_double("c")) == [2.0, 4.83, None, None]
    assert values(spark, ["1.5 shared baths", "3 baths", "Half-bath", "", None], E.first_number("c")) == [1.5, 3.0, None, None, None]


def test_lists(spark, ansi):
    inputs = ['["Wifi", "Kitchen"]', "[]", '["a, b"]', None]
    assert values(spark, inputs, E.list_text("c")) == ["Wifi, Kitchen", "", "a, b", None]
    assert values(spark, inputs, E.list_size("c")) == [2, 1, 2, -1]
    assert values(spark, [None], E.list_size("c", 0)) == [0]


@pytest.mark.parametrize("boundary, want", [(False, [1, 1, 1, 0, 0]), (True, [0, 1, 1, 0, 0])])
def test_keyword_flag(spark, ansi, boundary, want):
    inputs = ['["Backyard"]', '["AC"]', '["Air Conditioning"]', "[]", None]
    assert values(spark, inputs, E.keyword_flag("c", K.AMENITY_PATTERNS["has_ac"], boundary)) == want


def test_text(spark, ansi):
    assert values(spark, ["a b", "a  b", "", None], E.word_count("c")) == [2, 3, 1, -1]
    assert values(spark, ["a b", "", None], E.text_length("c")) == [3, 0, None]
    assert values(spark, ["has_wifi", "x"], E.pretty("c")) == ["Has Wifi", "X"]


def test_ratios(spark, ansi):
    df = spark.createDataFrame([(100.0, 2), (100.0, 0), (100.0, None), (None, 2)], "p double, n int")
    assert [r[0] for r in df.select(E.guarded_ratio("p", "n")).collect()] == [50.0, 100.0, 100.0, None]
    assert values(spark, [15, None], E.rate("c", 30), "int") == [0.5, None]
    df = spark.createDataFrame([(4.0, None), (4.0, 5.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(E.row_mean(["a", "b"])).collect()] == [2.0, 4.5, 0.0]
    assert values(spark, [3, 0, None], E.positive_flag("c"), "int") == [1, 0, 0]


def test_one_hot(spark):
    df = spark.createDataFrame([("Entire home/apt",), ("Hotel room",), (None,)], "c string")
    got = df.select(*[e.alias(n) for n, e in E.one_hot("c", K.ROOM_TYPES).items()]).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_band_edges(spark):
    got = values(spark, [74.99, 75.0, 150.0, 249.99, 250.0], E.band("c", K.PRICE_BOUNDS, K.MARKET_LABELS), "double")
    assert got == ["Budget-Friendly", "Mid-Range", "Premium", "Premium", "Luxury"]


def test_feature_category(spark):
    names = ["host_review_rate", "review_scores", "has_wifi", "bathrooms_numeric", "city_indexed", "beds"]
    want = ["Host Quality", "Review Metrics", "Amenities", "Property Size", "Location", "Other"]
    assert values(spark, names, E.feature_category("c")) == want


def test_distances(spark, ansi):
    df = spark.createDataFrame([("41.0", "2.0"), ("abc", "2.0")], "lat string, lng string")
    miles, km = E.planar_miles("lat", "lng", F.lit(40.0), F.lit(1.0)), E.planar_km("lat", "lng", F.lit(40.0), F.lit(1.0))
    first, second = df.select(miles.alias("m"), km.alias("k")).collect()
    assert first.m == pytest.approx(math.hypot(69.0, 54.6))
    assert first.k == pytest.approx(111.32 * math.hypot(1.0, math.cos(math.radians(41.0))))
    assert second.m is None and second.k is None
