"""Nearest-by-value join against brute force."""

import random

import pytest

from staylytics.operators import geo
from staylytics.sources import centers_table


def brute(left, right):
    out = {}
    for rid, g, d in left:
        group = [r for r in right if r[0] == g and g is not None]
        if not group:
            out[rid] = (None, None, None)
            continue

        def order(r):
            missing = r[1] is None or d is None
            return (missing, 0.0 if missing else abs(r[1] - d), -r[2], r[3])

        best = min(group, key=order)
        out[rid] = (best[1], best[2], best[3])
    return out


def run(spark, left, right):
    l_df = spark.createDataFrame(left, "rid int, g string, d double")
    r_df = spark.createDataFrame(right, "g string, v double, n int, name string")
    got = geo.nearest_in_group(l_df, r_df, "g", "d", "v", "n", ["name"]).collect()
    assert len(got) == len(left)
    return {r["rid"]: (r["v"], r["n"], r["name"]) for r in got}


@pytest.mark.parametrize("seed, scale", [(0, 10), (1, 1000), (2, 3)])
def test_against_brute_force(spark, seed, scale):
    rng = random.Random(seed)
    groups = ["a", "a", "a", "b", "c"]
    right = [(rng.choice(groups), rng.randrange(scale) / 2, rng.randrange(4), f"n{i}") for i in range(120)]
    right += [("a", None, 99, "void"), ("null-only", None, 3, "p"), ("null-only", None, 3, "o"), ("one", 4.0, 1, "x"), (None, 1.0, 1, "q")]
    left = [(i, rng.choice([*groups, "one", "null-only", "unknown", None]), rng.randrange(-5, scale + 5) / 4) for i in range(300)]
    left += [(1000 + i, g, None) for i, g in enumerate(["a", "one", "null-only", "unknown"])]
    assert run(spark, left, right) == brute(left, right)


def test_uneven_values_and_one_hot_request(spark):
    right = [("a", float(10**k), k, f"k{k}") for k in range(10)] + [("a", 1.0 + i / 1000, 0, f"s{i}") for i in range(200)]
    left = [(i, "a", 5.0) for i in range(500)] + [(1000 + i, "a", 3.0**i) for i in range(25)]
    assert run(spark, left, right) == brute(left, right)


def test_an_outlier_leaves_the_ranges_even(spark):
    """Ranges follow the rows: one far value, or one crowded request, must not fill a task."""
    right = [("a", i * 0.7, i % 3, f"k{i}") for i in range(400)] + [("a", 1e12, 0, "far")]
    left = [(i, "a", i * 0.31 - 2) for i in range(600)] + [(1000 + i, "a", 17.0) for i in range(600)]
    assert run(spark, left, right) == brute(left, right)
    seen = []
    keep = geo.materialize

    def watch(df, name="stage", *more):
        out = keep(df, name, *more)
        if name == "line":
            seen.extend(r["count"] for r in out.groupBy("__part").count().collect())
        return out

    geo.materialize = watch
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, left, right) == brute(left, right)
    finally:
        geo.materialize = keep
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(seen) > 1 and max(seen) < 2.5 * sum(seen) / len(seen)


def test_lookup(spark):
    rows = [("nyc", "h", "40.0", "-74.0"), ("nyc", "h", "41.0", "-74.0"), ("oslo", "x", "1", "1"), (None, "x", "1", "1"), ("nyc", None, "1", "1")]
    df = spark.createDataFrame(rows, "city string, neighbourhood_cleansed string, latitude string, longitude string")
    got = {r["city"]: r for r in geo.neighborhood_lookup(df, centers_table(spark)).collect()}
    assert set(got) == {"nyc", "oslo"}
    assert (got["nyc"]["lat"], got["nyc"]["lng"], got["nyc"]["n"]) == (40.5, -74.0, 2)
    assert got["oslo"]["dist_km"] is None and got["nyc"]["dist_km"] > 0
