"""Plans hold the shape that large tables need, and shuffle joins give the same rows as broadcast ones."""

import re

import pytest
from pyspark.sql import functions as F

from staylytics.functions import clean_price
from staylytics.operators import cleaning, geo, pricing, profile
from staylytics.plans import prepare
from staylytics.sources import materialize, read_table, scratch_path, write_table
from workload import QUERIES
from workload.adapters import listings, requests, scrapes
from workload.features import lookup
from workload.registry import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name",
    ["clean_listings", "city_price_stats", "engineered_features", "nearest_neighborhood", "quote_with_location",
     "price_quote_by_segment", "prediction_join", "local_explanation", "partial_dependence_grid", "error_distribution"],
)
def test_no_pairs_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "EvalPython" not in text and "InPandas" not in text


def test_duplicates_shrink_before_the_shuffle(spark, sf_dir):
    text = plan(cleaning.dedupe(scrapes(spark, sf_dir), ["city", "id"], ["name"]))
    exchange = text.index("Exchange hashpartitioning")
    assert re.search(r"row_number\(\), 1, Partial", text[exchange:])


def test_features_need_no_shuffle(spark, sf_dir):
    text = plan(prepare.features(listings(spark, sf_dir), "2024-01-01"))
    assert "Exchange hashpartitioning" not in text and text.count("FileScan") == 1


def test_only_read_columns_reach_the_scan(spark, sf_dir):
    text = plan(profile.group_stats(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice"))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text


def test_trim_bounds_reach_the_scan(spark, sf_dir):
    text = plan(cleaning.quantile_trim(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.1, 0.9))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_extendedprice", text)


@pytest.mark.parametrize("report", [profile.null_profile, lambda d: profile.correlations(d, "l_extendedprice")])
def test_profiles_scan_once(spark, sf_dir, report):
    assert plan(report(table(spark, sf_dir, "lineitem"))).count("FileScan") == 1


def test_shuffle_joins_give_the_same_rows(spark, sf_dir, no_broadcast):
    asked = requests(spark, sf_dir)
    small = geo.nearest_in_group(asked, lookup(spark, sf_dir), "city", "distance_to_center", "dist_km", "n", ["neighbourhood_cleansed"])
    assert "SortMergeJoin" in plan(small)
    shuffled = sorted(map(tuple, small.collect()), key=repr)
    base = spark.createDataFrame([("nyc", 100.0)], "city string, avg_price double")
    quotes = sorted(map(tuple, pricing.quote(asked, base).collect()), key=repr)
    cleaned = sorted(map(tuple, prepare.clean_listings(scrapes(spark, sf_dir), order_by=["name"]).collect()), key=repr)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = geo.nearest_in_group(asked, lookup(spark, sf_dir), "city", "distance_to_center", "dist_km", "n", ["neighbourhood_cleansed"])
    assert shuffled == sorted(map(tuple, again.collect()), key=repr)
    assert quotes == sorted(map(tuple, pricing.quote(asked, base).collect()), key=repr)
    assert cleaned == sorted(map(tuple, prepare.clean_listings(scrapes(spark, sf_dir), order_by=["name"]).collect()), key=repr)


def test_one_city_with_almost_everything(spark, sf_dir):
    """A hot city gives what the same rows give on their own."""
    rows = listings(spark, sf_dir)
    hot = rows.withColumn("city", F.when(F.col("id") % 10 < 9, "nyc").otherwise(F.col("city")))
    kept = prepare.clean_listings(hot).where("city = 'nyc'")
    alone = prepare.clean_listings(hot.where("city = 'nyc'"))
    assert kept.exceptAll(alone).isEmpty() and alone.exceptAll(kept).isEmpty()


def test_staging_uses_the_session_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_path(spark, "x").startswith(root.rstrip("/"))
    df = materialize(spark.range(5))
    assert df.count() == 5 and "FileScan" in plan(df)


def test_tables_and_files(spark, tmp_path):
    absent = str(tmp_path / "none")
    assert read_table(spark, absent, empty_schema="a int, b string").columns == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        read_table(spark, absent)
    df = spark.createDataFrame([(i, 'say "hi",\nthere', "x" if i else None) for i in range(10)], "a int, b string, c string")
    write_table(df, str(tmp_path / "one"), "csv", single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    back = read_table(spark, [absent, str(tmp_path / "one")], "csv")
    assert sorted((int(r.a), r.b, r.c) for r in back.collect()) == sorted(map(tuple, df.collect()))
    write_table(df.repartition(3), str(tmp_path / "two"), "csv", single_file=True)
    assert len(list((tmp_path / "two").glob("part-*"))) == 1
    write_table(df.coalesce(1), str(tmp_path / "three"), max_records_per_file=3)
    assert len(list((tmp_path / "three").glob("part-*"))) == 4
    write_table(df, str(tmp_path / "four"), partition_by=["c"], rebalance=True)
    assert {p.name for p in (tmp_path / "four").glob("c=*")} == {"c=x", "c=__HIVE_DEFAULT_PARTITION__"}


def test_cleaned_price_survives_text_round_trip(spark, sf_dir):
    df = listings(spark, sf_dir).select("price", clean_price("price").alias("p"))
    assert df.where("p is null and price like '$%'").isEmpty()
