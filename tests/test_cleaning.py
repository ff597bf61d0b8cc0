"""Cleaning and quantiles against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from staylytics.operators import cleaning, combine, evaluate, profile, quantiles
from staylytics.plans import prepare
from staylytics.sources import materialize
from workload.adapters import listings


def disc(values, p):
    values = sorted(values)
    n = len(values)
    return values[max(1, n - math.floor(n - p * n)) - 1]


def test_quantiles_with_a_hot_group_nulls_and_ties(spark):
    rng = random.Random(1)
    rows = [("hot", float(rng.choice([5.0, 5.0, 5.0, rng.random() * 100]))) for _ in range(4000)]
    rows += [(rng.choice(["a", "b", None]), rng.random()) for _ in range(900)]
    rows += [("a", None), ("empty", None), ("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.975, 1.0]
    got = {r["g"]: list(r)[1:] for r in quantiles.quantile_table(df, "v", probs, ["g"]).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: [disc(v, p) for p in probs] for g, v in groups.items()}


@pytest.mark.parametrize("accuracy", [2, 20, 10_000])
def test_quantiles_stay_exact_with_a_coarse_sketch(spark, accuracy):
    rng = random.Random(2)
    values = [rng.gauss(0, 1) ** 3 for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    row = quantiles.quantile_table(df, "v", [0.01, 0.5, 0.99], accuracy=accuracy).first()
    assert list(row) == [disc(values, p) for p in (0.01, 0.5, 0.99)]


def test_a_missed_bracket_is_reported_not_guessed(spark, monkeypatch):
    """With brackets that cannot hold the rank, the first pass finds nothing and the search widens."""
    widths = []
    original = quantiles._order_statistics

    def narrow(rows, probs, by, width, accuracy):
        widths.append(width)
        return original(rows.withColumn("__v", F.col("__v")), probs, by, width if len(widths) > 1 else -0.01, accuracy)

    monkeypatch.setattr(quantiles, "_order_statistics", narrow)
    values = [float(i) for i in range(10_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantiles.quantile_table(df, "v", [0.5]).first()[0] == disc(values, 0.5)
    assert len(widths) > 1


def test_quantiles_of_several_columns_share_their_passes(spark):
    """Side by side they equal those taken alone, with aggregates beside; the input is scanned twice."""
    rows = [(i % 3, float(i * 37 % 101), None if i % 3 == 2 or i % 5 == 0 else i * 53 % 97) for i in range(3000)]
    rows += [(None, None, 7), (None, 1.5, None), (9, None, None)]
    df = materialize(spark.createDataFrame(rows, "g int, a double, b long"), "several")
    probs = [0.1, 0.5, 0.9]
    for by in ([], ["g"]):
        both = quantiles.quantile_table(df, ["a", "b"], probs, by, extra=[F.count(F.lit(1)).alias("n"), F.max("a").alias("top")])
        assert both.columns == [*by, "a_q0", "a_q1", "a_q2", "b_q0", "b_q1", "b_q2", "n", "top"]
        found = {r["g"] if by else 0: r for r in both.collect()}
        groups = {g: [r for r in rows if r[0] == g] for g in {r[0] for r in rows}} if by else {0: rows}
        assert found.keys() == groups.keys()
        for g, own in groups.items():
            for c, at in (("a", 1), ("b", 2)):
                values = [r[at] for r in own if r[at] is not None]
                want = [float(disc(values, p)) if values else None for p in probs]
                assert [found[g][f"{c}_q{i}"] for i in range(3)] == want
            assert found[g]["n"] == len(own)
    plain = quantiles.quantile_table(df, ["a", "b"], [0.5], ["g"])
    assert {r["g"] for r in plain.collect()} == {0, 1, 2, None}
    assert quantiles.quantile_table(df.limit(0), ["a", "b"], [0.5]).first()[0] is None
    rough = quantiles.quantile_table(df, ["a", "b"], [0.5], ["g"], exact=False, extra=[F.count(F.lit(1)).alias("n")])
    assert rough.columns == ["g", "a_q0", "b_q0", "n"] and rough.count() == 5


@pytest.mark.parametrize("report", [
    lambda d: profile.target_summary(d, "v"),
    lambda d: evaluate.error_distribution(d, "v", {"m": "p", "n": "v"}),
])
def test_quantile_reports_scan_their_input_twice(spark, monkeypatch, report):
    df = materialize(spark.range(2000).selectExpr("id % 71 + 1.0D as v", "id % 13 * 1.0D as p"), "input")
    scans = []

    def counting(staged, name="stage", partition_by=()):
        scans.append(staged._jdf.queryExecution().optimizedPlan().toString().count("Relation [v#"))
        return materialize(staged, name, partition_by)

    monkeypatch.setattr(quantiles, "materialize", counting)
    report(df).collect()
    assert sum(scans) == 2


def test_empty_input(spark):
    df = spark.createDataFrame([], "city string, v double")
    assert cleaning.iqr_filter(df, "v", ["city"]).count() == 0
    assert cleaning.iqr_filter(df, "v").count() == 0
    assert cleaning.keep_rate(df, df).first()["keep_pct"] is None


def test_iqr_bounds_are_inclusive(spark):
    # quartiles 2 and 4: reach is -1 to 7
    df = spark.createDataFrame([(float(v),) for v in (2, 2, 3, 4, -1, 7, 7.01, -1.01)], "v double")
    q = quantiles.quantile_table(df, "v", [0.25, 0.75]).first()
    lo, hi = q[0] - 1.5 * (q[1] - q[0]), q[1] + 1.5 * (q[1] - q[0])
    want = sorted(v for v in (2, 2, 3, 4, -1, 7, 7.01, -1.01) if lo <= v <= hi)
    assert sorted(r[0] for r in cleaning.iqr_filter(df, "v").collect()) == want
    edge = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (2.0,), (3.0,)], "v double")
    kept = cleaning.quantile_trim(edge, "v", 0.2, 0.8).collect()
    assert sorted(r[0] for r in kept) == [0.0, 1.0, 1.0, 2.0]


def test_sketch_only_quantiles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "v double")
    got = quantiles.quantile_table(df, "v", [0.5], exact=False, accuracy=100).first()[0]
    assert abs(got - 499) <= 20


def test_dedupe_is_deterministic(spark):
    rows = [(k, f"n{i}", i) for k in range(50) for i in range(20)] + [(7, f"z{i}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, name string, x int")
    first = sorted(map(tuple, cleaning.dedupe(df, ["id"], ["name"]).collect()))
    again = sorted(map(tuple, cleaning.dedupe(df.repartition(7, "x"), ["id"], ["name"]).collect()))
    assert first == again and len(first) == 50
    assert all(name == "n0" for _, name, _ in first)


def test_null_keys(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "a"), (None, "a"), (1.0, None)], "v double, s string")
    assert cleaning.drop_null_keys(df, ["v", "s"]).count() == 1
    assert cleaning.require_not_null(df, ["v", "s"]).count() == 2


def test_keep_rate_bounds(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "city string")
    after = spark.createDataFrame([("a",)], "city string")
    got = {r["city"]: (r["rows_before"], r["rows_after"], r["keep_pct"]) for r in cleaning.keep_rate(before, after, ["city"]).collect()}
    assert got == {"a": (2, 1, 50.0), "b": (1, 0, 0.0)}


def test_union_on_common_columns(spark):
    a = spark.createDataFrame([(1, "x", 2)], "id int, name string, z int")
    b = spark.createDataFrame([(5, 6)], "z int, id int")
    out = combine.union_common([combine.with_source_tag(a, "city", "p"), combine.with_source_tag(b, "city", "q")])
    assert out.columns == ["city", "id", "z"]
    assert sorted(map(tuple, out.collect())) == [("p", 1, 2), ("q", 6, 5)]
    assert combine.with_source_tag(out, "city", "other") is out
    with pytest.raises(ValueError):
        combine.union_common([])


def test_clean_listings_default_survivor_does_not_depend_on_layout(spark):
    rows = [(i % 40, f"name {i}", f"${10 + i % 7}.00", "1.0", "2.0", "c") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, name string, price string, latitude string, longitude string, city string")
    one = sorted(map(tuple, prepare.clean_listings(df).collect()))
    two = sorted(map(tuple, prepare.clean_listings(df.repartition(6, "name")).collect()))
    assert one == two and len(one) == 40


def test_clean_sources_treats_each_source_by_itself(spark):
    def source(prices, extra=()):
        rows = [(i, f"${p}", "1", "2") for i, p in enumerate(prices)]
        df = spark.createDataFrame(rows, "id int, price string, latitude string, longitude string")
        return df.withColumns({c: F.lit("x") for c in extra})

    raw = prepare.combine_sources({"a": source([10, 11, 12, 13, 999], ["note"]), "b": source([990, 999, 1000, 1010])})
    kept = prepare.clean_sources(raw)
    rates = cleaning.keep_rate(raw, kept, ["source"])
    assert "note" not in kept.columns
    assert {(r["city"], r["price_clean"]) for r in kept.collect()} == {
        ("a", 10.0), ("a", 11.0), ("a", 12.0), ("a", 13.0), ("b", 990.0), ("b", 999.0), ("b", 1000.0), ("b", 1010.0)
    }
    assert {r["source"]: r["keep_pct"] for r in rates.collect()} == {"a": 80.0, "b": 100.0}


def test_cleaning_counts_what_came_in_from_one_reading(spark, sf_dir, tmp_path):
    """The same rows as without counting; neither result reads the raw files again."""
    raw = listings(spark, sf_dir)
    bad = raw.withColumns({"price": F.lit("free"), "name": F.lit("no price")})
    nowhere = raw.limit(7).withColumns({"latitude": F.lit(None).cast(raw.schema["latitude"].dataType), "city": F.lit(None).cast("string")})
    raw.unionByName(raw.withColumn("name", F.lit("copy"))).unionByName(bad).unionByName(nowhere).write.parquet(str(tmp_path / "raw"))
    df = spark.read.parquet(str(tmp_path / "raw"))
    kept, came_in = prepare.clean_counted(df, order_by=["name"])
    rows = sorted(map(tuple, prepare.clean_listings(df, order_by=["name"]).collect()), key=repr)
    assert rows and sorted(map(tuple, kept.collect()), key=repr) == rows
    one, two = cleaning.keep_rate(came_in, kept, ["city"], counted="__rows"), cleaning.keep_rate(df, kept, ["city"])
    assert one.schema == two.schema and sorted(one.collect(), key=repr) == sorted(two.collect(), key=repr)
    for found in (kept, came_in):
        assert found.inputFiles() and not any(f"{tmp_path}/raw" in f for f in found.inputFiles())
    assert sorted(prepare.clean_counted(df)[0].collect(), key=repr) == sorted(prepare.clean_listings(df).collect(), key=repr)
    none, counts = prepare.clean_counted(df.limit(0))
    assert none.count() == 0 and counts.count() == 0
