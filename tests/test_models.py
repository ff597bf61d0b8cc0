"""Split, selection, models, metrics and explanations."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from staylytics import constants as K
from staylytics.operators import curves, evaluate, explain, features, models, profile, results, selection, split
from staylytics.plans import interpret, train
from staylytics.sources import centers_table, materialize


@pytest.fixture(scope="module")
def table(spark):
    """A price that depends on two numbers and a category, with noise by hash."""
    df = spark.range(3000).select(
        F.col("id"),
        (F.col("id") % 7).cast("int").alias("accommodates"),
        (F.abs(F.xxhash64("id")) % 100 / 10).alias("distance_to_center"),
        F.element_at(F.array(*[F.lit(c) for c in ("nyc", "london", "rome")]), (F.col("id") % 3 + 1).cast("int")).alias("city"),
        F.lit("Private room").alias("room_type"),
    )
    price = 50 + 20 * F.col("accommodates") - 3 * F.col("distance_to_center") + F.when(F.col("city") == "nyc", 60).otherwise(0)
    noise = F.pmod(F.xxhash64(F.col("id") + 7), F.lit(100)) / 25
    return split.hash_split(df.withColumn("price_clean", price + noise), "id").cache()


@pytest.fixture(scope="module")
def fitted(table):
    num, cat = ["accommodates", "distance_to_center"], ["city"]
    linear = models.fit(models.linear_pipeline(num, cat), table)
    trees = models.fit(models.gbt_pipeline(num, cat, depth=4, iters=6, step=0.3), table)
    return linear, trees


def test_split_is_a_stable_partition(table):
    again = split.hash_split(table.drop("split").repartition(5, "city"), "id")
    assert table.select("id", "split").exceptAll(again.select("id", "split")).isEmpty()
    shares = {r["split"]: r["count"] / 3000 for r in table.groupBy("split").count().collect()}
    assert set(shares) == {"train", "test"} and 0.77 < shares["train"] < 0.83


def test_sample(table):
    few = split.hash_sample(table, "id", n=300)
    assert 230 < few.count() < 370
    assert split.hash_sample(table, "id", n=10_000).count() == 3000
    part = split.hash_sample(table, "id", fraction=0.1)
    assert part.select("id").exceptAll(few.select("id")).isEmpty() or few.select("id").exceptAll(part.select("id")).isEmpty()
    with pytest.raises(ValueError):
        split.hash_sample(table, "id")


def test_selection(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 3, 5, "a", "x", f"t{i}", 1.0) for i in range(60)] + [(1, 2.0, 3, 5, "b", "x", None, 1.0)],
        "id int, price_clean double, beds int, price_per_person int, city string, flat string, free string, extra double",
    )
    assert selection.select_numeric(df) == ["beds", "extra"]
    assert selection.select_categorical(df) == ["city"]
    assert selection.select_categorical(df, ["free"], hi=61) == ["free"]
    assert selection.select_preferred(df) == ["beds", "extra"]
    assert selection.select_preferred(df, min_n=0) == ["beds"]
    with pytest.raises(ValueError):
        selection.assert_no_leak(["beds", "price_per_person"])


def test_test_rows_have_no_say_in_the_ranking(spark, monkeypatch):
    """Test rows in which another column predicts the target perfectly change nothing."""
    rows = split.hash_split(spark.range(600), "id").selectExpr("id", "split = 'test' as tested", "cast(id * 37 % 101 as double) as y")
    noise = "cast(id * 61 % 97 as double)"
    df = rows.selectExpr("id", "y as price_clean", f"y + {noise} / 4 as good", f"case when tested then 1000000 * y else {noise} end as bad")
    seen = {}
    monkeypatch.setattr(train.selection, "select_numeric", lambda df, target, limit=None, ranking=None: seen.update(r=ranking) or ["good", "bad"])
    train.baseline_features(df)
    found = {r["column"]: abs(r["correlation"]) for r in seen["r"].collect()}
    assert found["good"] > 0.9 > 0.3 > found["bad"]


def test_metrics_match_the_evaluator(table, fitted):
    scored = models.score(fitted[1], table)
    row = evaluate.regression_metrics(scored, "price_clean", {"m": "prediction"}).first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="price_clean", metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(want, rel=1e-9)
    assert row["n_samples"] == 3000


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, None), (None, 2.0)], "y double, p double")
    row = evaluate.regression_metrics(df, "y", {"m": "p"}).first()
    assert (row["n_samples"], row["rmse"], row["mape"], row["r2"]) == (1, 1.0, None, None)


def test_improvement_is_symmetric_in_direction(spark):
    rows = [("baseline", 10.0, 8.0, 0.5, 20.0), ("gbt", 8.0, 6.0, 0.6, 15.0)]
    df = spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double, mape double")
    better = evaluate.improvement(df).first()
    assert better["rmse_improvement_pct"] == pytest.approx(20) and better["r2_improvement_pct"] == pytest.approx(20)
    worse = evaluate.improvement(df, "gbt", "baseline").first()
    assert all(better[c] * worse[c] < 0 for c in better.asDict())
    assert tuple(evaluate.winner(evaluate.improvement(df)).first())[:2] == ("gbt", "use gbt")
    table = {r["metric"]: (r["baseline"], r["gbt"]) for r in evaluate.comparison(df.where("model = 'gbt'"), defaults=K.DEFAULT_METRICS).collect()}
    assert table["rmse"] == (89.45, 8.0) and table["mape"] == (34.56, 15.0)
    undefined = df.withColumn("r2", F.lit(None).cast("double"))
    for defaults in (None, K.DEFAULT_METRICS):
        table = {r["metric"]: (r["baseline"], r["gbt"]) for r in evaluate.comparison(undefined, defaults=defaults).collect()}
        assert table["r2"] == (None, None) and table["rmse"] == (10.0, 8.0)
    negative = df.withColumn("r2", F.when(F.col("model") == "baseline", -0.1).otherwise(F.col("r2")))
    assert evaluate.improvement(negative).first()["r2_gain_pct"] is None
    assert evaluate.improvement(negative, fallback=50.0).first()["r2_gain_pct"] == 50.0


def test_save_and_load(spark, table, fitted, tmp_path):
    models.save(fitted[1], str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m"))
    a = models.score(fitted[1], table).agg(F.sum("prediction")).first()[0]
    assert models.score(again, table).agg(F.sum("prediction")).first()[0] == a
    assert [r["feature"] for r in models.importances(again).collect()] == ["accommodates", "distance_to_center", "city_indexed"]
    assert models.coefficients(fitted[0]).count() == 3


@pytest.mark.parametrize("which", [0, 1])
def test_attributions_add_up(table, fitted, which):
    make = [explain.linear_attributions, explain.tree_attributions][which]
    found = make(fitted[which], table.where("split = 'test'"), "id")
    total = F.aggregate("attributions", F.lit(0.0), lambda s, a: s + a["contribution"])
    gap = found.select(F.abs(total + F.col("base_value") - F.col("prediction")).alias("gap")).agg(F.max("gap")).first()[0]
    assert gap < 1e-9
    scored = models.score(fitted[which], table.where("split = 'test'"))
    joined = found.withColumnRenamed("prediction", "p2").join(scored, "id")
    assert joined.agg(F.max(F.abs(F.col("p2") - F.col("prediction")))).first()[0] < 1e-9
    assert found.count() == table.where("split = 'test'").count()


def test_tree_attributions_match_subset_enumeration(spark, table, fitted):
    """Shapley values by summing over all feature subsets, expectation taken along tree paths."""
    trees = fitted[1]
    leaves = explain.leaves_of(spark, trees)
    rows = explain.tree_attributions(trees, table.where("id < 40"), "id").collect()

    def expectation(x, known):
        total = 0.0
        for leaf in leaves:
            weight = leaf.output
            for i, f in enumerate(leaf.features):
                if f in known:
                    allowed = leaf.allowed[i]
                    ok = leaf.low[i] < x[f] <= leaf.high[i] if allowed is None else x[f] in allowed
                    weight *= 1.0 if ok else 0.0
                else:
                    weight *= leaf.cover[i]
            total += weight
        return total

    p = 3
    for row in rows[:15]:
        x = [a["value"] for a in row["attributions"]]
        for f in range(p):
            rest = [j for j in range(p) if j != f]
            want = 0.0
            for size in range(p):
                scale = math.factorial(size) * math.factorial(p - size - 1) / math.factorial(p)
                for subset in itertools.combinations(rest, size):
                    want += scale * (expectation(x, {*subset, f}) - expectation(x, set(subset)))
            assert row["attributions"][f]["contribution"] == pytest.approx(want, abs=1e-9)
    assert any(a is not None for leaf in leaves for a in leaf.allowed), "a category split is covered"


def test_leaf_integral_by_hand():
    """One split on one feature: the contribution is output difference to the expectation."""
    left = explain.Leaf(10.0, (0,), np.array([0.25]), np.array([-np.inf]), np.array([5.0]), (None,))
    right = explain.Leaf(2.0, (0,), np.array([0.75]), np.array([5.0]), np.array([np.inf]), (None,))
    phi = explain._attribute(np.array([[5.0], [6.0]]), [left, right])
    assert phi[:, 0] == pytest.approx([10 - 4, 2 - 4])


def test_local_explanations(table, fitted):
    found = explain.linear_attributions(fitted[0], table, "id", ["price_clean"])
    keys = explain.keys_at(table, "id", [0, 5])
    got = explain.local_explanation(found, "id", keys, top=2, carry=["price_clean"]).collect()
    assert {(r["id"], r["rank"]) for r in got} == {(0, 1), (0, 2), (5, 1), (5, 2)}
    for i in (0, 5):
        a, b = sorted((r for r in got if r["id"] == i), key=lambda r: r["rank"])
        assert abs(a["contribution"]) >= abs(b["contribution"])


def test_linear_dependence_is_a_line(table, fitted):
    curve = explain.partial_dependence(fitted[0], table, "accommodates").orderBy("value").collect()
    assert [r["value"] for r in curve] == list(range(7))
    steps = [b["avg_prediction"] - a["avg_prediction"] for a, b in zip(curve, curve[1:])]
    scaler, line = fitted[0].stages[-2], fitted[0].stages[-1]
    assert steps == pytest.approx([line.coefficients[0] / scaler.std[0]] * 6)
    wide = explain.partial_dependence(fitted[1], table, "distance_to_center", points=20).collect()
    assert len(wide) == 20
    assert {r["value"] for r in explain.partial_dependence(fitted[1], table, "city").collect()} == {"nyc", "london", "rome"}


def test_curves_of_trees_equal_scoring_every_row_at_every_value(spark, table, fitted):
    """One pass for all features, also with missing numbers, against the spread rows."""
    trees = fitted[1]
    gaps = table.withColumn("accommodates", F.when(F.col("id") % 7 != 0, F.col("accommodates"))).withColumn(
        "distance_to_center", F.when(F.col("id") % 5 != 0, F.col("distance_to_center")))
    for df in (table, gaps):
        found = curves.tree_dependence(trees, df, ["accommodates", "distance_to_center", "city"], points=20)
        for name, curve in found.items():
            want = {r["value"]: r["avg_prediction"] for r in explain.partial_dependence(trees.transform, df, name, points=20).collect()}
            got = {r["value"]: r["avg_prediction"] for r in curve.collect()}
            assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 2
            assert all(got[v] == pytest.approx(want[v], abs=1e-9) for v in want)


def test_curves_scan_the_rows_once_for_all_features(spark, table, fitted, monkeypatch):
    plans = []
    monkeypatch.setattr(curves, "materialize", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), materialize(df, name))[1])
    curves.tree_dependence(fitted[1], table, ["accommodates", "distance_to_center", "city"])
    assert len(plans) == 1 and plans[0].count("MapInPandas") == 1 and "Generate" not in plans[0]


def test_tiles_of_any_size_give_the_same_attributions(table, fitted, monkeypatch):
    def rows():
        found = explain.tree_attributions(fitted[1], table.where("id < 300"), "id").select("id", F.inline("attributions"))
        return sorted((r["id"], r["feature"], round(r["contribution"], 9)) for r in found.collect())

    want = rows()
    monkeypatch.setattr(explain, "_TILE_ROWS", 7)
    monkeypatch.setattr(explain, "_GROUP_CELLS", 1)
    assert rows() == want


def test_leaves_that_share_tests_are_looked_up_together(spark, table, fitted, monkeypatch):
    """Rows are read once for a unit of leaves, not for each leaf, and one leaf a unit gives the same."""
    leaves = explain.leaves_of(spark, fitted[1])
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 8, 200), rng.random(200) * 11, rng.integers(0, 4, 200)]).astype(float)
    together = explain.lookup(leaves)
    assert sum(len(u.sizes) for u in together.units) == len(leaves) > 3 * len(together.units)
    assert all(math.prod(u.shape) <= explain._UNIT_CELLS for u in together.units)
    monkeypatch.setattr(explain, "_UNIT_CELLS", 1)
    apart = explain.lookup(leaves)
    assert len(apart.units) == len(leaves)
    assert explain._attribute(x, together) == pytest.approx(explain._attribute(x, apart), rel=1e-9, abs=1e-9)
    a, b = (curves.curve_sums(x, ready, [0, 1, 2]) for ready in (together, apart))
    assert all(a[f] == pytest.approx(b[f], rel=1e-9) for f in a)


def test_rows_are_looked_up_in_parts_of_a_tile(spark, fitted, monkeypatch):
    """Contributions of units are added up once for a tile, whatever the parts of rows and units that are looked up at a time."""
    ready = explain.lookup(explain.leaves_of(spark, fitted[1]))
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 8, 100), rng.random(100) * 11, rng.integers(0, 4, 100)]).astype(float)
    want, made, of_unit = explain._attribute(x, ready), [], explain._unit_shares
    monkeypatch.setattr(explain, "_PART_ROWS", 7)
    monkeypatch.setattr(explain, "_PART_UNITS", 2)
    monkeypatch.setattr(explain, "_unit_shares", lambda unit, ready: (made.append(unit), of_unit(unit, ready))[1])
    assert explain._attribute(x, ready) == pytest.approx(want, rel=1e-12, abs=1e-12)
    assert len(made) == len(ready.units)


def test_importance_ranks_share_ties(spark):
    a = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("z", 1.0)], "feature string, importance double")
    b = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "feature string, importance double")
    got = {r["feature"]: (r["gb_rank"], r["lr_rank"], r["rank_difference"], r["agreement"]) for r in explain.compare_importances(a, b).collect()}
    assert got == {"x": (1.0, 3.0, 2.0, "consistent"), "y": (2.5, 2.0, -0.5, "consistent"), "z": (2.5, 1.0, -1.5, "consistent")}


def test_compare_importances_keeps_what_one_model_lacks(spark):
    a = spark.createDataFrame([("x", 0.2), ("only_a", 0.8)], "feature string, importance double")
    b = spark.createDataFrame([("x", 0.2), ("only_b", 0.8)], "feature string, importance double")
    got = {r["feature"]: (r["gb_rank"], r["lr_rank"]) for r in explain.compare_importances(a, b).collect()}
    assert got == {"only_a": (1.0, 3.0), "x": (2.0, 2.0), "only_b": (3.0, 1.0)}


def test_encode_alphabetical(spark):
    df = spark.createDataFrame([("b", 1), (None, None), ("a", 3)], "c string, n int")
    assert [tuple(r) for r in models.encode_alphabetical(df, ["c"]).collect()] == [(1, 1), (2, 0), (0, 3)]


def test_correlation_of_a_constant_is_left_out(spark, ansi):
    df = spark.createDataFrame([(1.0, 2, 5), (2.0, 4, 5), (3.0, 5, 5), (None, 9, 5)], "t double, x int, k int")
    got = {r["column"]: r["correlation"] for r in profile.correlations(df, "t").collect()}
    assert set(got) == {"x"}
    many = spark.range(1500).repartition(8).select(F.rand(1).alias("t"), F.lit(1).alias("one"), F.lit(0.1).alias("tenth"))
    assert profile.correlations(many, "t").isEmpty()
    flat = many.select(F.col("tenth").alias("y"), F.col("t").alias("p"))
    assert evaluate.regression_metrics(flat, "y", {"m": "p"}).first()["r2"] is None
    assert got["x"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 5])[0, 1])


def test_interpret_and_reports(table, fitted):
    linear, trees = fitted
    scored = train.score_models({"baseline": linear, "gbt": trees}, table)
    out = train.reports(scored)
    assert {r["model"] for r in out["metrics"].collect()} == {"baseline", "gbt"}
    assert out["metrics_by_split"].count() == 4
    assert out["sample_predictions"].count() == min(1000, table.where("split = 'test'").count())
    found = interpret.interpret(linear, trees, table, positions=[0, 3], curves=2)
    assert found["local_explanations"].select("id").distinct().count() == 2
    assert sum(n.startswith("dependence_") for n in found) == 2
    assert found["feature_importance_comparison"].count() == 3


def test_engineer_only_makes_features_it_has_inputs_for(spark):
    df = spark.createDataFrame([(1, "nyc", "$10", "40.7", "-73.9")], "id int, city string, price string, latitude string, longitude string")
    out = features.engineer(df, centers_table(spark))
    assert out.columns == ["id", "latitude", "longitude", "city", "price", "price_clean", "distance_to_center"]
    assert out.first()["price_clean"] == 10.0
    with pytest.raises(ValueError):
        features.engineer(df.drop("city"), centers_table(spark))


def test_metrics_records(spark):
    rows = results.metrics_table(spark, [{"run": "r", "model": "m", "metric": "rmse", "value": 1.5}]).collect()
    assert tuple(rows[0]) == ("r", "m", None, None, "rmse", 1.5)
