"""Boosted trees from sums over blocks: the trees of ``GBTRegressor``, node for node."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from staylytics.operators import boosting, explain, models


@pytest.fixture(scope="module")
def rows(spark):
    """Few and many values, zeros, a constant, a column that comes twice, a category without rows, and prices that differ in each row."""
    mixed = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(v)).cast("double").alias(c) for k, (c, v) in enumerate({"few": 3, "many": 5000, "flag": 2, "noise": 997}.items())]
    df = spark.range(4000).select("id", *mixed, F.element_at(F.array(*map(F.lit, "abcde")), (F.col("id") * 7 % 5 + 1).cast("int")).alias("kind"))
    df = df.withColumns({"signed": F.col("many") - 2500, "again": F.col("many"), "one": F.lit(1.0)})
    price = 40 * F.col("few") + F.sqrt("many") + F.col("flag") * F.col("few") * 9 + F.when(F.col("kind") == "b", 55).otherwise(0) + F.col("noise") / 31
    return df.withColumn("price_clean", price).repartition(3, "id").localCheckpoint()


NUM = ["one", "few", "many", "flag", "signed", "again"]


def _both(rows, **params):
    pipeline = models.gbt_pipeline(NUM, ["kind"], **params)
    *encoders, trees = pipeline.getStages()
    if "bins" in params:
        trees.columns = ()  # out of the vectors
    encoded = Pipeline(stages=encoders).fit(rows).transform(rows)
    plain = GBTRegressor(**{p.name: v for p, v in trees._paramMap.items()}).fit(encoded)
    return plain, trees.fit(encoded), encoded


def _nodes(spark, model, path):
    model.save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()


@pytest.mark.parametrize("params", [{"depth": 5, "iters": 4}, {"depth": 3, "iters": 3, "subsample": 1.0, "bins": 12}, {"depth": 1, "iters": 1}])
def test_the_trees_are_those_of_pyspark_ml(spark, rows, tmp_path, monkeypatch, params):
    monkeypatch.setattr(boosting, "_BLOCK_ROWS", 300)
    monkeypatch.setattr(boosting, "_CUT_ROUNDS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "128")
    try:
        plain, own, encoded = _both(rows, **params)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, got = _nodes(spark, plain, str(tmp_path / "plain")), _nodes(spark, own, str(tmp_path / "own"))
    assert len(want) == len(got) and own.treeWeights == plain.treeWeights
    for a, b in zip(want, got):
        assert (a.treeID, a.id, a.split, a.rawCount, a.leftChild, a.rightChild) == (b.treeID, b.id, b.split, b.rawCount, b.leftChild, b.rightChild)
        assert (b.prediction, b.gain) == (pytest.approx(a.prediction, rel=1e-7, abs=1e-7), pytest.approx(a.gain, rel=1e-6, abs=1e-6))
        assert b.impurityStats == pytest.approx(a.impurityStats, rel=1e-6, abs=1e-4)
    assert own.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-9)
    gap = own.transform(plain.transform(encoded).withColumnRenamed("prediction", "p")).agg(F.max(F.abs(F.col("p") - F.col("prediction"))))
    assert gap.first()[0] < 1e-7


def test_numbers_are_those_of_rand(spark):
    told = spark.range(0, 900, 1, 3).select(F.spark_partition_id().alias("part"), F.rand(43).alias("u")).collect()
    for part in range(3):
        want = np.array([r["u"] for r in told if r["part"] == part])
        assert (boosting.draws(43, part, 0, 300) == want).all() and (boosting.draws(43, part, 111, 60) == want[111:171]).all()


def test_thresholds_come_from_the_same_sample(spark, rows, tmp_path):
    """Beyond 10,000 rows thresholds are learned from a sample."""
    other = {c: F.pmod(F.xxhash64("id", "copy", F.lit(c)), F.lit(20000)).cast("double") for c in ("many", "signed", "again")}
    many = rows.join(spark.range(8).toDF("copy")).withColumns(other).withColumn("price_clean", F.col("price_clean") + F.col("many") / 99 + F.col("again") / 187)
    many = many.localCheckpoint()
    plain, own, _ = _both(many, depth=4, iters=2)
    want, got = _nodes(spark, plain, str(tmp_path / "plain")), _nodes(spark, own, str(tmp_path / "own"))
    assert [(a.id, a.split, a.rawCount) for a in want] == [(b.id, b.split, b.rawCount) for b in got]


def test_the_smaller_sibling_is_counted_and_codes_are_shared(spark, rows, monkeypatch):
    seen = []
    counted = boosting._collected
    monkeypatch.setattr(boosting, "_collected", lambda blocks, tree, slots, *rest: (seen.append((slots, rest[-1])), counted(blocks, tree, slots, *rest))[1])
    models.fit(models.gbt_pipeline(NUM, ["kind"], depth=4, iters=1), rows)
    assert [len(s) for s, _ in seen] == [1, 2, 4, 8]
    assert all(((s.reshape(-1, 2) >= 0).sum(axis=1) <= 1).all() for s, _ in seen[1:])
    layout = seen[0][1]
    assert len(layout.codes) < len(layout.bins) and sorted(f for c in layout.codes for f in c) == list(range(len(NUM) + 1))


def test_missing_labels_and_empty_tables_are_told(rows):
    pipeline = models.gbt_pipeline(["few"], depth=1, iters=1)
    for odd in (rows.where("id < 0"), rows.withColumn("price_clean", F.when(F.col("id") > 5, F.col("price_clean"))), rows.withColumn("price_clean", F.lit(float("nan")))):
        with pytest.raises(Exception):
            models.fit(pipeline, odd)


def test_a_saved_model_explains_itself(spark, rows, tmp_path):
    fitted = models.fit(models.gbt_pipeline(NUM, ["kind"], depth=3, iters=3), rows)
    models.save(fitted, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m"))
    assert type(again.stages[-1]) is type(fitted.stages[-1]) and again.stages[-1].getMaxIter() == 3
    total = F.aggregate("attributions", F.col("base_value"), lambda s, a: s + a["contribution"])
    found = explain.tree_attributions(again, rows.where("id < 300"), "id")
    assert found.agg(F.max(F.abs(total - F.col("prediction")))).first()[0] < 1e-9
