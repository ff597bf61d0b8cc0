import numpy as np
from helpers import clash, docs_of
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from staylytics.llm import quality
from staylytics.llm.common import held_out


def test_flat_trees_give_the_scores_of_the_fitted_model(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(500, 4)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] + x[:, 2] > 0.5)).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y, strict=True)], "stats array<double>, label double")
    df = df.withColumn("features", array_to_vector("stats"))
    model = GBTClassifier(maxIter=8, maxDepth=4, seed=1).fit(df)
    want = model.transform(df).select("stats", vector_to_array("probability")[1].alias("p")).collect()
    got = quality.flatten(model, spark).scores(np.array([r["stats"] for r in want]))
    assert np.allclose(got, [r["p"] for r in want], atol=1e-12)


def test_statistics_of_edges():
    names = list(quality.FEATURES)
    for text in (None, b"", b" \n\t"):
        assert quality.text_statistics(text) == [0.0] * len(names)
    got = dict(zip(names, quality.text_statistics(b"A b.\nA b.\nHello | 12 12\n"), strict=True))
    assert got["repeated_lines"] == 1 - 2 / 3 and got["ended_lines"] == 2 / 3
    assert got["distinct_words"] == 5 / 8 and got["top_word"] == 2 / 8 and got["longest_word"] == 5
    assert got["digit_words"] == 2 / 8 and got["pipes"] == 1 / 24 and got["digits"] == 4 / 24
    assert all(np.isfinite(quality.text_statistics(t)).all() for t in (b"x", b"\xff\xfe", "é".encode(), b"w " * 200_000))


def test_training_without_labels_or_with_one_kind(spark):
    stats = quality.statistics(docs_of(spark, ["a b c.", None, "d e", "d e"]))
    labels = spark.createDataFrame([(0, 1), (2, None), (None, 0)], "doc_id long, quality int")
    high = {r["score"] for r in quality.score(stats, quality.fit(stats, clash(labels))).collect()}
    assert len(high) == 1 and high.pop() > 0.99
    assert {r["score"] for r in quality.score(stats, quality.fit(stats, labels.limit(0))).collect()} == {0.5}
    assert quality.score(stats.limit(0), quality.constant(0.5)).collect() == []
    assert quality.score(quality.statistics(docs_of(spark, []).limit(0)), quality.constant(0.5)).collect() == []


def test_null_ids_repeated_rows_and_labels(spark):
    rows = [(None, "a b."), (1, "good words here."), (1, "good words here."), (2, "### ### $$$"), (3, None)]
    stats = quality.statistics(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (2, 0), (3, 0)], "doc_id long, quality int")
    out = quality.score(stats, quality.fit(stats, labels, trees=2)).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out().alias("h"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = quality.statistics(docs, carry=("h",))
    out = quality.score(stats, quality.fit(stats.where("not h"), labels), carry=("h",)).where("h").join(labels, "doc_id")
    right, n = out.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert n > 10 and right > 0.9
