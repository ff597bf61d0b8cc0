import random

import pyarrow.parquet as pq
from helpers import docs_of
from pyspark.sql import functions as F

from staylytics.llm import langid
from staylytics.llm.common import held_out

EN = "the house is near the river and the people walk there every morning with the dog".split()
DE = "das haus ist nahe am fluss und die leute gehen dort jeden morgen mit dem hund".split()


def train(spark):
    rng = random.Random(0)
    texts = [" ".join(rng.choices(w, k=30)) for w in (EN, DE) for _ in range(30)]
    return docs_of(spark, texts, lang=["en"] * 30 + ["de"] * 30, source=["s"] * 60)


def test_known_words_unseen_words_and_edges(spark):
    model = langid.fit(train(spark), F.lit(True))
    assert model.languages == ["de", "en"]
    texts = ["The river", "DER HUND", "housed riverman", "hausen flussen", None, "", "123 !? ½", "x" * 100_000, "the das", "ζζζ"]
    got = [(r["lang_pred"], r["score"]) for r in langid.identify(docs_of(spark, texts), model).orderBy("doc_id").collect()]
    assert [g[0] for g in got[:7]] == ["en", "de", "en", "de", "und", "und", "und"]
    assert got[4][1] == got[5][1] == got[6][1] == 0.0
    assert all(0 <= s <= 1 for _, s in got) and all(p in ("de", "en") for p, _ in got[7:])
    assert got[9] == ("de", 0.5)  # no letter is known: the prior decides, ties by code point


def test_backoff_goes_from_long_to_short():
    import numpy as np

    model = langid.Model(["a", "b"], np.zeros(2), {}, np.zeros((0, 2)), {"abc": 0, "d": 1}, np.array([[0.0, -1.0], [-2.0, 0.0]]), (3, 2, 1), 40)
    assert model.backoff("abcd").tolist() == [0.0, -1.0]
    assert model.backoff("xd").tolist() == [-2.0, 0.0]
    assert model.backoff("zz") is None


def test_nothing_to_learn_and_empty_table(spark):
    docs = train(spark)
    model = langid.fit(docs.where("lang is null"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(docs.limit(0), langid.fit(docs, F.lit(True))).collect() == []


def test_labels_ids_and_null_texts_are_harmless(spark):
    rows = [(None, "the house", "en", None), (1, None, "en", "a"), (1, "das haus", "de", "b"), (1, "das haus", "de", "b"), (2, "the dog", None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = langid.identify(df, langid.fit(df, F.lit(True)))
    assert out.count() == 5


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = langid.identify(docs, langid.fit(docs, ~held_out())).join(docs.select("doc_id", "lang", held_out().alias("h")), "doc_id").where("h")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 0 and right > 0.97
    import zlib

    ids = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id"]).column(0).to_pylist()
    assert n == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)


def test_each_language_has_its_part_of_the_model(spark):
    """A language of few and short texts keeps its words beside one of many, and words seen once count."""
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}big{k}x" for k in range(40)) for i in range(200)] + ["kuku momo"]
    docs = docs_of(spark, texts, lang=["big"] * 200 + ["small"])
    model = langid.fit(docs, F.lit(True), max_words=300, max_grams=300)
    assert {"kuku", "momo"} <= set(model.word_rows) and len(model.word_rows) <= 300
    assert model.predict("momo kuku")[0] == "small"
