"""Small fixtures for the tests of this folder."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **columns):
    """documents with ids 0, 1, ... and extra columns whose names clash with what operators use inside."""
    rows = [(i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["a"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return clash(df)


def clash(df):
    from pyspark.sql import functions as F

    names = "id fp component bucket key size taken shard slot score words template hash item at grp weight row name pattern spans stats lkey cls n".split()
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n))


def union_find(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
