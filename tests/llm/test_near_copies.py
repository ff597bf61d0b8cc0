"""Near-copies against all pairs, by sets of shingles."""

import random

import numpy as np
import pytest
from helpers import clash, docs_of, sentence, union_find
from hypothesis import given, settings
from hypothesis import strategies as st

from staylytics.llm import near_copies


def shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(texts, least=0.8):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if similarity(sets[i], sets[j]) >= least]
    return union_find(range(len(texts)), links)


def edited(rng, text, every):
    """About one word in ``every`` replaced, dropped or doubled."""
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, len(words) // every)):
        words[i] = rng.choice(["", f"new{rng.randrange(1000)}", f"{words[i]} {words[i]}"])
    return " ".join(" ".join(words).split())


def solve(spark, texts, **how):
    return {r[0]: r[1] for r in near_copies.near_duplicates(docs_of(spark, texts), **how).collect()}


def test_planted_edits_are_found_and_others_left_alone(spark):
    rng = random.Random(12)
    texts = [sentence(rng, rng.randint(30, 300)) for _ in range(150)]
    texts += [edited(rng, t, rng.choice([40, 60, 80])) for t in texts[:120]] + [t.upper() + "  " for t in texts[:20]]
    want, got = brute(texts), solve(spark, texts)
    pairs = [i for i in want if want[i] != i]
    assert len(pairs) > 100
    assert sum(got[i] == want[i] for i in pairs) >= 0.98 * len(pairs)  # a pair close to 0.8 may be missed
    assert all(got[i] == i for i in want if want[i] == i)


def test_a_hot_group_of_copies_a_chain_and_a_shared_passage(spark):
    """Blocks are small here, so that every path through large buckets is taken."""
    rng = random.Random(13)
    base = sentence(rng, 120)
    texts = [edited(rng, base, 60) for _ in range(150)]
    drift = [sentence(rng, 200)]
    for _ in range(25):
        drift.append(edited(rng, drift[-1], 50))
    passage = sentence(rng, 100)
    texts += drift + [f"{sentence(rng, 40)} {passage} {sentence(rng, 20)}" for _ in range(60)] + ["few words", "few  WORDS", None, "", " "]
    assert solve(spark, texts, rest_block=8, block=16) == brute(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 8), st.integers(1, 8), st.integers(0, 1000))
def test_spanning_forest_keeps_what_every_threshold_connects(n, m, seed):
    found = np.random.default_rng(seed).integers(-1, 9, (n, m)).astype(np.int32)
    forest = near_copies.spanning_forest(found, 2)
    for least in range(2, 9):
        every = [(int(i), n + int(j)) for i, j in zip(*np.nonzero(found >= least), strict=True)]
        kept = [(i, n + j) for i, j in forest if found[i, j] >= least]
        assert union_find(range(n + m), every) == union_find(range(n + m), kept)


@pytest.mark.parametrize("id_type", ["long", "string"])
def test_null_and_repeated_ids_and_empty_tables(spark, id_type):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "x y z"), (None, "q"), (None, "q")]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", near_copies.F.col("doc_id").cast(id_type)))
    two = 2 if id_type == "long" else "2"
    got = [tuple(r) for r in near_copies.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == sorted([(None, two), (two, two), (two, two), (None, None), (None, None)], key=repr)
    assert near_copies.near_duplicates(df.limit(0)).count() == 0


def test_only_compared_texts_are_shuffled(spark, monkeypatch):
    """However low the planner's limit, the digests that are compared go to the texts: not all texts to the digests."""
    plans, write = {}, near_copies.materialize

    def spy(df, name, *args):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, *args)

    monkeypatch.setattr(near_copies, "materialize", spy)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:59], "x"]), "other words of no concern to anyone here"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(set(solve(spark, texts).values())) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans["shingles"] and "SortMergeJoin" not in plans["shingles"]
