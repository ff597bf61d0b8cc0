import itertools
import random
import re
import time
from collections import Counter

import pytest
from helpers import docs_of, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylytics.llm import mixing
from staylytics.llm.cuts import KEYS, weighted_cuts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", "é", None]), st.integers(0, 10_000), min_size=1), st.floats(0.1, 2.0))
@settings(max_examples=60, deadline=None)
def test_targets_share_everything_and_respect_the_limit(sizes, share):
    got = mixing.targets(sizes, share=share)
    assert abs(sum(got.values()) - share * sum(sizes.values())) < 1e-6 * max(1, sum(sizes.values()))
    assert all(got[s] <= 2 * n + 1e-6 for s, n in sizes.items())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    free = [(got[s] / (3, 1, 2)[i % 3]) for i, s in enumerate(order) if got[s] < 2 * sizes[s] - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(1.0, max(free))


def test_flow_fills_overlapping_sources_with_least_repetition():
    words = {("a",): 10.0, ("a", "b"): 10.0, ("b",): 4.0}
    got = mixing.route(words, {"a": 18.0, "b": 6.0})
    assert got == {("a",): 10.0, ("a", "b"): 10.0, ("b",): 4.0}  # nothing twice
    got = mixing.route(words, {"a": 25.0, "b": 8.0})
    assert abs(sum(got.values()) - 33) < 1e-6 and all(got[p] <= 2 * n for p, n in words.items())
    assert sum(min(got[p], n) for p, n in words.items()) == 24  # every fresh word before a repeated one


def check(rows):
    by = {}
    for r in rows:
        size, source = r["size"], r["row"]["source"]
        assert size == len(WORD.findall(r["row"]["text"] or ""))
        assert r["taken"] in (0, size, 2 * size)
        by.setdefault(source, []).append(r)
    want = mixing.targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert all(r["source_size"] == sum(x["size"] for x in rs) and abs(r["target"] - want[s]) < 1e-6 for r in rs)
        taken, left = sum(r["taken"] for r in rs), [r["size"] for r in rs if 0 < r["size"] and r["taken"] < 2 * r["size"]]
        assert taken <= want[s] + 0.5 and want[s] - taken <= max(1.0, 0.001 * want[s], min(left, default=0))


def test_mix_of_skewed_sources(spark):
    rng = random.Random(1)
    source = ["hot"] * 120 + ["b"] * 30 + [None] * 10 + ["only"] + ["empty"] * 2
    texts = [sentence(rng, rng.randint(1, 300)) for _ in range(161)] + ["", None]
    docs = docs_of(spark, texts, source=source, lang=["en"] * len(texts))
    first = sorted(mixing.mix(docs).collect(), key=lambda r: r["row"]["doc_id"])
    check(first)
    again = sorted(mixing.mix(docs.repartition(7)).collect(), key=lambda r: r["row"]["doc_id"])
    assert [r["taken"] for r in first] == [r["taken"] for r in again]
    assert mixing.mix(docs.limit(0)).collect() == []


def test_long_texts_repeated_rows_and_null_ids(spark):
    rows = [(1, "w " * 20_000, "a")] * 3 + [(None, "x y", "b"), (None, "x y", "b"), (2, None, None), (3, " \t\n", None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 7
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_overlapping_members(spark):
    rng = random.Random(2)
    docs = docs_of(spark, [sentence(rng, 20) for _ in range(60)], source=["a"] * 30 + ["b"] * 30, lang=["en"] * 60)
    members = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    got = mixing.mix(docs, members=members).collect()
    assert abs(sum(r["taken"] for r in got) - 1.5 * 1200) < 60
    assert Counter(r["taken"] for r in got).keys() <= {0, 20, 40}


@pytest.mark.parametrize("sums", [16, 1000, 32_768])
def test_cuts_are_exact(spark, sums):
    rng = random.Random(3)
    rows = [(rng.randrange(3), rng.choice([rng.randrange(KEYS), 7, KEYS - 1]), float(rng.randint(1, 9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "grp int, key long, weight double")
    total = {g: sum(w for h, _, w in rows if h == g) for g in range(3)}
    for share in (0.0, 0.3, 0.99, 1.0):
        cuts = weighted_cuts(df, {g: share * total[g] for g in total} | {9: 5.0}, sums=sums)
        assert cuts[9] == (KEYS, 0)
        for g, (cut, below) in cuts.items():
            assert below == sum(w for h, k, w in rows if h == g and k < cut) <= share * total.get(g, 99) + 1e-9
            above = [k for h, k, _ in rows if h == g and k >= cut]
            if g < 3 and share < 1 and above:
                assert sum(w for h, k, w in rows if h == g and k <= min(above)) > share * total[g]


def best_by_search(words, quotas):
    """(words placed, words placed as repetitions) of the best plan, by trying every whole number; patterns of one or two sources."""
    ways = []
    for p, n in words.items():
        ways.append([[(p[0], x)] if len(p) == 1 else [(p[0], x), (p[1], y)] for x in range(2 * n + 1) for y in range(2 * n - x + 1 if len(p) > 1 else 1)])
    best = (0, 0)
    for plan in itertools.product(*ways):
        got = Counter()
        for parts in plan:
            for s, x in parts:
                got[s] += x
        if all(got[s] <= quotas[s] for s in got):
            repeated = sum(max(0, sum(x for _, x in parts) - n) for parts, n in zip(plan, words.values(), strict=True))
            best = max(best, (sum(got.values()), -repeated))
    return best


@settings(max_examples=40, deadline=None)
@given(st.tuples(*[st.integers(0, 2)] * 3), st.tuples(*[st.integers(0, 6)] * 3))
def test_flow_is_the_best_of_all_plans(sizes, room):
    words = dict(zip([("a",), ("a", "b"), ("b", "c")], sizes, strict=True))
    quotas = dict(zip("abc", room, strict=True))
    got = mixing.route({p: float(n) for p, n in words.items()}, {s: float(q) for s, q in quotas.items()})
    placed, repeated = best_by_search(words, quotas)
    assert abs(sum(got.values()) - placed) < 1e-4 and abs(sum(max(0.0, got[p] - n) for p, n in words.items()) + repeated) < 1e-4


def test_flow_over_many_patterns_is_quick():
    rng = random.Random(5)
    names = [f"s{i}" for i in range(20)]
    words = {}
    while len(words) < 10_000:
        words[tuple(sorted(rng.sample(names, rng.randint(1, 8))))] = float(rng.randint(1, 1000))
    fresh = sum(words.values())
    started = time.monotonic()
    got = mixing.route(words, {s: 1.2 * fresh / 20 for s in names})
    assert time.monotonic() - started < 10
    assert abs(sum(got.values()) - 1.2 * fresh) < 1e-3 * fresh and all(got[p] >= n - 1e-6 * fresh for p, n in words.items())


def test_rows_without_ids_are_taken_one_by_one(spark):
    texts = [f"word{i} is one of five" for i in range(900)]
    docs = docs_of(spark, texts, source=["a"] * 600 + ["b"] * 300).withColumn("doc_id", F.when(F.col("doc_id") >= 600, F.col("doc_id")))
    rows = mixing.mix(docs).select("row.source", "target", "taken").collect()
    for s in "ab":
        own = [r for r in rows if r["source"] == s]
        assert 0 <= own[0]["target"] - sum(r["taken"] for r in own) <= 5
