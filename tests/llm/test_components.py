import random

import numpy as np
import pytest
from helpers import union_find

from staylytics.llm.common import whole_groups
from staylytics.llm.components import components, local_roots


def solve(spark, links):
    return dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))


def expected(links):
    links = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    return union_find({x for p in links for x in p}, links)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    assert solve(spark, links) == expected(links)


def test_chain_star_self_null_and_empty(spark):
    order = list(range(40))
    random.Random(3).shuffle(order)
    chain = list(zip(order, order[1:], strict=False))
    star = [(100, 100 + k) for k in range(1, 50)]
    links = [*chain, *star, (200, 200), (None, 5), (7, None), (100, 101)]
    assert solve(spark, links) == expected(links)
    assert solve(spark, []) == {}


def test_a_long_chain_of_rising_ids_takes_few_rounds(spark, monkeypatch):
    """And so does a star whose centre is not its smallest node."""
    from staylytics.llm import components as module

    rounds, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: (rounds.append(name), write(df, name))[1])
    assert set(solve(spark, [(k, k + 1) for k in range(2000)]).values()) == {0}
    assert rounds.count("parents") <= 20
    rounds.clear()
    assert solve(spark, [(500, k) for k in range(1000) if k != 500]) == dict.fromkeys(range(1000), 0)
    assert rounds.count("parents") <= 3


def test_local_roots_within_and_across():
    rng = np.random.default_rng(0)
    near = rng.random((30, 30)) < 0.04
    near = near | near.T
    np.fill_diagonal(near, True)
    mine, theirs = local_roots(near, True)
    want = union_find(range(30), zip(*np.nonzero(near), strict=True))
    assert mine.tolist() == [want[i] for i in range(30)] == theirs.tolist()
    near = rng.random((12, 9)) < 0.1
    mine, theirs = local_roots(near, False)
    want = union_find(range(21), [(i, 12 + j) for i, j in zip(*np.nonzero(near), strict=True)])
    assert mine.tolist() == [want[i] for i in range(12)]
    assert [t if near[:, j].any() else None for j, t in enumerate(theirs)] == [want[12 + j] if near[:, j].any() else None for j in range(9)]


def test_groups_stay_whole_over_batches():
    import pyarrow as pa

    keys = sorted(random.Random(5).choices(range(9), k=50))
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 7]}) for i in range(0, 50, 7)]
    seen = []
    for table, starts in whole_groups(batches, ["k"]):
        values = table.column("k").to_pylist()
        for s, e in zip(starts, [*starts[1:], len(values)], strict=True):
            assert len(set(values[s:e])) == 1
            seen.append((values[s], int(e - s)))
    assert seen == [(k, keys.count(k)) for k in sorted(set(keys))]
