import math

import numpy as np
import pytest
from helpers import clash, union_find

from staylytics.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.93):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for i, a, la in rows:
        for j, b, lb in rows:
            if i != j and la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                x, y = (np.array(v, dtype=np.float32).astype(np.float64) for v in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    links.append((i, j))
    root = union_find([r[0] for r in rows], links)
    return sorted((i, sum(a == i for a, _ in links), root[i], root[i] == i) for i, _, _ in rows)


def rows_of(seed=0, n=150, dim=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    vectors = centers[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.3
    rows = [(i, v.astype(np.float32).tolist(), int(rng.integers(0, 2))) for i, v in enumerate(vectors)]
    copy = rows[5][1]
    rows += [(1000 + k, copy, 1) for k in range(6)] + [(1010, [x * 1e30 for x in copy], 1)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * dim, 1), (2003, [float("nan")] * dim, 1), (2004, [None] * dim, 1)]
    return rows + [(2005, [float("inf")] + [1.0] * (dim - 1), 1), (2006, copy, None), (2007, copy[:-1], 1), (2008, copy[:-1], 1)]


@pytest.mark.parametrize(("cell_rows", "block"), [(4096, 1024), (10, 7), (25, 1024)])
def test_against_brute_force(spark, cell_rows, block):
    rows = rows_of()
    df = clash(spark.createDataFrame(rows, SCHEMA))
    got = embed_dedup.near_duplicates(df, cell_rows=cell_rows, block=block)
    assert sorted(map(tuple, got.collect())) == brute_force(rows)


def test_repeated_and_missing_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (None, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, embed_dedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=repr)
    assert embed_dedup.near_duplicates(df.limit(0)).collect() == []


def test_every_close_pair_meets_in_one_cell():
    rng = np.random.default_rng(1)
    points = embed_dedup.unit(rng.normal(size=(400, 3)))
    centers = embed_dedup.spherical_kmeans(points, 12)
    home, guests = embed_dedup.homes_and_guests(points, centers, 0.93)
    for i, j in zip(*np.nonzero(points @ points.T >= 0.93), strict=True):
        if home[i] < home[j]:
            assert home[i] in guests[j]


def test_distances_of_many_wide_centroids():
    rng = np.random.default_rng(4)
    centers = embed_dedup.unit(rng.normal(size=(300, 768)))
    centers[1] = centers[0]
    plain = np.array([[np.linalg.norm(a - b) for b in centers[:20]] for a in centers[:20]])
    assert np.abs(embed_dedup.distances(centers)[:20, :20] - plain).max() < 1e-7
