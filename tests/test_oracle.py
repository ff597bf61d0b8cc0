"""Every registered query against its SQL in DuckDB, on the whole tables."""

import math

import duckdb
import pytest
from pyspark.sql import SparkSession

from workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir_module):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir_module}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def sf_dir_module():
    from conftest import SF_DIR

    return SF_DIR


def canonical(row, order):
    out = []
    for i in order:
        v = row[i]
        if isinstance(v, float):
            v = None if math.isnan(v) else v + 0.0
        out.append(v)
    return tuple(out)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((canonical(r, order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark: SparkSession, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    if name not in ORACLES:
        return
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, rows) == rows_of(want.columns, want.fetchall())


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
