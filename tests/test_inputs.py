"""Inputs made from the given tables: however they are laid out, the rows are the same."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from staylytics.operators import cleaning
from staylytics.sources import materialize
from workload import adapters


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Orders and line items with repeated and null keys, orders without line items and line items without an order."""
    cust = spark.range(1, 8).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"),
                                    (F.col("id") % 3).cast("int").alias("c_nationkey"), F.lit("M").alias("c_mktsegment"))
    nation = spark.range(3).selectExpr("cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id as int) n_regionkey")
    key = F.when(F.col("id") % 13 == 0, None).otherwise(F.col("id") % 50)
    orders = spark.range(200).select(
        key.alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("2-HIGH").alias("o_orderpriority"),
        F.lit("1996-01-02").cast("timestamp").alias("o_orderdate"), (F.col("id") * 1000.5).alias("o_totalprice"))
    lines = spark.range(300).select(
        F.when(F.col("id") % 17 > 0, F.col("id") % 70).alias("l_orderkey"), F.when(F.col("id") % 19 > 0, F.col("id")).alias("l_partkey"),
        (F.col("id") % 3).cast("int").alias("l_linenumber"))
    for name, df in {"customer": cust, "nation": nation, "orders": orders, "lineitem": lines}.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_dealt_copies_are_the_stored_ones(spark, odd_tables):
    stored, dealt = adapters.scrapes(spark, odd_tables), adapters.dealt_scrapes(spark, odd_tables)
    assert stored.where("id is null").count() > 0 and stored.columns == dealt.columns
    assert stored.exceptAll(dealt).isEmpty() and dealt.exceptAll(stored).isEmpty()


def test_copies_are_removed_where_they_are_made(spark, sf_dir):
    """No copy is shuffled or stored: between the join that makes them and the one row kept of each there is no exchange."""
    plan = cleaning.dedupe(adapters.dealt_scrapes(spark, sf_dir), ["city", "id"], ["name"])._jdf.queryExecution().executedPlan().toString()
    join = min(plan.index(j) for j in ("SortMergeJoin", "BroadcastHashJoin") if j in plan)
    assert "row_number()" in plan[:join] and "Exchange" not in plan[:join]


def test_partitioned_tables_are_written_without_a_sort(spark, monkeypatch):
    """A task holds a file open for each side; the session's setting comes back."""
    seen, name = [], "spark.sql.maxConcurrentOutputFileWriters"
    write, before = DataFrameWriter.parquet, spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: (seen.append(int(spark.conf.get(name))), write(*a, **k))[1])
    rows = spark.range(0, 4000, 1, 4).withColumn("split", F.when(F.col("id") % 3 > 0, "train").otherwise("test"))
    kept = materialize(rows, "sides", ["split"])
    assert min(seen) >= 2 and spark.conf.get(name) == before
    assert kept.exceptAll(rows).isEmpty() and rows.exceptAll(kept).isEmpty()
