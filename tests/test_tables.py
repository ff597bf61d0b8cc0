"""Tables are replaced whole or not at all, and bucketed ones join without a shuffle."""

import pytest
from pyspark.sql import functions as F

from staylytics.operators import split
from staylytics.plans import train
from staylytics.sources import folders, read_bucketed, read_table, write_bucketed, write_table
from staylytics.sources import tables


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    failing = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    for write in (lambda: write_table(failing, path), lambda: write_bucketed(failing, path, "id", 2)):
        with pytest.raises(Exception, match="stop"):
            write()
        assert read_table(spark, path).count() == 10
        assert names(tmp_path) == ["t"] and folders(spark, str(tmp_path)) == ["t"]


def test_a_table_may_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(read_table(spark, path).where("id >= 4"), path)
    assert read_table(spark, path).count() == 6
    assert names(tmp_path) == ["t"]


def test_a_job_that_dies_between_the_renames(spark, tmp_path, monkeypatch):
    path, rename = str(tmp_path / "t"), tables._rename
    write_table(spark.range(10), path)

    def dies(spark, source, target):
        if target == path:
            raise OSError("killed")
        rename(spark, source, target)

    monkeypatch.setattr(tables, "_rename", dies)
    with pytest.raises(OSError):
        write_table(spark.range(3), path)
    monkeypatch.undo()
    assert not (tmp_path / "t").exists() and read_table(spark, path).count() == 10
    write_table(read_table(spark, path).where("id < 7"), path)
    assert read_table(spark, path).count() == 7


def test_runs_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).selectExpr("id", "id * 1.0D as price_clean", "id + 2.0D as gbt_pred", "'x' as `odd name`")
        a = write_bucketed(rows, str(tmp_path / "it's a"), "id", 4)
        write_bucketed(rows.where("id % 3 = 0").withColumn("gbt_pred", F.col("id") - 1.0), str(tmp_path / "b"), "id", 4)
        b = read_bucketed(spark, str(tmp_path / "b"))
        assert len([f for f in (tmp_path / "b").glob("part-*")]) == 4
        joined = train.compare_runs(a, b)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 334
        assert {(r["before"] - r["id"], r["after"] - r["id"], r["abs_error_change"]) for r in joined.collect()} == {(2.0, -1.0, -1.0)}
        again = write_bucketed(b.where("id < 30"), str(tmp_path / "b"), "id", 2)
        assert again.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    write_table(rows, str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        read_bucketed(spark, str(tmp_path / "plain"))


def test_test_rows_have_no_say_in_the_features(spark):
    """Other values in test rows, even hundreds of categories, change no list; a stored list is read back as it was."""
    rows = split.hash_split(spark.range(900), "id")
    kind = "case when id % 2 = 0 then 'a' else 'b' end"
    df = rows.selectExpr("id", "split", "cast(id * 37 % 101 as double) as price_clean", "id * 61 % 97 as beds", "id % 7 as accommodates",
                         f"{kind} as room_type", f"{kind} as city", "'one' as property_type")
    changed = df.withColumns({
        "beds": F.expr("if(split = 'test', cast(price_clean as bigint), beds)"),
        "room_type": F.expr("if(split = 'test', cast(id as string), room_type)"),
        "property_type": F.expr("if(split = 'test', 'two', property_type)"),
    })
    for choose in (train.baseline_features, train.gbt_features, train.explain_features):
        chosen = choose(df.drop("split"))
        assert chosen == choose(changed.drop("split")) and "room_type" in chosen.categorical
        stored = train.features_table(spark, {"m": chosen, "other": train.Features(["beds"], [])})
        assert train.stored_features(stored, "m") == chosen
