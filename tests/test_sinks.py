import os

import pytest

from stellate.sinks.files import write_csv, write_parquet


def test_parquet_modes_and_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2016), (2, None), (3, 2017)], "k int, y int")
    path = os.path.join(tmp_dir, "t")
    write_parquet(df, path, partition_by="y")
    names = sorted(os.listdir(path))
    assert "y=2016" in names and "y=2017" in names and "y=__HIVE_DEFAULT_PARTITION__" in names
    write_parquet(df, path, partition_by="y")  # overwrite
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        write_parquet(df, path, mode="errorifexists")
    back = spark.read.parquet(path).where("y = 2016")
    assert "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in back.collect()] == [1]


def test_rebalanced_partitioned_write(spark, tmp_dir):
    df = spark.range(2000).selectExpr("id", "id % 3 AS y").repartition(8)
    path = os.path.join(tmp_dir, "r")
    write_parquet(df, path, partition_by="y", rebalance=True)
    assert spark.read.parquet(path).count() == 2000
    plan = df.hint("rebalance", "y")._jdf.queryExecution().executedPlan().toString()
    assert "rebalance" in plan.lower() or "REBALANCE" in plan


def test_csv_single_file(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = os.path.join(tmp_dir, "c")
    write_csv(df, path, single_file=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(parts) == 1
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["k", "v"] and back.count() == 2
