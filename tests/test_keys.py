import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.operators.keys import dense_ids, number_rows, unique_ids
from stellate.session import checkpoint_root


def test_unique_ids(spark):
    df = spark.range(5000).repartition(7)
    out = unique_ids(df, "id2")
    agg = out.agg(F.count("*"), F.count_distinct("id2"), F.min("id2")).collect()[0]
    assert agg[0] == agg[1] == 5000 and agg[2] >= 1


def test_number_rows_from_a_start(spark):
    df = spark.range(1000).repartition(600)
    out = number_rows(df, "no", start=11)
    assert out.columns == ["id", "no"]
    assert out.agg(F.min("no"), F.max("no"), F.count_distinct("no")).collect()[0] == (11, 1010, 1000)
    assert number_rows(df.limit(0), "no").count() == 0


def test_dense_ids_equal_row_number(spark):
    df = spark.range(15000).selectExpr("(id * 7919) % 15000 AS k", "id % 3 AS g").repartition(5)
    got = dense_ids(df, ["k"], name="rid", num_partitions=6)
    assert got.columns == ["rid", "k", "g"]
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "g")))
    joined = got.join(want, ["k", "g"])
    assert joined.where("rid != rn").count() == 0
    assert got.agg(F.min("rid"), F.max("rid")).collect()[0] == (1, 15000)


def test_dense_ids_with_ties_and_empty_partitions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    got = sorted((r.id, r.k) for r in dense_ids(df, ["k"], num_partitions=8).collect())
    assert got == [(1, "a"), (2, "a"), (3, "b")]


def test_dense_ids_spreads_a_hot_row(spark):
    # A third of the rows are one and the same row.
    hot = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 0 ELSE id END AS k")
    got = dense_ids(hot, ["k"], name="rid", num_partitions=6)
    assert got.agg(F.count_distinct("rid"), F.max("rid")).collect()[0] == (3000, 3000)
    assert got.where("k = 0").agg(F.max("rid")).collect()[0][0] == 1000
    # Each range partition wrote one file of the materialised table.
    root = checkpoint_root(spark).replace("file:", "")
    latest = max(glob.glob(os.path.join(root, "dense_ids-*")), key=os.path.getmtime)
    per_file = spark.read.parquet(latest).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r[1] for r in per_file) < 1000
