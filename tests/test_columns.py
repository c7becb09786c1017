import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.functions.columns import code_label, fill_zero_long, to_int, visa_category
from stellate.operators.columns import (
    allow_null, drop_null_rows, fill_cast_long, insert_first, keep_not_null, rename,
    require_not_null,
)


def test_visa_category(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (2.9,)], "v double")
    got = [r[0] for r in df.select(visa_category("v")).collect()]
    assert got == ["Business", "Pleasure", "Student", "other", "other", "Pleasure"]


def test_code_label_generic(spark):
    df = spark.createDataFrame([("1",), ("9",)], "c string")
    got = [r[0] for r in df.select(code_label("c", {1: "Air", 9: "Not reported"}, "?")).collect()]
    assert got == ["Air", "Not reported"]


def test_to_int_never_fails(spark):
    df = spark.createDataFrame([(float("nan"),), (1e12,), (-1.9,), (None,)], "x double")
    assert [r[0] for r in df.select(to_int("x")).collect()] == [None, None, -1, None]


def test_fill_zero_long(spark):
    df = spark.createDataFrame([(2.58,), (None,), (float("nan"),), (-1.9,), (1e30,)], "x double")
    assert [r[0] for r in df.select(fill_zero_long("x")).collect()] == [2, 0, 0, -1, None]
    df2 = spark.createDataFrame([(5,), (None,)], "x long")
    assert [r[0] for r in df2.select(fill_zero_long("x", floating=False)).collect()] == [5, 0]


def test_require_not_null_schema_and_failure(spark):
    df = spark.createDataFrame([(1, dt.date(2016, 4, 1), "a")], "k int, d date, s string")
    out = require_not_null(df, ["k", "d", "s"])
    assert [f.nullable for f in out.schema.fields] == [False, False, False]
    assert out.collect()[0]["d"] == dt.date(2016, 4, 1)
    bad = spark.createDataFrame([(1, None)], "k int, d date")
    with pytest.raises(Exception, match="non-nullable column d"):
        require_not_null(bad, ["d"]).collect()


def test_allow_null(spark):
    df = spark.range(3).select(F.lit("x").alias("c"))
    assert df.schema["c"].nullable is False
    assert allow_null(df, ["c"]).schema["c"].nullable is True


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, None, 2.58), (2, "a", None)], "a int, b string, c double")
    assert rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b", "c"]
    assert insert_first(df, "id", F.lit(7)).columns == ["id", "a", "b", "c"]
    assert keep_not_null(df, "b").count() == 1
    assert drop_null_rows(df, ["b", "c"]).count() == 0
    assert [r.c for r in fill_cast_long(df, ["c"]).collect()] == [2, 0]


def test_set_nullable_both_ways(spark):
    from stellate.operators.columns import set_nullable
    df = spark.createDataFrame([(1,)], "k int")
    assert set_nullable(df, ["k"], False).schema["k"].nullable is False
    assert set_nullable(set_nullable(df, ["k"], False), ["k"], True).schema["k"].nullable is True
