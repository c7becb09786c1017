import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.functions.dates import (
    calendar_columns, parse_date, register_sql_functions, sas_to_date,
)


def python_reference(x):
    """What the original per-row conversion returns."""
    try:
        return (dt.datetime(1960, 1, 1) + dt.timedelta(days=int(x))).date()
    except Exception:
        return None


EDGES = [20545.0, None, float("nan"), 2936549.0, 2936550.0, -715509.0, -715510.0,
         -0.5, 20545.9, -1.9, 1e12, 0.0]


def test_sas_to_date_edges(spark):
    df = spark.createDataFrame([(x,) for x in EDGES], "x double")
    got = [r[0] for r in df.select(sas_to_date("x")).collect()]
    assert got == [python_reference(x) for x in EDGES]
    assert got[0] == dt.date(2016, 4, 1)
    assert got[3] == dt.date(9999, 12, 31) and got[4] is None
    assert got[5] == dt.date(1, 1, 1) and got[6] is None
    assert got[7] == dt.date(1960, 1, 1)  # truncation toward zero


def test_sas_to_date_text(spark):
    df = spark.createDataFrame([("20545",), ("20545.0",), ("abc",), (" 7 ",)], "x string")
    got = [r[0] for r in df.select(sas_to_date("x")).collect()]
    assert got == [dt.date(2016, 4, 1), None, None, dt.date(1960, 1, 8)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True),
                          st.floats(min_value=-800000, max_value=3000000)),
                min_size=1, max_size=40))
def test_sas_to_date_matches_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(sas_to_date("x")).collect()]
    assert got == [python_reference(x) for x in xs]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2016, 4, 1),), (dt.date(2016, 1, 1),)], "d date")
    rows = df.select(*[c.alias(n) for n, c in calendar_columns("d").items()]).collect()
    assert rows[0].asDict() == {"day": 1, "week": 13, "month": 4, "year": 2016, "weekday": 6}
    assert rows[1]["week"] == 53 and rows[1]["weekday"] == 6


def test_sql_function_inlines(spark):
    register_sql_functions(spark)
    df = spark.sql("SELECT sas_date(20545.0) AS a, sas_date(CAST('NaN' AS DOUBLE)) AS b, "
                   "sas_date(NULL) AS c")
    assert df.collect()[0].asDict() == {"a": dt.date(2016, 4, 1), "b": None, "c": None}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_parse_date(spark):
    df = spark.createDataFrame([("2013-09-01",), ("2013-13-01",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got == [dt.date(2013, 9, 1), None, None]
    with pytest.raises(Exception):
        df.select(parse_date("s", strict=True)).collect()


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(20545.0,)], "x double").select(sas_to_date("x").alias("d"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert math.isfinite(1.0)
