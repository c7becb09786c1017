import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from stellate.operators.dedupe import (
    dedupe_by_key, distinct_rows, duplicate_rows, latest_per_key,
)


def _rows(df):
    return sorted(tuple("NULL" if v is None else v for v in r) for r in df.collect())


def test_distinct_rows_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, v string")
    assert distinct_rows(df).count() == 2


def test_dedupe_by_key_deterministic_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, None, 9), (1, "a", 1), (2, "z", 3), (2, "z", 1)],
        "k int, s string, n int")
    out = {r.k: (r.s, r.n) for r in dedupe_by_key(df, ["k"]).collect()}
    assert out == {1: (None, 9), 2: ("z", 1)}
    out2 = {r.k: (r.s, r.n) for r in dedupe_by_key(df, ["k"], order_by=["n"]).collect()}
    assert out2 == {1: ("a", 1), 2: ("z", 1)}
    assert dedupe_by_key(df, ["k"]).columns == ["k", "s", "n"]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("c", "2013-01-01", 1.0), ("c", "2013-02-01", 2.0), ("d", "2013-02-01", None),
         ("d", "2013-02-01", 7.0), ("d", None, 9.0)],
        "city string, dt string, t double")
    out = {r.city: (r.dt, r.t) for r in latest_per_key(df, ["city"], ["dt", "t"]).collect()}
    assert out == {"c": ("2013-02-01", 2.0), "d": ("2013-02-01", 7.0)}


def test_duplicate_rows_bag_semantics(spark):
    rows = [(1, "a")] * 5 + [(2, None)] * 2 + [(3, "c")]
    df = spark.createDataFrame(rows, "k int, v string")
    # A tiny chunk size exercises the split of a hot row over several chunks.
    out = _rows(duplicate_rows(df, chunk_rows=2))
    assert out == [(1, "a")] * 4 + [(2, "NULL")]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from("xy"))),
                max_size=60), st.integers(1, 5))
def test_duplicate_rows_matches_pandas(spark, rows, chunk):
    df = spark.createDataFrame(rows, "a int, b string")
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    expected = sorted(tuple("NULL" if v is None else v for v in r)
                      for r in pdf[pdf.duplicated()].itertuples(index=False))
    expected = [(int(a), b) for a, b in expected]
    assert _rows(duplicate_rows(df, chunk_rows=chunk)) == expected
    assert duplicate_rows(df).count() == len(rows) - distinct_rows(df).count()


def test_keyed_dedupe_combines_map_side(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS v")
    plan = dedupe_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "min_by" not in plan  # hot keys are reduced before the shuffle
