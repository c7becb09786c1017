import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.operators.profile import (
    describe, exact_quantiles, null_counts, null_counts_long, sample_rows, summary, top_n,
)


def test_null_profiles(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None), (3, 2.0, "y")],
                               "a int, b double, c string")
    wide = null_counts(df).collect()[0].asDict()
    assert wide == {"a": 1, "b": 2, "c": 1}
    long = {r["column"]: r["n_null"] for r in null_counts_long(df).collect()}
    assert long == wide


def test_summary_count_plus_nulls_is_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None), (3, 2.0, "y")],
                               "a int, b double, c string")
    counts = {k: int(v) for k, v in summary(df, "count").collect()[0].asDict().items()
              if k != "summary"}
    nulls = null_counts(df).collect()[0].asDict()
    assert all(counts[c] + nulls[c] == 3 for c in df.columns)


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(size=500), "y": rng.integers(0, 5, 500).astype(float)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r)
                                for r in pdf.itertuples(index=False)], "x double, y double")
    got = {r["column"]: r for r in describe(df).collect()}
    want = pdf.describe()
    for c in ("x", "y"):
        assert got[c]["count"] == want[c]["count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(got[c][ours], want[c][theirs], rel_tol=1e-9, abs_tol=1e-12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([5.0, 5.0, 5.0]), st.floats(-100, 100)),
                min_size=1, max_size=80), st.integers(1, 6))
def test_exact_quantiles_hot_values(spark, values, parts):
    # A value that holds most rows (a hot value) still gives exact results.
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, ["v"], (0.25, 0.5, 0.75), num_partitions=parts)
    s = pd.Series(values)
    for q in (0.25, 0.5, 0.75):
        assert math.isclose(got[("v", q)], s.quantile(q), rel_tol=1e-9, abs_tol=1e-9)


def test_sample_and_top_n(spark):
    df = spark.range(1000)
    one = sorted(r.id for r in sample_rows(df, 10, ["id"], seed=1).collect())
    assert len(set(one)) == 10
    assert one == sorted(r.id for r in sample_rows(df.repartition(7), 10, ["id"], seed=1).collect())
    assert one != sorted(r.id for r in sample_rows(df, 10, ["id"], seed=2).collect())
    assert sample_rows(df, 5000, ["id"]).count() == 1000
    assert [r.id for r in top_n(df, ["id"], 3).collect()] == [0, 1, 2]


def test_summary_matches_builtin(spark):
    df = spark.createDataFrame(
        [(1, 2.5, "10", "x"), (None, -1.0, " 2.5 ", None), (3, None, "NaN", "b"),
         (4, 8.0, "1e3", "a"), (5, 0.5, "abc", "c")],
        "i int, d double, numtext string, s string")
    ours = [tuple(r) for r in summary(df).collect()]
    builtin = [tuple(r) for r in df.summary().collect()]
    assert ours == builtin
    assert [tuple(r) for r in summary(df, "count", "max").collect()] == \
        [tuple(r) for r in df.summary("count", "max").collect()]


def test_rank_selection_on_hard_values(spark):
    """Exact quantiles of values that histograms by range would not tell apart."""
    import random

    import numpy as np
    from stellate.operators.profile import exact_quantiles

    rng = random.Random(3)
    tiny = [float(np.nextafter(1.0, 2.0)) + k * 2.0 ** -52 for k in range(5000)]
    wide = [rng.choice([-1, 1]) * 2.0 ** rng.randrange(-1070, 1020) * (1 + rng.random()) for _ in range(5000)]
    hot = [7.0] * 4000 + [0.0, -0.0] * 300 + [rng.gauss(0, 1e-3) for _ in range(400)]
    odd = [float("inf"), float("-inf"), 5e-324, -5e-324, 1.7976931348623157e308] * 7 + [None] * 4965
    rows = list(zip(tiny, wide, hot, odd))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    probs = (0.0, 0.01, 0.25, 0.5, 0.7501, 0.99, 1.0)
    found = exact_quantiles(df, ["a", "b", "c", "d"], probs)
    for i, c in enumerate("abcd"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        for q in probs:
            h = (len(values) - 1) * q
            lo = int(h)
            a, b = values[lo], values[min(lo + 1, len(values) - 1)]
            assert found[c, q] == (a if a == b or h == lo else a + (b - a) * (h - lo)), (c, q)
    plan = []
    DataFrame = type(spark.range(1))
    collect = DataFrame.collect
    try:
        DataFrame.collect = lambda self: plan.append(self._jdf.queryExecution().toString()) or collect(self)
        exact_quantiles(df, ["b"])
    finally:
        DataFrame.collect = collect
    assert plan and not [p for p in plan if "rangepartitioning" in p]


def test_nan_is_the_greatest_value(spark):
    import math
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,)], "x double")
    row = describe(df).collect()[0]
    assert row["count"] == 3 and row["p50"] == 2.0 and math.isnan(row["max"]) and math.isnan(row["p75"])


def test_a_large_sample_is_the_same_rows(spark):
    """By counts and a filter, or by an order: the same sample."""
    import stellate.operators.profile as profile

    df = spark.range(30_000).selectExpr("id", "id % 7 AS v").repartition(5)
    for n in (1, 500, 9_999, 29_999, 30_000, 40_000):
        want = {r.id for r in sample_rows(df, n, ["id"], one_task=10 ** 9).collect()}
        many = sample_rows(df, n, ["id"], one_task=0)
        rows = many.collect()
        assert len(rows) == min(n, 30_000) and {r.id for r in rows} == want
    old, profile.ONE_TASK_ROWS = profile.ONE_TASK_ROWS, 10
    try:
        deep = sample_rows(df, 12_345, ["id"], one_task=10)
        assert {r.id for r in deep.collect()} == {r.id for r in sample_rows(df, 12_345, ["id"], one_task=10 ** 9).collect()}
        # Rows that share their key, more of them than one task should take.
        same = spark.range(5_000).selectExpr("1 AS k", "id")
        assert sample_rows(same, 3_000, ["k"], one_task=10).count() == 3_000
    finally:
        profile.ONE_TASK_ROWS = old


def test_profiles_of_parts_merge_to_one_of_all(spark):
    from stellate.operators.sketches import merge_profiles, partition_profile, rank_error

    df = spark.range(60_000).selectExpr("id % 12 AS month", "id % 3 AS year", "cast(sqrt(id) AS double) AS x",
                                        "CASE WHEN id % 12 > 1 THEN id * 0.5 - 7000 END AS y", "CAST(NULL AS INT) AS z")
    parts = partition_profile(df, ["year", "month"], ["x", "y", "z"])
    assert parts.count() == 36
    for by in (["year"], []):
        merged = {tuple(r[b] for b in by) + (r["column"],): r for r in merge_profiles(parts, by).collect()}
        exact = describe(df.where("year = 1") if by else df, ["x", "y", "z"]).collect()
        for e in exact:
            m = merged[((1,) if by else ()) + (e["column"],)]
            assert m["n"] == e["count"] and m["min"] == e["min"] and m["max"] == e["max"]
            if e["count"]:
                assert m["mean"] == pytest.approx(e["mean"], rel=1e-12) and m["std"] == pytest.approx(e["std"], rel=1e-9)
                values = (df.where("year = 1") if by else df).select(e["column"]).dropna()
                for q, v in zip((0.25, 0.5, 0.75), m["quantiles"]):
                    share = values.where(F.col(e["column"]) <= v).count() / e["count"]
                    assert abs(share - q) <= 3 * rank_error()
            else:
                assert m["quantiles"] is None and m["mean"] is None
