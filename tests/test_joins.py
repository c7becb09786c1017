from stellate.operators.joins import lookup_join


def _setup(spark):
    lookup = spark.createDataFrame(
        [(1, "A", "x"), (2, "B", "y"), (3, "B", "z")], "code int, Country string, extra string")
    data = spark.createDataFrame(
        [("A", 10.0, "d1"), ("B", 20.0, "d2"), ("C", 30.0, "d3"), (None, 40.0, "d4")],
        "Country string, t double, extra string")
    return lookup, data


def test_right_join_semantics(spark):
    lookup, data = _setup(spark)
    out = lookup_join(data, lookup, "Country", defaults={"code": 0}, casts={"code": "long"})
    assert out.columns == ["code", "Country", "extra_map", "t", "extra_data"]
    rows = sorted((r.code, r.Country, r.t) for r in out.collect()
                  if r.Country is not None)
    assert rows == [(0, "C", 30.0), (1, "A", 10.0), (2, "B", 20.0), (3, "B", 20.0)]
    # every data row kept; matches multiply: sum of max(1, matches)
    assert out.count() == 1 + 2 + 1 + 1
    assert dict(out.dtypes)["code"] == "bigint"


def test_the_planner_chooses_the_join(spark):
    lookup, data = _setup(spark)
    plain = lookup_join(data, lookup, "Country")
    assert "limit" not in plain._jdf.queryExecution().optimizedPlan().toString().lower()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = sorted(map(tuple, plain.collect()), key=str)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        by_shuffle = lookup_join(data, lookup, "Country")
        assert sorted(map(tuple, by_shuffle.collect()), key=str) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_hot_and_null_keys(spark):
    lookup, _ = _setup(spark)
    data = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'A' ELSE concat('k', id) END AS Country", "id AS t")
    out = lookup_join(data, lookup, "Country", defaults={"code": 0})
    assert out.count() == 3000 and out.where("code = 1").count() == 1000
    assert out.where("Country IS NULL AND code = 0").count() == 1000
