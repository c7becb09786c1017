"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole driver tables (through the adapters in
``stellate.sources.driver_tables``) so its work grows with the scale factor.
``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
the same result in SQL over the pre-registered views.  Column names and types
match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate import schemas
from stellate.functions.columns import to_int, visa_category
from stellate.functions.dates import parse_date, register_sql_functions
from stellate.operators.columns import (
    drop_null_rows, keep_not_null, not_null_checks, require_not_null, split_rejects,
)
from stellate.operators.dedupe import (
    dedupe_by_key, distinct_rows, distinct_values, duplicate_rows, latest_per_key,
)
from stellate.operators.joins import lookup_join
from stellate.operators.keys import dense_ids, materialize
from stellate.operators.profile import (
    describe, null_counts, null_counts_long, sample_rows, summary, top_n,
)
from stellate.operators.quality import quality_report
from stellate.operators.sketches import merge_profiles, partition_profile, rank_error
from stellate.plans import tables as T
from stellate.plans.pipeline import profile_arrivals, profile_source, run_load, sources_from_driver_tables
from stellate.plans.refresh import refresh_arrivals
from stellate.sinks.files import write_csv, write_parquet
from stellate.sinks.snapshots import read_table
from stellate.session import scratch_path
from stellate.sources import driver_tables as A
from stellate.sources.files import (
    ambiguous_labels, broken_rows, demographics_broken, demographics_rejects, read_airport_codes, read_arrivals, read_demographics, read_lookup,
    read_temperatures,
)
from stellate.streaming.incremental import start_fact_stream

# ---------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect)
# ---------------------------------------------------------------------------

_DAYS = "datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE))"

ARRIVALS_SQL = f"""
SELECT
  CAST(l_orderkey AS DOUBLE) AS cicid,
  CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
  CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
  CAST(c_nationkey + 100 AS DOUBLE) AS i94cit,
  CAST(c_nationkey + 100 AS DOUBLE) AS i94res,
  substr(c_mktsegment, 1, 3) AS i94port,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
       ELSE CAST({_DAYS} AS DOUBLE) END AS arrdate,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       ELSE CAST(o_custkey % 3 + 1 AS DOUBLE) END AS i94mode,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'S' || CAST(c_nationkey AS VARCHAR) END AS i94addr,
  CASE WHEN o_orderstatus = 'O' THEN NULL
       ELSE CAST({_DAYS} + o_orderkey % 30 AS DOUBLE) END AS depdate,
  l_quantity AS i94bir,
  CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS i94visa,
  CAST(1.0 AS DOUBLE) AS "count",
  strftime(o_orderdate, '%Y%m%d') AS dtadfile,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE substr(c_mktsegment, 1, 3) END AS visapost,
  CAST(NULL AS VARCHAR) AS occup,
  o_orderstatus AS entdepa,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'O' END AS entdepd,
  CAST(NULL AS VARCHAR) AS entdepu,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'M' END AS matflag,
  CAST(2016.0 AS DOUBLE) - l_quantity AS biryear,
  strftime(l_shipdate, '%m%d%Y') AS dtaddto,
  CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'M' END AS gender,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS insnum,
  substr(o_orderpriority, 3, 2) AS airline,
  CAST(o_custkey AS DOUBLE) AS admnum,
  CAST(o_custkey % 997 AS VARCHAR) AS fltno,
  CASE o_orderstatus WHEN 'F' THEN 'B1' WHEN 'O' THEN 'B2' ELSE 'WT' END AS visatype
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
"""

TEMPERATURES_SQL = """
SELECT
  strftime(o_orderdate, '%Y-%m-%d') AS dt,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
       ELSE o_totalprice / CAST(1000.0 AS DOUBLE) END AS AverageTemperature,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL
       ELSE c_acctbal / CAST(1000.0 AS DOUBLE) END AS AverageTemperatureUncertainty,
  c_name AS City,
  lower(n_name) AS Country,
  CAST(c_nationkey * 2 AS VARCHAR) || '.05N' AS Latitude,
  CAST(n_regionkey * 10 AS VARCHAR) || '.00E' AS Longitude
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
"""

COUNTRY_LOOKUP_SQL = """
SELECT n_nationkey + 100 AS country_code,
       CASE WHEN n_regionkey = 4 THEN n_name || ' ;' ELSE n_name END AS Country
FROM nation
UNION ALL
SELECT r_regionkey + 900 AS country_code, 'NATION_' || CAST(r_regionkey AS VARCHAR) AS Country
FROM region
"""

COUNTRY_LOOKUP_CLEAN_SQL = f"""
SELECT country_code, trim(regexp_replace(Country, '\\s*;\\s*$', '')) AS Country
FROM ({COUNTRY_LOOKUP_SQL})
"""

PLACE_LOOKUP_SQL = """
SELECT CAST(c_custkey AS INTEGER) AS country_code,
       CASE WHEN c_nationkey % 5 = 4 THEN c_name || ' ;' ELSE c_name END AS Country
FROM customer
UNION ALL
SELECT CAST(c_custkey + 10000000 AS INTEGER) AS country_code, c_name AS Country
FROM customer WHERE c_custkey % 10 = 0
"""

PLACE_LOOKUP_CLEAN_SQL = f"""
SELECT country_code, trim(regexp_replace(Country, '\\s*;\\s*$', '')) AS Country
FROM ({PLACE_LOOKUP_SQL})
"""

DEMOGRAPHICS_SQL = """
SELECT
  p_name AS City,
  p_type AS State,
  CAST(p_size AS DOUBLE) AS "Median Age",
  CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice * CAST(3.0 AS DOUBLE) END AS "Male Population",
  p_retailprice * CAST(3.5 AS DOUBLE) AS "Female Population",
  CAST(p_partkey AS BIGINT) AS "Total Population",
  CASE WHEN p_size < 5 THEN NULL ELSE p_size * CAST(10.5 AS DOUBLE) END AS "Number of Veterans",
  p_retailprice / CAST(3.0 AS DOUBLE) AS "Foreign-born",
  p_retailprice / CAST(400.0 AS DOUBLE) AS "Average Household Size",
  p_brand AS "State Code",
  p_type AS Race,
  CAST(p_partkey * 2 AS BIGINT) AS "Count"
FROM part
"""


def _sas(x: str) -> str:
    return (f"CASE WHEN trunc({x}) BETWEEN -715509 AND 2936549 "
            f"THEN CAST(DATE '1960-01-01' + CAST(trunc({x}) AS INTEGER) AS DATE) END")


def _int(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS INTEGER)"


def _visa(x: str) -> str:
    return (f"CASE WHEN {_int(x)} = 1 THEN 'Business' WHEN {_int(x)} = 2 THEN 'Pleasure' "
            f"WHEN {_int(x)} = 3 THEN 'Student' ELSE 'other' END")


ARRIVALS_DATED_SQL = f"""
SELECT *, {_sas('arrdate')} AS arr_date, {_sas('depdate')} AS dep_date
FROM ({ARRIVALS_SQL})
"""

CALENDAR_SQL = f"""
SELECT arr_date,
       CAST(dayofmonth(arr_date) AS INTEGER) AS day,
       CAST(weekofyear(arr_date) AS INTEGER) AS week,
       CAST(month(arr_date) AS INTEGER) AS month,
       CAST(year(arr_date) AS INTEGER) AS year,
       CAST(dayofweek(arr_date) + 1 AS INTEGER) AS weekday
FROM (SELECT DISTINCT arr_date FROM ({ARRIVALS_DATED_SQL}) WHERE arr_date IS NOT NULL)
"""

# Output columns come from the contract in schemas.
_IMMIGRANT_COLS, _FACT_COLS, _WEATHER_OUT, _DEMOG_OUT = (
    [c for c, _ in schemas.OUTPUT_COLUMNS[t] if c not in ("immig_id", "weather_id", "demog_id")]
    for t in ("dim_immigrant", "fact_immigration", "dim_weather", "dim_usdemog"))

IMMIGRANT_SQL = f"""
SELECT * FROM (
  SELECT * FROM (
    SELECT {_int('cicid')} AS cicid, {_int('i94cit')} AS country_origin,
           {_int('biryear')} AS birth_year, gender, insnum AS insurance_num,
           {_visa('i94visa')} AS visa_category, CAST(year(arr_date) AS INTEGER) AS arr_year
    FROM ({ARRIVALS_DATED_SQL}))
  QUALIFY row_number() OVER (PARTITION BY cicid ORDER BY
      {', '.join(c + ' NULLS FIRST' for c in _IMMIGRANT_COLS[1:])}) = 1)
WHERE arr_year IS NOT NULL
"""

FACT_ROWS_SQL = f"""
SELECT {_int('cicid')} AS cicid, {_int('i94cit')} AS I94CIT, i94port AS I94PORT, arr_date,
       CAST(month(arr_date) AS INTEGER) AS month, CAST(year(arr_date) AS INTEGER) AS arr_year,
       {_int('i94mode')} AS I94MODE, i94addr AS I94ADDR, dep_date, {_visa('i94visa')} AS I94VISA,
       matflag AS MATFLAG, airline AS AIRLINE, admnum AS ADMNUM, fltno AS FLTNO,
       visatype AS VISATYPE
FROM ({ARRIVALS_DATED_SQL})
"""

FACT_SQL = f"SELECT DISTINCT * FROM ({FACT_ROWS_SQL})"

_WEATHER_TIES = ["dt", "AverageTemperature", "AverageTemperatureUncertainty", "Country",
                 "Latitude", "Longitude"]


def _weather_sql(lookup_sql: str) -> str:
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in _WEATHER_TIES)
    rest = [c for c in _WEATHER_OUT if c not in ("City", "country_code")]
    id_order = ", ".join(f"{c} NULLS FIRST" for c in ["City", "country_code"] + rest)
    return f"""
WITH t AS (
  SELECT TRY_CAST(dt AS DATE) AS dt, AverageTemperature, AverageTemperatureUncertainty,
         City, upper(Country) AS Country, Latitude, Longitude
  FROM ({TEMPERATURES_SQL})),
latest AS (
  SELECT * FROM t
  WHERE dt IS NOT NULL AND AverageTemperature IS NOT NULL AND City IS NOT NULL
    AND Country IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY City ORDER BY {ties}) = 1),
j AS (
  SELECT CAST(COALESCE(l.country_code, 0) AS BIGINT) AS country_code, latest.Country AS Country,
         latest.dt AS measure_date, latest.AverageTemperature, latest.AverageTemperatureUncertainty,
         latest.City, latest.Latitude, latest.Longitude
  FROM ({lookup_sql}) l RIGHT JOIN latest ON l.Country = latest.Country)
SELECT CAST(row_number() OVER (ORDER BY {id_order}) AS BIGINT) AS weather_id, *
FROM j
"""


WEATHER_SQL = _weather_sql(COUNTRY_LOOKUP_SQL)
WEATHER_CLEAN_SQL = _weather_sql(COUNTRY_LOOKUP_CLEAN_SQL)


def _fill_long(x: str) -> str:
    return f"CAST(trunc(COALESCE({x}, 0)) AS BIGINT)"


DEMOG_DIM_SQL = f"""
WITH d AS (
  SELECT City, "Median Age" AS median_age,
         {_fill_long('"Male Population"')} AS male_pop,
         {_fill_long('"Female Population"')} AS female_pop,
         "Total Population" AS tot_pop,
         {_fill_long('"Number of Veterans"')} AS veteran_pop,
         {_fill_long('"Foreign-born"')} AS foreign_born,
         {_fill_long('"Average Household Size"')} AS avg_hose_size,
         "State Code" AS state_code, Race
  FROM ({DEMOGRAPHICS_SQL}))
SELECT CAST(row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in ['City', 'state_code', 'Race'] + [c for c in _DEMOG_OUT if c not in ('City', 'state_code', 'Race')])}) AS BIGINT) AS demog_id,
       {', '.join(_DEMOG_OUT)}
FROM d
"""

_DATED_COLS = schemas.ARRIVALS.fieldNames() + ["arr_date", "dep_date"]


def _null_wide_sql(cols, source) -> str:
    sel = ", ".join(f'CAST(count_if("{c}" IS NULL) AS BIGINT) AS "{c}"' for c in cols)
    return f"SELECT {sel} FROM ({source})"


def _null_long_sql(cols, source) -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST(count_if("{c}" IS NULL) AS BIGINT) AS n_null FROM src"""
             for c in cols]
    return f"WITH src AS ({source}) " + " UNION ALL ".join(parts)


def _describe_sql(cols, source) -> str:
    casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)
    on = ", ".join(f'"{c}"' for c in cols)
    return f"""
SELECT col AS "column", count(v) AS "count", round(round(avg(v), 9), 6) AS mean,
       round(round(stddev_samp(v), 9), 6) AS std, min(v) AS "min",
       round(round(quantile_cont(v, 0.25), 9), 6) AS p25,
       round(round(quantile_cont(v, 0.5), 9), 6) AS p50,
       round(round(quantile_cont(v, 0.75), 9), 6) AS p75, max(v) AS "max"
FROM (UNPIVOT (SELECT {casts} FROM ({source})) ON {on} INTO NAME col VALUE v)
GROUP BY col
"""


def _checks_sql(name: str, source: str, key: str) -> str:
    return f"""
SELECT '{name}' AS "table", c."check", s.n_rows,
       CAST(CASE WHEN c."check" = 'not_empty' THEN (CASE WHEN s.n_rows < 1 THEN 1 ELSE 0 END)
                 ELSE s.n_null END AS BIGINT) AS n_bad,
       CASE WHEN c."check" = 'not_empty' THEN s.n_rows >= 1 ELSE s.n_null <= 0 END AS passed
FROM (SELECT count(*) AS n_rows, CAST(coalesce(count_if("{key}" IS NULL), 0) AS BIGINT) AS n_null
      FROM ({source})) s,
     (VALUES ('not_empty'), ('null_key')) c("check")
"""


_STAR_CHECK_SOURCES = [
    ("fact_immigration", f"SELECT *, row_number() OVER () AS immig_id FROM ({FACT_SQL})", "immig_id"),
    ("dim_immigrant", IMMIGRANT_SQL, "cicid"),
    ("dim_weather", WEATHER_SQL, "weather_id"),
    ("dim_calendar", CALENDAR_SQL, "arr_date"),
    ("dim_usdemog", DEMOG_DIM_SQL, "demog_id"),
]

QUALITY_SQL = " UNION ALL ".join(_checks_sql(n, s, k) for n, s, k in _STAR_CHECK_SOURCES)

_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]
_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]
_DEMOG_NUMERIC = ["Median Age", "Male Population", "Female Population", "Total Population",
                  "Number of Veterans", "Foreign-born", "Average Household Size", "Count"]
_TEMP_NUMERIC = ["AverageTemperature", "AverageTemperatureUncertainty"]
_DISTINCT_COLS = ["i94port", "i94mode", "i94visa", "gender", "visatype", "airline"]
_ROUNDTRIP_YEAR = 1998
_MOMENT_COLS = ["cicid", "i94cit", "arrdate", "i94bir", "biryear"]
_QUARTILE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
# Arrivals in which every fifth traveller has no key.
_NULL_KEY_ARRIVALS_SQL = f"""
SELECT * REPLACE (CASE WHEN cicid % 5 <> 0 THEN cicid END AS cicid) FROM ({ARRIVALS_SQL})
"""

# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------


def _arrivals_dated(spark, d):
    return T.with_arrival_dates(A.arrivals(spark, d))


def q_arrivals_adapter(spark, d):
    return A.arrivals(spark, d)


def q_sas_date(spark, d):
    return _arrivals_dated(spark, d).select("cicid", "arrdate", "arr_date", "depdate", "dep_date")


def q_dim_calendar(spark, d):
    return T.build_dim_calendar(A.arrivals(spark, d), null_dates="drop")


def q_visa_category(spark, d):
    a = A.arrivals(spark, d)
    return a.select(to_int("cicid").alias("cicid"), "i94visa",
                    visa_category("i94visa").alias("visa_category"))


def q_latest_per_key(spark, d):
    orders = A.table(spark, d, "orders")
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def q_lookup_right_join(spark, d):
    temps = A.temperatures(spark, d).withColumn("Country", F.upper("Country"))
    return lookup_join(temps, A.country_lookup(spark, d), "Country",
                       defaults={"country_code": 0}, casts={"country_code": "long"})


def q_null_profile_wide(spark, d):
    return null_counts(_arrivals_dated(spark, d))


def q_null_profile_long(spark, d):
    return null_counts_long(A.arrivals(spark, d))


def q_duplicate_rows(spark, d):
    return duplicate_rows(T.fact_rows(_arrivals_dated(spark, d)))


def _r6(c):
    # Two-step rounding: engines that differ in the last bit agree after the
    # first step, so the second never sees different doubles.
    return F.round(F.round(c, 9), 6).alias(c)


def _rounded_describe(df, cols):
    out = describe(df, cols)
    return out.select("column", "count", _r6("mean"), _r6("std"), "min",
                      _r6("p25"), _r6("p50"), _r6("p75"), "max")


def q_describe_exact(spark, d):
    return _rounded_describe(A.demographics(spark, d), _DEMOG_NUMERIC)


def q_describe_temperatures(spark, d):
    return _rounded_describe(A.temperatures(spark, d), _TEMP_NUMERIC)


def q_dim_immigrant(spark, d):
    return T.build_dim_immigrant(_arrivals_dated(spark, d))


def q_fact_immigration(spark, d):
    return T.build_fact_immigration(_arrivals_dated(spark, d), with_id=False)


def q_dim_weather(spark, d):
    return T.build_dim_weather(A.temperatures(spark, d), A.country_lookup(spark, d))


def q_dim_usdemog(spark, d):
    return T.build_dim_usdemog(A.demographics(spark, d))


def q_drop_null_rows(spark, d):
    a = keep_not_null(A.arrivals(spark, d), "depdate")
    return drop_null_rows(a, ["i94addr", "gender"])


def q_distinct_rows(spark, d):
    return distinct_rows(A.arrivals(spark, d).select(*_DISTINCT_COLS))


def q_dedupe_by_key(spark, d):
    return dedupe_by_key(A.table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber"])


def q_surrogate_unique(spark, d):
    fact = T.build_fact_immigration(_arrivals_dated(spark, d), with_id=True)
    return fact.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_distinct("immig_id").alias("n_distinct_ids"),
                    (F.min("immig_id") >= 1).alias("min_at_least_one"))


def q_surrogate_dense(spark, d):
    return dense_ids(A.table(spark, d, "orders"), ["o_orderkey"], name="id")


def _star_tables(spark, d):
    """The five star tables without their non-null key assertions: an
    asserted key is proven non-null by the optimizer, so a null-key check on
    it would be folded away instead of counting."""
    dated = _arrivals_dated(spark, d)
    return {
        "fact_immigration": (T.build_fact_immigration(dated, assert_keys=False), "immig_id"),
        "dim_immigrant": (T.build_dim_immigrant(dated, assert_keys=False), "cicid"),
        "dim_weather": (T.build_dim_weather(A.temperatures(spark, d),
                                            A.country_lookup(spark, d)), "weather_id"),
        "dim_calendar": (T.build_dim_calendar(A.arrivals(spark, d), null_dates="drop",
                                              assert_keys=False), "arr_date"),
        "dim_usdemog": (T.build_dim_usdemog(A.demographics(spark, d)), "demog_id"),
    }


def q_quality_report(spark, d):
    return quality_report(_star_tables(spark, d))


def q_require_not_null(spark, d):
    a = _arrivals_dated(spark, d).where(F.col("arr_date").isNotNull())
    return require_not_null(a.select(to_int("cicid").alias("cicid"), "arr_date"),
                            ["cicid", "arr_date"])


def q_top_n(spark, d):
    return top_n(A.table(spark, d, "orders"), ["o_custkey", "o_orderkey"], 20)


def q_sample_rows(spark, d):
    return sample_rows(A.table(spark, d, "lineitem"), 100, key=["l_orderkey", "l_linenumber"], seed=7)


def q_summary_approx(spark, d):
    return summary(A.arrivals(spark, d))


def q_summary_moments(spark, d):
    """The exact rows of the summary, as numbers: one row per column and statistic."""
    wide = summary(A.arrivals(spark, d).select(*_MOMENT_COLS), "count", "mean", "stddev", "min", "max")
    return wide.unpivot(["summary"], _MOMENT_COLS, "column", "value").select(
        "column", F.col("summary").alias("statistic"), F.round(F.col("value").cast("double"), 6).alias("value"))


def q_summary_quartiles(spark, d):
    """Whether each approximate quartile's rank is within its bound."""
    a = A.table(spark, d, "lineitem")
    accuracy = 1000
    q = (summary(a.select(*_QUARTILE_COLS), "25%", "50%", "75%", accuracy=accuracy)
         .unpivot(["summary"], _QUARTILE_COLS, "column", "value")
         .select("column", "summary", F.col("value").cast("double").alias("value")))
    values = a.select(*[F.col(c).cast("double").alias(c) for c in _QUARTILE_COLS]).unpivot(
        [], _QUARTILE_COLS, "column", "v").where("v IS NOT NULL")
    ranks = (values.join(F.broadcast(q), "column").groupBy("column", "summary")
             .agg(F.count_if(F.col("v") < F.col("value")).alias("below"),
                  F.count_if(F.col("v") <= F.col("value")).alias("upto"), F.count(F.lit(1)).alias("n")))
    want = F.expr("CAST(replace(summary, '%', '') AS DOUBLE) / 100") * F.col("n")
    slack = F.col("n") / accuracy + 1
    return ranks.select("column", F.col("summary").alias("quartile"), "n",
                        ((F.col("below") <= want + slack) & (F.col("upto") >= want - slack)).alias("within_bound"))


def _roundtrip(spark, d):
    fact = T.build_fact_immigration(_arrivals_dated(spark, d))
    path = scratch_path(spark, "fact_roundtrip")
    write_parquet(fact, path, partition_by="arr_year")
    return spark.read.parquet(path).select(*_FACT_COLS)


def q_partitioned_roundtrip(spark, d):
    """All partitions, the one of rows without a year included."""
    return _roundtrip(spark, d)


def q_partition_pruned(spark, d):
    return _roundtrip(spark, d).where(F.col("arr_year") == _ROUNDTRIP_YEAR)


def q_demographics_csv(spark, d):
    path = scratch_path(spark, "demographics_csv")
    write_csv(A.demographics(spark, d), path, sep=";")
    return T.build_dim_usdemog(read_demographics(spark, path))


def q_weather_csv(spark, d):
    temps_path = scratch_path(spark, "temperatures_csv")
    lookup_path = scratch_path(spark, "country_lookup_csv")
    write_csv(A.temperatures(spark, d), temps_path)
    write_csv(A.country_lookup(spark, d), lookup_path, single_file=True)
    return T.build_dim_weather(read_temperatures(spark, temps_path),
                               read_lookup(spark, lookup_path, "country", clean=True))


def q_distinct_values(spark, d):
    return distinct_values(A.arrivals(spark, d), "i94port")


def _lookup_csv(spark, d):
    path = scratch_path(spark, "place_lookup_csv")
    write_csv(A.place_lookup(spark, d), path)
    return path


def q_lookup_clean(spark, d):
    return T.build_lookup(spark, _lookup_csv(spark, d), "country", clean=True)


def q_lookup_raw(spark, d):
    return T.build_lookup(spark, _lookup_csv(spark, d), "country", clean=False)


def q_star_load(spark, d):
    """End-to-end: build, write and check the five star tables."""
    return run_load(spark, sources_from_driver_tables(spark, d), scratch_path(spark, "star"),
                    calendar_null_dates="drop")


def _loaded(spark, d, name):
    """One table of a load, read back whole."""
    out = scratch_path(spark, "star")
    run_load(spark, sources_from_driver_tables(spark, d), out, calendar_null_dates="drop", write_lookups=False,
             tables=[name])
    return read_table(spark, out, name)


def q_star_fact(spark, d):
    return _loaded(spark, d, "fact_immigration").select(*_FACT_COLS)


def q_star_immigrant(spark, d):
    return _loaded(spark, d, "dim_immigrant")


def q_star_weather(spark, d):
    return _loaded(spark, d, "dim_weather")


def q_star_calendar(spark, d):
    return _loaded(spark, d, "dim_calendar")


def q_star_usdemog(spark, d):
    return _loaded(spark, d, "dim_usdemog")


def q_star_load_bad_keys(spark, d):
    """A load with null traveller keys, undated arrivals kept in the calendar
    and an empty table: the report says so."""
    src = sources_from_driver_tables(spark, d)
    src.arrivals = src.arrivals.withColumn("cicid", F.when(F.col("cicid") % 5 != 0, F.col("cicid")))
    src.demographics = src.demographics.where(F.col("Total Population") < 0)
    return run_load(spark, src, scratch_path(spark, "star_bad"), on_fail="report", write_lookups=False)


def _broken_demographics(spark, d):
    """Demographics as text with some numbers that are none."""
    df = A.demographics(spark, d)
    bad = F.col("Total Population") % 50
    return df.select(*[F.when((bad == 1) & F.lit(c == "Male Population"), F.lit("many"))
                       .when((bad == 2) & F.lit(c == "Count"), F.lit("1,000"))
                       .otherwise(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def q_csv_rejects(spark, d):
    path = scratch_path(spark, "broken_csv")
    write_csv(_broken_demographics(spark, d), path, sep=";")
    return demographics_rejects(spark, path)


def q_csv_without_rejects(spark, d):
    """Rows with a malformed number are left out, not filled with 0."""
    path = scratch_path(spark, "broken_csv")
    write_csv(_broken_demographics(spark, d), path, sep=";")
    return T.build_dim_usdemog(read_demographics(spark, path))


def q_profile_demographics_nulls(spark, d):
    return profile_source(A.demographics(spark, d))["nulls"]


def q_profile_temperatures_nulls(spark, d):
    return profile_source(A.temperatures(spark, d))["nulls"]


def q_profile_temperatures_duplicates(spark, d):
    """Readings that are there more than once, in all their columns; those of
    some days are read twice."""
    t = A.temperatures(spark, d)
    return duplicate_rows(t.unionByName(t.where(F.substring("dt", 10, 1) == "5")))


def q_arrivals_file(spark, d):
    path = scratch_path(spark, "sas_data")
    write_parquet(A.arrivals(spark, d), path, mode="errorifexists")
    return read_arrivals(spark, path)


def q_airport_csv(spark, d):
    """Suppliers in the shape of the airport code file."""
    s = A.table(spark, d, "supplier")
    cols = {f.name: F.lit(None).cast("string") for f in schemas.AIRPORT_CODES.fields}
    cols |= {"ident": F.col("s_suppkey").cast("string"), "type": F.lit("small, closed"), "name": F.col("s_name"),
             "elevation_ft": F.col("s_suppkey").cast("string"), "iso_region": F.lit("NA")}
    path = scratch_path(spark, "airport_csv")
    write_csv(s.select(*[c.alias(n) for n, c in cols.items()]), path)
    return read_airport_codes(spark, path)


def q_port_lookup(spark, d):
    s = A.table(spark, d, "supplier").select(F.concat(F.lit("  "), F.col("s_suppkey").cast("string")).alias("port_code"),
                                             F.concat("s_name", F.lit(" ;")).alias("port_name"))
    path = scratch_path(spark, "port_csv")
    write_csv(s, path)
    return T.build_lookup(spark, path, "port")


def q_state_lookup(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("state_code"),
                                             F.concat(F.lit(" "), "c_name").alias("state"))
    path = scratch_path(spark, "state_csv")
    write_csv(c, path)
    return T.build_lookup(spark, path, "state")


def q_sas_date_sql(spark, d):
    register_sql_functions(spark)
    return A.arrivals(spark, d).selectExpr("cicid", "sas_date(arrdate) AS arr_date", "sas_date(depdate) AS dep_date")


def q_ambiguous_labels(spark, d):
    lookup = read_lookup(spark, _lookup_csv(spark, d), "country")
    return ambiguous_labels(lookup, "country_code", "Country")


def _broken_lines(spark, d):
    """Demographics as lines of text: some have lost their last field, some
    have one too many."""
    df = A.demographics(spark, d)
    line = F.concat_ws(";", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    kind = F.col("Total Population") % 40
    path = scratch_path(spark, "broken_lines")
    df.select(F.when(kind == 3, F.substring_index(line, ";", len(df.columns) - 1))
              .when(kind == 4, F.concat(line, F.lit(";left over"))).otherwise(line)).write.text(path)
    return path


def q_csv_broken_rows(spark, d):
    return demographics_broken(spark, _broken_lines(spark, d), header=False)


def q_csv_broken_records(spark, d):
    """The broken records themselves, by their city."""
    rows = broken_rows(spark, _broken_lines(spark, d), schemas.DEMOGRAPHICS, sep=";", header=False)
    return rows.select("defect", F.col("n_fields").cast("long").alias("n_fields"),
                       F.substring_index("record", ";", 1).alias("city"))


def q_csv_without_broken(spark, d):
    return T.build_dim_usdemog(read_demographics(spark, _broken_lines(spark, d), header=False))


def q_partition_refresh(spark, d):
    """A late delivery of one year into a table that is there: that year is
    replaced, the files of all others stay."""
    fact = T.build_fact_immigration(_arrivals_dated(spark, d), with_id=False)
    path = scratch_path(spark, "fact_refresh")
    write_parquet(fact, path, partition_by="arr_year")

    def state():
        rows = spark.read.schema(fact.schema).parquet(path)
        return materialize(rows.withColumn("f", F.input_file_name()).groupBy("arr_year").agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("f")).alias("files")), "fact_files")

    before = state().alias("b")
    late = fact.where((F.col("arr_year") == _ROUNDTRIP_YEAR) & (F.col("cicid") % 2 == 0))
    write_parquet(late, path, partition_by="arr_year", touched_only=True)
    after = state().alias("a")
    return before.join(after, F.col("a.arr_year").eqNullSafe(F.col("b.arr_year"))).select(
        "a.arr_year", F.col("b.n").alias("n_before"), F.col("a.n").alias("n_after"),
        (F.col("a.files") == F.col("b.files")).alias("same_files"))


def _refreshed(spark, d, name):
    """A table after two deliveries; records of one traveller are in both."""
    out = scratch_path(spark, "star_refresh")
    a = A.arrivals(spark, d)
    for part in (0, 1):
        refresh_arrivals(spark, a.where(F.col("biryear") % 2 == part), out)
    return read_table(spark, out, name)


def q_refresh_immigrant(spark, d):
    return _refreshed(spark, d, "dim_immigrant")


def q_refresh_fact(spark, d):
    return _refreshed(spark, d, "fact_immigration").select(*_FACT_COLS)


def q_sample_third(spark, d):
    rows = A.table(spark, d, "lineitem")
    return sample_rows(rows, rows.count() // 3, key=["l_orderkey", "l_linenumber"], seed=7)


def q_profile_years(spark, d):
    """Profiles kept per month, merged to years: moments, and whether each
    quartile's rank is within the sketches' bound."""
    a = A.arrivals(spark, d).select("i94yr", "i94mon", *_MOMENT_COLS)
    path = scratch_path(spark, "month_profiles")
    write_parquet(partition_profile(a, ["i94yr", "i94mon"], _MOMENT_COLS), path, partition_by="i94yr")
    merged = merge_profiles(spark.read.parquet(path).withColumn("i94yr", F.col("i94yr").cast("double")), ["i94yr"])
    merged = materialize(merged, "year_profiles")
    values = a.drop("i94mon").unpivot(["i94yr"], _MOMENT_COLS, "column", "v").where("v IS NOT NULL")
    wanted = merged.select("i94yr", "column", F.posexplode("quantiles").alias("q", "value"))
    # A few rows a year and column.
    near = values.alias("v").join(F.broadcast(wanted.alias("w")), (F.col("v.i94yr") == F.col("w.i94yr")) & (
        F.col("v.column") == F.col("w.column"))).groupBy("w.i94yr", "w.column", "q").agg(
        F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto"),
        F.count(F.lit(1)).alias("n"))
    want, slack = F.col("n") * (F.col("q") + 1) / 4, F.col("n") * 3 * rank_error() + 1
    within = near.groupBy("i94yr", "column").agg(
        F.bool_and((F.col("below") <= want + slack) & (F.col("upto") >= want - slack)).alias("within_bound")).alias("r")
    return merged.alias("m").join(within, (F.col("m.i94yr") == F.col("r.i94yr")) & (F.col("m.column") == F.col("r.column"))
                                  ).select("m.i94yr", "m.column", "m.n", "m.n_null", F.round("m.mean", 6).alias("mean"),
                                           F.round("m.std", 6).alias("std"), "m.min", "m.max", "r.within_bound")


def q_quarantined_rows(spark, d):
    """Rows that fail the non-null checks, kept with their reason; the others
    pass the assertion."""
    a = _arrivals_dated(spark, d).select("cicid", "arr_date", "i94addr", "fltno")
    good, bad = split_rejects(a, not_null_checks(["arr_date", "i94addr"]), scratch_path(spark, "rejects"))
    kept = require_not_null(good, ["arr_date", "i94addr"]).withColumn("reason", F.lit(None).cast("string"))
    return bad.unionByName(kept)


def q_profile_arrivals_files(spark, d):
    """The two profile files of the arrivals, read back: nulls and values per column."""
    path = scratch_path(spark, "arrivals_profile")
    profile_arrivals(A.arrivals(spark, d), path)
    nulls = spark.read.option("header", True).csv(f"{path}/arrivals_null_profile")
    summ = spark.read.option("header", True).csv(f"{path}/arrivals_summary").where("summary = 'count'").drop("summary")
    long = [f.unpivot([], f.columns, "column", n).withColumn(n, F.col(n).cast("long"))
            for f, n in ((nulls, "n_null"), (summ, "n_values"))]
    return long[0].join(long[1], "column", "left")


def q_strict_dates(spark, d):
    return A.temperatures(spark, d).select("City", parse_date("dt", strict=True).alias("measure_date"))


def q_incremental_fact(spark, d):
    """The fact table loaded by the streaming job, one file per micro-batch."""
    feed = scratch_path(spark, "arrivals_feed")
    write_parquet(A.arrivals(spark, d), feed)
    out = scratch_path(spark, "fact_stream")
    query = start_fact_stream(spark, feed, out, scratch_path(spark, "fact_stream_state"),
                              max_files_per_trigger=4)
    query.awaitTermination()
    return spark.read.parquet(out).select(*_FACT_COLS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "arrivals_adapter": q_arrivals_adapter,
    "sas_date": q_sas_date,
    "dim_calendar": q_dim_calendar,
    "visa_category": q_visa_category,
    "latest_per_key": q_latest_per_key,
    "lookup_right_join": q_lookup_right_join,
    "null_profile_wide": q_null_profile_wide,
    "null_profile_long": q_null_profile_long,
    "duplicate_rows": q_duplicate_rows,
    "describe_exact": q_describe_exact,
    "describe_temperatures": q_describe_temperatures,
    "dim_immigrant": q_dim_immigrant,
    "fact_immigration": q_fact_immigration,
    "dim_weather": q_dim_weather,
    "dim_usdemog": q_dim_usdemog,
    "drop_null_rows": q_drop_null_rows,
    "distinct_rows": q_distinct_rows,
    "dedupe_by_key": q_dedupe_by_key,
    "surrogate_unique": q_surrogate_unique,
    "surrogate_dense": q_surrogate_dense,
    "quality_report": q_quality_report,
    "require_not_null": q_require_not_null,
    "top_n": q_top_n,
    "sample_rows": q_sample_rows,
    "summary_approx": q_summary_approx,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "demographics_csv": q_demographics_csv,
    "weather_csv": q_weather_csv,
    "star_load": q_star_load,
    "incremental_fact": q_incremental_fact,
    "distinct_values": q_distinct_values,
    "lookup_clean": q_lookup_clean,
    "lookup_raw": q_lookup_raw,
    "summary_moments": q_summary_moments,
    "summary_quartiles": q_summary_quartiles,
    "partition_pruned": q_partition_pruned,
    "star_fact": q_star_fact,
    "star_immigrant": q_star_immigrant,
    "star_weather": q_star_weather,
    "star_calendar": q_star_calendar,
    "star_usdemog": q_star_usdemog,
    "star_load_bad_keys": q_star_load_bad_keys,
    "csv_rejects": q_csv_rejects,
    "csv_without_rejects": q_csv_without_rejects,
    "profile_demographics_nulls": q_profile_demographics_nulls,
    "profile_temperatures_nulls": q_profile_temperatures_nulls,
    "profile_temperatures_duplicates": q_profile_temperatures_duplicates,
    "arrivals_file": q_arrivals_file,
    "airport_csv": q_airport_csv,
    "port_lookup": q_port_lookup,
    "state_lookup": q_state_lookup,
    "sas_date_sql": q_sas_date_sql,
    "ambiguous_labels": q_ambiguous_labels,
    "csv_broken_rows": q_csv_broken_rows,
    "csv_broken_records": q_csv_broken_records,
    "csv_without_broken": q_csv_without_broken,
    "partition_refresh": q_partition_refresh,
    "refresh_immigrant": q_refresh_immigrant,
    "refresh_fact": q_refresh_fact,
    "sample_third": q_sample_third,
    "profile_years": q_profile_years,
    "quarantined_rows": q_quarantined_rows,
    "profile_arrivals_files": q_profile_arrivals_files,
    "strict_dates": q_strict_dates,
}

#: Queries that exist to compare contents; they repeat work that others time.
CONTENT_CHECKS = frozenset({
    "summary_moments", "summary_quartiles", "partition_pruned", "star_fact", "star_immigrant", "star_weather",
    "star_calendar", "star_usdemog", "star_load_bad_keys", "csv_rejects", "csv_without_rejects",
    "profile_demographics_nulls", "profile_temperatures_nulls", "profile_temperatures_duplicates", "arrivals_file",
    "airport_csv", "port_lookup", "state_lookup", "sas_date_sql", "ambiguous_labels",
    "csv_broken_rows", "csv_broken_records", "csv_without_broken", "partition_refresh", "refresh_immigrant",
    "refresh_fact", "sample_third", "profile_years", "quarantined_rows", "profile_arrivals_files", "strict_dates",
})

_DEDUPE_ORDER = ["l_linenumber"] + [c for c in _LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]
_LATEST_ORDER = ["o_orderdate", "o_orderkey"] + [c for c in _ORDERS_COLS if c not in ("o_custkey", "o_orderdate", "o_orderkey")]
_DENSE_ORDER = _ORDERS_COLS

ORACLE_SQL: dict[str, str] = {
    "arrivals_adapter": ARRIVALS_SQL,
    "sas_date": f"SELECT cicid, arrdate, arr_date, depdate, dep_date FROM ({ARRIVALS_DATED_SQL})",
    "dim_calendar": CALENDAR_SQL,
    "visa_category": f"SELECT {_int('cicid')} AS cicid, i94visa, {_visa('i94visa')} AS visa_category FROM ({ARRIVALS_SQL})",
    "latest_per_key": f"""SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
        ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _LATEST_ORDER)}) = 1""",
    "lookup_right_join": f"""
        SELECT CAST(COALESCE(l.country_code, 0) AS BIGINT) AS country_code, t.Country AS Country,
               t.dt, t.AverageTemperature, t.AverageTemperatureUncertainty, t.City, t.Latitude,
               t.Longitude
        FROM ({COUNTRY_LOOKUP_SQL}) l
        RIGHT JOIN (SELECT dt, AverageTemperature, AverageTemperatureUncertainty, City,
                           upper(Country) AS Country, Latitude, Longitude
                    FROM ({TEMPERATURES_SQL})) t
        ON l.Country = t.Country""",
    "null_profile_wide": _null_wide_sql(_DATED_COLS, ARRIVALS_DATED_SQL),
    "null_profile_long": _null_long_sql(schemas.ARRIVALS.fieldNames(), ARRIVALS_SQL),
    "duplicate_rows": f"SELECT * FROM ({FACT_ROWS_SQL}) EXCEPT ALL SELECT DISTINCT * FROM ({FACT_ROWS_SQL})",
    "describe_exact": _describe_sql(_DEMOG_NUMERIC, DEMOGRAPHICS_SQL),
    "describe_temperatures": _describe_sql(_TEMP_NUMERIC, TEMPERATURES_SQL),
    "dim_immigrant": IMMIGRANT_SQL,
    "fact_immigration": FACT_SQL,
    "dim_weather": WEATHER_SQL,
    "dim_usdemog": DEMOG_DIM_SQL,
    "drop_null_rows": f"""SELECT * FROM ({ARRIVALS_SQL})
        WHERE depdate IS NOT NULL AND i94addr IS NOT NULL AND gender IS NOT NULL""",
    "distinct_rows": f"SELECT DISTINCT {', '.join(_DISTINCT_COLS)} FROM ({ARRIVALS_SQL})",
    "dedupe_by_key": f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY {', '.join(c + ' NULLS FIRST' for c in _DEDUPE_ORDER)}) = 1""",
    "surrogate_unique": f"""SELECT count(*) AS n_rows, count(*) AS n_distinct_ids,
        true AS min_at_least_one FROM ({FACT_SQL})""",
    "surrogate_dense": f"""SELECT CAST(row_number() OVER (ORDER BY
        {', '.join(c + ' NULLS FIRST' for c in _DENSE_ORDER)}) AS BIGINT) AS id, * FROM orders""",
    "quality_report": QUALITY_SQL,
    "require_not_null": f"""SELECT {_int('cicid')} AS cicid, arr_date FROM ({ARRIVALS_DATED_SQL})
        WHERE arr_date IS NOT NULL""",
    "top_n": "SELECT * FROM orders ORDER BY o_custkey, o_orderkey LIMIT 20",
    "partitioned_roundtrip": FACT_SQL,
    "partition_pruned": f"SELECT * FROM ({FACT_SQL}) WHERE arr_year = {_ROUNDTRIP_YEAR}",
    "star_fact": FACT_SQL,
    "star_immigrant": IMMIGRANT_SQL,
    "star_weather": WEATHER_SQL,
    "star_calendar": CALENDAR_SQL,
    "star_usdemog": DEMOG_DIM_SQL,
    "star_load_bad_keys": " UNION ALL ".join(
        _checks_sql(n, f"SELECT * FROM ({q}) WHERE false" if n == "dim_usdemog" else q.replace(
            ARRIVALS_SQL, _NULL_KEY_ARRIVALS_SQL).replace("WHERE arr_date IS NOT NULL)", ")"), k)
        for n, q, k in _STAR_CHECK_SOURCES),
    "csv_rejects": """
        SELECT c."column", (SELECT count(*) FROM part) AS n_rows,
               CAST((SELECT count(*) FROM part WHERE p_partkey % 50 = c.bad) AS BIGINT) AS n_bad
        FROM (VALUES ('Median Age', -1), ('Male Population', 1), ('Female Population', -1), ('Total Population', -1),
                     ('Number of Veterans', -1), ('Foreign-born', -1), ('Average Household Size', -1),
                     ('Count', 2)) c("column", bad)""",
    "csv_without_rejects": DEMOG_DIM_SQL.replace("FROM part", "FROM part WHERE p_partkey % 50 NOT IN (1, 2)"),
    "profile_demographics_nulls": _null_long_sql(schemas.DEMOGRAPHICS.fieldNames(), DEMOGRAPHICS_SQL),
    "profile_temperatures_nulls": _null_long_sql(schemas.TEMPERATURES.fieldNames(), TEMPERATURES_SQL),
    "profile_temperatures_duplicates": f"""
        WITH t AS (SELECT * FROM ({TEMPERATURES_SQL}) UNION ALL
                   SELECT * FROM ({TEMPERATURES_SQL}) WHERE substr(dt, 10, 1) = '5')
        SELECT * FROM t EXCEPT ALL SELECT DISTINCT * FROM t""",
    "arrivals_file": ARRIVALS_SQL,
    "airport_csv": "SELECT " + ", ".join(
        {"ident": "CAST(s_suppkey AS VARCHAR)", "type": "'small, closed'", "name": "s_name",
         "elevation_ft": "CAST(s_suppkey AS DOUBLE)"}.get(f.name, "CAST(NULL AS VARCHAR)") + f" AS {f.name}"
        for f in schemas.AIRPORT_CODES.fields) + " FROM supplier",
    "port_lookup": "SELECT CAST(s_suppkey AS VARCHAR) AS port_code, s_name AS port_name FROM supplier",
    "state_lookup": "SELECT CAST(c_custkey AS VARCHAR) AS state_code, c_name AS state FROM customer",
    "sas_date_sql": f"SELECT cicid, arr_date, dep_date FROM ({ARRIVALS_DATED_SQL})",
    "ambiguous_labels": f"""SELECT Country AS label, count(DISTINCT country_code) AS n_codes,
        CAST(min(country_code) AS VARCHAR) AS first_code, CAST(max(country_code) AS VARCHAR) AS last_code
        FROM ({PLACE_LOOKUP_CLEAN_SQL}) GROUP BY Country HAVING count(DISTINCT country_code) > 1""",
    "sample_rows": """SELECT * FROM lineitem
        ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber LIMIT 100""",
    "summary_moments": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{n}' AS statistic, round(CAST({f}("{c}") AS DOUBLE), 6) AS value
            FROM ({ARRIVALS_SQL})"""
        for c in _MOMENT_COLS for n, f in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"),
                                           ("min", "min"), ("max", "max"))),
    "summary_quartiles": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{q}' AS quartile, count("{c}") AS n, true AS within_bound FROM lineitem"""
        for c in _QUARTILE_COLS for q in ("25%", "50%", "75%")),
    "csv_broken_rows": """
        SELECT d.defect, (SELECT count(*) FROM part) AS n_rows,
               CAST((SELECT count(*) FROM part WHERE p_partkey % 40 = d.kind) AS BIGINT) AS n_bad
        FROM (VALUES ('too_few_fields', 3), ('too_many_fields', 4)) d(defect, kind)""",
    "csv_broken_records": """
        SELECT CASE p_partkey % 40 WHEN 3 THEN 'too_few_fields' ELSE 'too_many_fields' END AS defect,
               CAST(CASE p_partkey % 40 WHEN 3 THEN 11 ELSE 13 END AS BIGINT) AS n_fields, p_name AS city
        FROM part WHERE p_partkey % 40 IN (3, 4)""",
    "csv_without_broken": DEMOG_DIM_SQL.replace("FROM part", "FROM part WHERE p_partkey % 40 NOT IN (3, 4)"),
    "partition_refresh": f"""
        SELECT arr_year, count(*) AS n_before,
               CAST(CASE WHEN arr_year = {_ROUNDTRIP_YEAR} THEN count_if(cicid % 2 = 0) ELSE count(*) END AS BIGINT) AS n_after,
               arr_year IS DISTINCT FROM {_ROUNDTRIP_YEAR} AS same_files
        FROM ({FACT_SQL}) GROUP BY arr_year""",
    "refresh_immigrant": IMMIGRANT_SQL,
    "refresh_fact": FACT_SQL,
    "sample_third": """SELECT * FROM lineitem
        ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber
        LIMIT (SELECT count(*) // 3 FROM lineitem)""",
    "profile_years": " UNION ALL ".join(
        f"""SELECT i94yr, '{c}' AS "column", count("{c}") AS n, CAST(count(*) - count("{c}") AS BIGINT) AS n_null,
                   round(avg("{c}"), 6) AS mean, round(stddev_samp("{c}"), 6) AS std, min("{c}") AS "min",
                   max("{c}") AS "max", true AS within_bound FROM ({ARRIVALS_SQL}) GROUP BY i94yr"""
        for c in _MOMENT_COLS),
    "quarantined_rows": f"""
        SELECT cicid, arr_date, i94addr, fltno, nullif(concat_ws(';', CASE WHEN arr_date IS NULL THEN 'null arr_date' END,
               CASE WHEN i94addr IS NULL THEN 'null i94addr' END), '') AS reason
        FROM ({ARRIVALS_DATED_SQL})""",
    "profile_arrivals_files": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count_if("{c}" IS NULL) AS BIGINT) AS n_null,
            {'CAST(NULL AS BIGINT)' if c in ('arr_date', 'dep_date') else f'count("{c}")'} AS n_values
            FROM ({ARRIVALS_DATED_SQL})""" for c in _DATED_COLS),
    "strict_dates": f"SELECT City, CAST(dt AS DATE) AS measure_date FROM ({TEMPERATURES_SQL})",
    "demographics_csv": DEMOG_DIM_SQL,
    "weather_csv": WEATHER_CLEAN_SQL,
    "star_load": QUALITY_SQL,
    "incremental_fact": FACT_SQL,
    "distinct_values": f"SELECT DISTINCT i94port FROM ({ARRIVALS_SQL})",
    "lookup_clean": PLACE_LOOKUP_CLEAN_SQL,
    "lookup_raw": PLACE_LOOKUP_SQL,
}
