"""Adapters: source-shaped tables derived from the TPC-H style driver tables.

The real arrival, temperature and demographics files are not shipped, so the
test and benchmark queries build frames with the same schemas (see
``stellate.schemas``) out of ``lineitem``, ``orders``, ``customer``,
``nation``, ``region`` and ``part``.  Every row of those tables is used: the
frames grow with the scale factor.  The same derivations are written in SQL
in ``stellate.plans.catalog`` for the DuckDB oracle.

Shapes:

* arrivals: one record per line item; the traveller record (``cicid``) is the
  order, so a ``cicid`` repeats once per line item and fact rows repeat too.
  Some arrival dates are missing (status P with priority 5-LOW), departures
  are missing for open orders.
* temperatures: one reading per order; city = customer name, country =
  lower-case nation name, some readings without a temperature.
* country lookup: nations (code = key + 100; region 4 labels carry a stray
  " ;" as in the hand-made lookup files) plus one extra code per region that
  repeats a nation label (a label with two codes).
* demographics: one row per part.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate import schemas

_SAS_EPOCH = _dt.date(1960, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _big_side(df: DataFrame) -> DataFrame:
    """orders and customer grow with the scale factor: join them by shuffle
    (sort-merge, spills, AQE splits skewed keys) — the plan a large input
    needs — instead of letting tiny test files pick a broadcast."""
    return df.hint("merge")


def _null(t: str = "string"):
    return F.lit(None).cast(t)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # Orders meet their customers first, so the largest table is shuffled once.
    oc = o.join(_big_side(c), F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(_big_side(oc), F.col("l_orderkey") == F.col("o_orderkey"))
    col = F.col
    days = F.datediff(F.to_date(col("o_orderdate")), F.lit(_SAS_EPOCH))
    status, prio = col("o_orderstatus"), col("o_orderpriority")
    is_open = status == "O"
    out = [
        col("l_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        (col("c_nationkey") + 100).cast("double").alias("i94cit"),
        (col("c_nationkey") + 100).cast("double").alias("i94res"),
        F.substring("c_mktsegment", 1, 3).alias("i94port"),
        F.when((status == "P") & (prio == "5-LOW"), _null("double"))
         .otherwise(days.cast("double")).alias("arrdate"),
        F.when(prio == "4-NOT SPECIFIED", _null("double"))
         .otherwise((col("o_custkey") % 3 + 1).cast("double")).alias("i94mode"),
        F.when(is_open, _null()).otherwise(
            F.concat(F.lit("S"), col("c_nationkey").cast("string"))).alias("i94addr"),
        F.when(is_open, _null("double"))
         .otherwise((days + col("o_orderkey") % 30).cast("double")).alias("depdate"),
        col("l_quantity").alias("i94bir"),
        F.substring(prio, 1, 1).cast("double").alias("i94visa"),
        F.lit(1.0).alias("count"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dtadfile"),
        F.when(col("l_returnflag") == "N", _null())
         .otherwise(F.substring("c_mktsegment", 1, 3)).alias("visapost"),
        _null().alias("occup"),
        status.alias("entdepa"),
        F.when(is_open, _null()).otherwise(F.lit("O")).alias("entdepd"),
        _null().alias("entdepu"),
        F.when(is_open, _null()).otherwise(F.lit("M")).alias("matflag"),
        (F.lit(2016.0) - col("l_quantity")).alias("biryear"),
        F.date_format("l_shipdate", "MMddyyyy").alias("dtaddto"),
        F.when(col("l_returnflag") == "R", F.lit("F"))
         .when(col("l_returnflag") == "A", F.lit("M")).alias("gender"),
        F.when(col("l_linestatus") == "O", _null())
         .otherwise(col("l_partkey").cast("string")).alias("insnum"),
        F.substring(prio, 3, 2).alias("airline"),
        col("o_custkey").cast("double").alias("admnum"),
        (col("o_custkey") % 997).cast("string").alias("fltno"),
        F.when(status == "F", F.lit("B1")).when(status == "O", F.lit("B2"))
         .otherwise(F.lit("WT")).alias("visatype"),
    ]
    df = j.select(*out)
    assert df.columns == schemas.ARRIVALS.fieldNames()
    return df


def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # nation has 25 rows at every scale factor: a broadcast of fixed size.
    j = (o.join(_big_side(c), F.col("o_custkey") == F.col("c_custkey"))
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    col = F.col
    out = [
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when((col("o_orderstatus") == "P") & (col("o_orderpriority") == "1-URGENT"),
               _null("double")).otherwise(col("o_totalprice") / F.lit(1000.0)).alias("AverageTemperature"),
        F.when(col("o_orderpriority") == "5-LOW", _null("double"))
         .otherwise(col("c_acctbal") / F.lit(1000.0)).alias("AverageTemperatureUncertainty"),
        col("c_name").alias("City"),
        F.lower("n_name").alias("Country"),
        F.concat((col("c_nationkey") * 2).cast("string"), F.lit(".05N")).alias("Latitude"),
        F.concat((col("n_regionkey") * 10).cast("string"), F.lit(".00E")).alias("Longitude"),
    ]
    df = j.select(*out)
    assert df.columns == schemas.TEMPERATURES.fieldNames()
    return df


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nations = n.select(
        (F.col("n_nationkey") + 100).alias("country_code"),
        F.when(F.col("n_regionkey") == 4, F.concat("n_name", F.lit(" ;")))
         .otherwise(F.col("n_name")).alias("Country"))
    extra = r.select(
        (F.col("r_regionkey") + 900).alias("country_code"),
        F.concat(F.lit("NATION_"), F.col("r_regionkey").cast("string")).alias("Country"))
    return nations.unionByName(extra)


def place_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup that grows with the tables, with the defects of the country
    lookup: customers as places, some labels with a stray " ;", some with a
    second code."""
    c = table(spark, sf_dir, "customer")
    label = F.when(F.col("c_nationkey") % 5 == 4, F.concat("c_name", F.lit(" ;"))).otherwise(F.col("c_name"))
    code = F.col("c_custkey").cast("int")
    return c.select(code.alias("country_code"), label.alias("Country")).unionByName(
        c.where(F.col("c_custkey") % 10 == 0).select((code + 10_000_000).alias("country_code"),
                                                     F.col("c_name").alias("Country")))


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    col = F.col
    price, size = col("p_retailprice"), col("p_size")
    out = [
        col("p_name").alias("City"),
        col("p_type").alias("State"),
        size.cast("double").alias("Median Age"),
        F.when(size > 45, _null("double")).otherwise(price * F.lit(3.0)).alias("Male Population"),
        (price * F.lit(3.5)).alias("Female Population"),
        col("p_partkey").cast("long").alias("Total Population"),
        F.when(size < 5, _null("double")).otherwise(size * F.lit(10.5)).alias("Number of Veterans"),
        (price / F.lit(3.0)).alias("Foreign-born"),
        (price / F.lit(400.0)).alias("Average Household Size"),
        col("p_brand").alias("State Code"),
        col("p_type").alias("Race"),
        (col("p_partkey") * 2).cast("long").alias("Count"),
    ]
    df = p.select(*out)
    assert df.columns == schemas.DEMOGRAPHICS.fieldNames()
    return df
