"""Star-schema table builders: source frames in, output frames out (lazy)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.columns import to_int, upper_text, visa_category
from stellate.functions.dates import calendar_columns, parse_date, sas_to_date
from stellate.operators.columns import (
    allow_null, drop_null_rows, fill_cast_long, rename, require_not_null,
)
from stellate.operators.dedupe import dedupe_by_key, distinct_rows, latest_per_key
from stellate.operators.joins import lookup_join
from stellate.operators.keys import dense_ids, unique_ids
from stellate.sources.files import read_lookup

# Demographics columns turned into 0-filled integers, the
# output names of the demographics columns, and the temperature columns a
# reading must have.  WEATHER_TIE_BREAK is our choice (date ties).
DEMOG_FLOAT_TO_INT = ("Male Population", "Female Population", "Number of Veterans",
                      "Foreign-born", "Average Household Size")
DEMOG_RENAME = {
    "Median Age": "median_age", "Male Population": "male_pop",
    "Female Population": "female_pop", "Total Population": "tot_pop",
    "Number of Veterans": "veteran_pop", "Foreign-born": "foreign_born",
    "Average Household Size": "avg_hose_size", "State Code": "state_code",
}
WEATHER_REQUIRED = ("dt", "AverageTemperature", "City", "Country")
WEATHER_TIE_BREAK = ("dt", "AverageTemperature", "AverageTemperatureUncertainty",
                     "Country", "Latitude", "Longitude")


def with_arrival_dates(arrivals: DataFrame) -> DataFrame:
    """Add ``arr_date`` and ``dep_date`` from the SAS day numbers."""
    return arrivals.withColumns({"arr_date": sas_to_date("arrdate"),
                                 "dep_date": sas_to_date("depdate")})


def build_dim_usdemog(demographics: DataFrame,
                      id_order: Sequence[str] = ("City", "state_code", "Race")) -> DataFrame:
    """One row per demographics row: five counts 0-filled to BIGINT, ``State``
    and ``Count`` dropped, renamed, ``demog_id`` 1..N in ``id_order``."""
    df = fill_cast_long(demographics, DEMOG_FLOAT_TO_INT)
    df = df.drop("State", "Count")
    df = rename(df, DEMOG_RENAME)
    return dense_ids(df, list(id_order), name="demog_id")


def build_dim_calendar(arrivals: DataFrame, null_dates: str = "raise",
                       assert_keys: bool = True) -> DataFrame:
    """One row per distinct arrival date with its calendar parts.

    The distinct runs on the single date column (map-side combined: a few
    dozen dates per task), and the calendar parts are computed on the
    distinct dates only.  ``null_dates``: ``raise`` fails the job on a
    missing arrival date (non-nullable key), ``drop`` leaves it out.
    ``assert_keys=False`` skips the non-null assertion (for quality checks
    that must see the nulls).
    """
    dates = arrivals.select(sas_to_date("arrdate").alias("arr_date"))
    if null_dates == "drop":
        dates = dates.where(F.col("arr_date").isNotNull())
    elif null_dates != "raise":
        raise ValueError("null_dates must be 'raise' or 'drop'")
    dates = dates.distinct()
    cal = dates.select("arr_date", *[c.alias(n) for n, c in calendar_columns("arr_date").items()])
    return require_not_null(cal, ["arr_date"]) if assert_keys else cal


def build_dim_weather(temperatures: DataFrame, countries: DataFrame, *,
                      strict_dates: bool = False,
                      tie_break: Sequence[str] = WEATHER_TIE_BREAK) -> DataFrame:
    """Latest complete reading per city name, with its country code.

    Country names are upper-cased, ``dt`` parsed (malformed -> null unless
    ``strict_dates``), rows missing any of dt / temperature / city / country
    dropped; the latest ``dt`` per City wins (ties: ``tie_break`` descending).
    The country code comes from the lookup by exact name, 0 when absent;
    a name with two codes gives two rows.  ``weather_id`` numbers the rows
    1..N by City, then code.
    """
    t = temperatures.withColumns({"Country": upper_text("Country"),
                                  "dt": parse_date("dt", strict=strict_dates)})
    t = drop_null_rows(t, WEATHER_REQUIRED)
    t = latest_per_key(t, ["City"], order_by=list(tie_break))
    w = lookup_join(t, countries.select("country_code", "Country"), "Country",
                    defaults={"country_code": 0}, casts={"country_code": "long"})
    w = w.withColumnRenamed("dt", "measure_date")
    return dense_ids(w, ["City", "country_code"], name="weather_id")


def immigrant_rows(arrivals_dated: DataFrame) -> DataFrame:
    return arrivals_dated.select(
        to_int("cicid").alias("cicid"),
        to_int("i94cit").alias("country_origin"),
        to_int("biryear").alias("birth_year"),
        F.col("gender").alias("gender"),
        F.col("insnum").alias("insurance_num"),
        visa_category("i94visa").alias("visa_category"),
        F.year("arr_date").alias("arr_year"),
    )


def build_dim_immigrant(arrivals_dated: DataFrame,
                        survivor_order: Sequence[str] | None = None,
                        assert_keys: bool = True) -> DataFrame:
    """One row per traveller (``cicid``).

    De-duplicates by ``cicid`` first (survivor: smallest row in
    ``survivor_order``, default all columns), then drops rows without an
    arrival year — in that order, so a traveller whose surviving record lacks
    a date is left out even if another record had one.
    """
    rows = immigrant_rows(arrivals_dated)
    dim = dedupe_by_key(rows, ["cicid"], order_by=survivor_order)
    dim = allow_null(dim, ["visa_category"])
    if assert_keys:
        dim = require_not_null(dim, ["cicid"])
    dim = dim.where(F.col("arr_year").isNotNull())
    return require_not_null(dim, ["arr_year"]) if assert_keys else dim


def fact_rows(arrivals_dated: DataFrame) -> DataFrame:
    return arrivals_dated.select(
        to_int("cicid").alias("cicid"),
        to_int("i94cit").alias("I94CIT"),
        F.col("i94port").alias("I94PORT"),
        F.col("arr_date"),
        F.month("arr_date").alias("month"),
        F.year("arr_date").alias("arr_year"),
        to_int("i94mode").alias("I94MODE"),
        F.col("i94addr").alias("I94ADDR"),
        F.col("dep_date"),
        visa_category("i94visa").alias("I94VISA"),
        F.col("matflag").alias("MATFLAG"),
        F.col("airline").alias("AIRLINE"),
        F.col("admnum").alias("ADMNUM"),
        F.col("fltno").alias("FLTNO"),
        F.col("visatype").alias("VISATYPE"),
    )


def build_fact_immigration(arrivals_dated: DataFrame, *, with_id: bool = True,
                           assert_keys: bool = True) -> DataFrame:
    """Distinct arrival facts with ``immig_id``.

    Rows without an arrival date stay (they land in the null ``arr_year``
    partition).  The monotonic id depends on partitioning: materialise the
    result before two actions read it (the load does).
    """
    fact = distinct_rows(fact_rows(arrivals_dated))
    if assert_keys:
        fact = require_not_null(fact, ["cicid"])
    fact = allow_null(fact, ["I94VISA"])
    if with_id:
        fact = unique_ids(fact, "immig_id")
    return fact


def build_lookup(spark: SparkSession, path: str, kind: str, clean: bool = True) -> DataFrame:
    """``dim_countrymapping`` / ``dim_port`` / ``dim_us_state`` from their CSVs."""
    return read_lookup(spark, path, kind, clean=clean)
