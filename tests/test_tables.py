import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate import schemas
from stellate.plans import tables as TB


def _arrivals(spark, rows):
    """rows: dicts with some arrival columns; the rest are null."""
    names = schemas.ARRIVALS.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schemas.ARRIVALS)


def _schema(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def test_dim_usdemog(spark):
    rows = [("Austin", "Texas", 31.3, 2.0e5, None, 931830, 3.5e4, 1.5e5, 2.58, "TX", "Asian", 10),
            ("Austin", "Texas", 31.3, None, 4.8e5, 931830, None, None, None, "TX", "Black", 20),
            ("Boston", "Mass", 35.0, 1.0, 2.0, 5, 3.0, 4.0, 2.99, "MA", "White", 30)]
    df = spark.createDataFrame(rows, schemas.DEMOGRAPHICS)
    out = TB.build_dim_usdemog(df)
    assert _schema(out) == schemas.OUTPUT_COLUMNS["dim_usdemog"]
    got = [r.asDict() for r in out.orderBy("demog_id").collect()]
    assert [r["demog_id"] for r in got] == [1, 2, 3]
    assert got[0]["avg_hose_size"] == 2 and got[0]["female_pop"] == 0
    assert got[1]["male_pop"] == 0 and got[1]["veteran_pop"] == 0 and got[1]["Race"] == "Black"


def test_dim_calendar(spark):
    a = _arrivals(spark, [{"arrdate": 20545.0}, {"arrdate": 20545.0}, {"arrdate": 20546.0}])
    out = TB.build_dim_calendar(a)
    assert _schema(out) == schemas.OUTPUT_COLUMNS["dim_calendar"]
    assert out.schema["arr_date"].nullable is False
    rows = sorted(tuple(r) for r in out.collect())
    assert rows[0] == (dt.date(2016, 4, 1), 1, 13, 4, 2016, 6)
    assert len(rows) == 2


def test_dim_calendar_null_date(spark):
    a = _arrivals(spark, [{"arrdate": 20545.0}, {"arrdate": None}])
    with pytest.raises(Exception, match="non-nullable"):
        TB.build_dim_calendar(a).collect()
    assert TB.build_dim_calendar(a, null_dates="drop").count() == 1


def test_dim_immigrant_dedupe_then_filter(spark):
    a = _arrivals(spark, [
        {"cicid": 7.0, "i94cit": 101.0, "biryear": 1980.0, "i94visa": 2.0, "arrdate": None},
        {"cicid": 7.0, "i94cit": 102.0, "biryear": 1980.0, "i94visa": 2.0, "arrdate": 20545.0},
        {"cicid": 8.0, "i94cit": 103.0, "biryear": 2019.0, "i94visa": 4.0, "arrdate": 20550.0,
         "gender": "F"},
        {"cicid": 8.0, "i94cit": 104.0, "biryear": 2019.0, "i94visa": 4.0, "arrdate": 20550.0},
    ])
    out = TB.build_dim_immigrant(TB.with_arrival_dates(a))
    assert _schema(out) == schemas.OUTPUT_COLUMNS["dim_immigrant"]
    rows = [r.asDict() for r in out.collect()]
    # cicid 7: survivor is the smallest row (country 101) whose date is null -> dropped
    assert [r["cicid"] for r in rows] == [8]
    assert rows[0]["country_origin"] == 103 and rows[0]["visa_category"] == "other"
    assert rows[0]["birth_year"] == 2019  # impossible values are kept
    assert out.schema["cicid"].nullable is False and out.schema["arr_year"].nullable is False


def test_fact_immigration(spark):
    base = {"cicid": 6.0, "i94cit": 101.0, "i94port": "NYC", "arrdate": 20545.0,
            "i94visa": 1.0, "admnum": 5.5e10}
    a = _arrivals(spark, [base, dict(base), {**base, "arrdate": None},
                          {**base, "cicid": 1e12}])
    out = TB.build_fact_immigration(TB.with_arrival_dates(a))
    assert _schema(out) == schemas.OUTPUT_COLUMNS["fact_immigration"]
    with pytest.raises(Exception, match="non-nullable column cicid"):
        out.collect()  # cicid 1e12 does not fit INT -> null -> the assertion fires
    a2 = _arrivals(spark, [base, dict(base), {**base, "arrdate": None}])
    rows = TB.build_fact_immigration(TB.with_arrival_dates(a2)).collect()
    assert len(rows) == 2  # duplicate collapsed; null arrival date kept
    assert len({r.immig_id for r in rows}) == 2 and min(r.immig_id for r in rows) >= 1
    assert {r.arr_year for r in rows} == {2016, None}
    assert {r.I94VISA for r in rows} == {"Business"}


def test_dim_weather(spark):
    temps = spark.createDataFrame([
        ("2013-01-01", 1.0, 0.1, "Cordoba", "argentina", "31.35S", "64.08W"),
        ("2013-02-01", 2.0, 0.1, "Cordoba", "argentina", "31.35S", "64.08W"),
        ("2013-03-01", None, None, "Cordoba", "argentina", "31.35S", "64.08W"),  # no temp
        ("2013-02-01", 5.0, None, "Paris", "France", "48.8N", "2.3E"),
        ("2013-02-01", 6.0, None, "Paris", "France", "48.8N", "2.3E"),  # tie on date
        ("2013-01-01", 9.0, None, "Paris", "Texas", "33.6N", "95.5W"),
        ("bad-date", 9.0, None, "Nowhere", "Atlantis", "0N", "0E"),
        ("2013-01-05", 3.0, None, "Oslo", "Norway", "59N", "10E"),
    ], schemas.TEMPERATURES)
    countries = spark.createDataFrame(
        [(687, "ARGENTINA "), (101, "FRANCE"), (102, "FRANCE"), (103, "NORWAY")],
        "country_code int, Country string")
    out = TB.build_dim_weather(temps, countries)
    assert _schema(out) == schemas.OUTPUT_COLUMNS["dim_weather"]
    rows = [r.asDict() for r in out.orderBy("weather_id").collect()]
    assert [r["weather_id"] for r in rows] == [1, 2, 3, 4]
    cordoba = rows[0]
    assert cordoba["City"] == "Cordoba" and cordoba["measure_date"] == dt.date(2013, 2, 1)
    assert cordoba["country_code"] == 0  # padded label never matches without cleaning
    assert cordoba["AverageTemperatureUncertainty"] == 0.1
    assert [(r["City"], r["country_code"]) for r in rows[2:]] == [("Paris", 101), ("Paris", 102)]
    assert rows[2]["AverageTemperature"] == 6.0  # date tie: larger reading wins
    assert rows[1]["City"] == "Oslo" and rows[1]["country_code"] == 103
    cleaned = countries.withColumn("Country", F.trim("Country"))
    again = TB.build_dim_weather(temps, cleaned).where("City = 'Cordoba'").collect()
    assert again[0]["country_code"] == 687
