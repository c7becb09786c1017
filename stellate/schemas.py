"""Explicit schemas of every source and output table, plus table metadata.

Nothing in a production path infers a schema: sources are read with these
StructTypes and outputs are checked against them in the tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The column names and types below are those of the source files
# and of the output tables, and must match them.
D, S, L, I, DT = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType(), T.DateType()


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


# Arrival records (Parquet): SAS numerics arrive as doubles, codes as text.
ARRIVALS = _struct([
    ("cicid", D), ("i94yr", D), ("i94mon", D), ("i94cit", D), ("i94res", D),
    ("i94port", S), ("arrdate", D), ("i94mode", D), ("i94addr", S), ("depdate", D),
    ("i94bir", D), ("i94visa", D), ("count", D), ("dtadfile", S), ("visapost", S),
    ("occup", S), ("entdepa", S), ("entdepd", S), ("entdepu", S), ("matflag", S),
    ("biryear", D), ("dtaddto", S), ("gender", S), ("insnum", S), ("airline", S),
    ("admnum", D), ("fltno", S), ("visatype", S),
])

# City demographics (CSV, ';' separated, header).
DEMOGRAPHICS = _struct([
    ("City", S), ("State", S), ("Median Age", D), ("Male Population", D),
    ("Female Population", D), ("Total Population", L), ("Number of Veterans", D),
    ("Foreign-born", D), ("Average Household Size", D), ("State Code", S),
    ("Race", S), ("Count", L),
])

# City temperatures (CSV, ',' separated, header); dt stays text until parsed.
TEMPERATURES = _struct([
    ("dt", S), ("AverageTemperature", D), ("AverageTemperatureUncertainty", D),
    ("City", S), ("Country", S), ("Latitude", S), ("Longitude", S),
])

# Airport codes (CSV): read for completeness, nothing is derived from it.
AIRPORT_CODES = _struct([
    ("ident", S), ("type", S), ("name", S), ("elevation_ft", D), ("continent", S),
    ("iso_country", S), ("iso_region", S), ("municipality", S), ("gps_code", S),
    ("iata_code", S), ("local_code", S), ("coordinates", S),
])

# Code lookups (CSV, header).  Codes are read as text first: a typed read of
# a blank-padded number would give null.
COUNTRY_LOOKUP_RAW = _struct([("country_code", S), ("Country", S)])
PORT_LOOKUP_RAW = _struct([("port_code", S), ("port_name", S)])
STATE_LOOKUP_RAW = _struct([("state_code", S), ("state", S)])


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    partition_by: str | None = None


# The star schema as the load writes it.
FACT_IMMIGRATION = TableSpec("fact_immigration", key="immig_id", partition_by="arr_year")
DIM_IMMIGRANT = TableSpec("dim_immigrant", key="cicid", partition_by="arr_year")
DIM_WEATHER = TableSpec("dim_weather", key="weather_id")
DIM_CALENDAR = TableSpec("dim_calendar", key="arr_date", partition_by="year")
DIM_USDEMOG = TableSpec("dim_usdemog", key="demog_id")
DIM_COUNTRY = TableSpec("dim_countrymapping", key="country_code")
DIM_STATE = TableSpec("dim_us_state", key="state_code")
DIM_PORT = TableSpec("dim_port", key="port_code")

STAR_TABLES = (FACT_IMMIGRATION, DIM_IMMIGRANT, DIM_WEATHER, DIM_CALENDAR, DIM_USDEMOG)

# Output column contracts (name, type) in order.
OUTPUT_COLUMNS = {
    "dim_usdemog": [("demog_id", L), ("City", S), ("median_age", D), ("male_pop", L),
                    ("female_pop", L), ("tot_pop", L), ("veteran_pop", L),
                    ("foreign_born", L), ("avg_hose_size", L), ("state_code", S), ("Race", S)],
    "dim_calendar": [("arr_date", DT), ("day", I), ("week", I), ("month", I),
                     ("year", I), ("weekday", I)],
    "dim_weather": [("weather_id", L), ("country_code", L), ("Country", S),
                    ("measure_date", DT), ("AverageTemperature", D),
                    ("AverageTemperatureUncertainty", D), ("City", S),
                    ("Latitude", S), ("Longitude", S)],
    "dim_immigrant": [("cicid", I), ("country_origin", I), ("birth_year", I),
                      ("gender", S), ("insurance_num", S), ("visa_category", S),
                      ("arr_year", I)],
    "fact_immigration": [("cicid", I), ("I94CIT", I), ("I94PORT", S), ("arr_date", DT),
                         ("month", I), ("arr_year", I), ("I94MODE", I), ("I94ADDR", S),
                         ("dep_date", DT), ("I94VISA", S), ("MATFLAG", S), ("AIRLINE", S),
                         ("ADMNUM", D), ("FLTNO", S), ("VISATYPE", S), ("immig_id", L)],
}
