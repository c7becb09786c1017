"""Date functions: SAS day numbers, calendar parts, text dates.

The SAS conversion is a plain Catalyst expression (no Python worker), so it
stays inside whole-stage codegen and the optimiser can see through it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# SAS counts days from 1960-01-01; the valid results are the
# dates of years 1..9999, i.e. day numbers -715509 (0001-01-01) through
# 2936549 (9999-12-31).  Anything outside, NaN, null or non-integer text
# becomes null.
SAS_EPOCH = _dt.date(1960, 1, 1)
SAS_MIN_DAY = -715509
SAS_MAX_DAY = 2936549


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_to_date(c) -> Column:
    """SAS day number (double or text) -> DATE, truncating toward zero.

    ``try_cast`` gives null for NaN, overflow and malformed text and truncates
    fractional days, like Python's ``int()``.
    """
    days = _col(c).try_cast("int")
    return F.when(days.between(SAS_MIN_DAY, SAS_MAX_DAY),
                  F.date_add(F.lit(SAS_EPOCH), days))


def calendar_columns(date_col="arr_date") -> dict[str, Column]:
    """day of month, ISO week, month, year and weekday (Sunday = 1)."""
    d = _col(date_col)
    return {
        "day": F.dayofmonth(d),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
        "weekday": F.dayofweek(d),
    }


def parse_date(c, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text -> DATE.  ``strict`` raises on malformed text (ANSI); otherwise null."""
    c = _col(c)
    if strict:
        return F.to_date(c, fmt)
    return F.try_to_date(c, fmt)


# SQL functions so that selectExpr / spark.sql callers get the same logic.
# A SQL UDF body is inlined by the analyser: no Python worker is involved.
_SQL_FUNCTIONS = (
    f"""CREATE OR REPLACE TEMPORARY FUNCTION sas_date(x DOUBLE) RETURNS DATE
        RETURN CASE WHEN try_cast(x AS INT) BETWEEN {SAS_MIN_DAY} AND {SAS_MAX_DAY}
                    THEN date_add(DATE'{SAS_EPOCH.isoformat()}', try_cast(x AS INT)) END""",
)


def register_sql_functions(spark: SparkSession) -> None:
    for statement in _SQL_FUNCTIONS:
        spark.sql(statement)
