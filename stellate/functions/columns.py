"""Value-level column functions: casts, coded labels, fills."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Visa category codes of the arrivals code book.
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}
VISA_OTHER = "other"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """Numeric or text -> INT, truncating toward zero; null instead of an error
    for NaN, overflow or malformed text (Spark 4 ANSI casts would abort)."""
    return _col(c).try_cast("int")


def code_label(c, mapping: Mapping, default: str | None = None) -> Column:
    """Map an integer code to a label; unknown and null codes get ``default``.

    Built as one CASE expression so it folds and codegens with the plan.
    """
    code = to_int(c)
    expr = None
    for key, label in mapping.items():
        expr = (F.when(code == F.lit(key), F.lit(label)) if expr is None
                else expr.when(code == F.lit(key), F.lit(label)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def visa_category(c) -> Column:
    return code_label(c, VISA_CATEGORIES, VISA_OTHER)


def upper_text(c) -> Column:
    return F.upper(_col(c))


def fill_zero_long(c, floating: bool = True) -> Column:
    """Missing value -> 0, then truncate toward zero to BIGINT.

    For floating input both null and NaN count as missing; a value out of the
    BIGINT range becomes null instead of failing the job.
    """
    c = _col(c)
    if floating:
        return F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0)).try_cast("long")
    return F.coalesce(c.try_cast("long"), F.lit(0).cast("long"))
