"""Projection, filter and schema operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.columns import fill_zero_long


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored (pandas ``rename``)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def insert_first(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column at position 0."""
    return df.select(value.alias(name), *[F.col(c) for c in df.columns])


def fill_cast_long(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fill missing values of ``names`` with 0 and truncate them to BIGINT."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.withColumns({
        n: fill_zero_long(F.col(f"`{n}`"), isinstance(types[n], (T.FloatType, T.DoubleType)))
        for n in names})


def keep_not_null(df: DataFrame, name: str) -> DataFrame:
    """Rows whose ``name`` is not null (pushed to the scan when possible)."""
    return df.where(F.col(name).isNotNull())


def drop_null_rows(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def _two_literals(dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return F.lit("0"), F.lit("1")
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date(1970, 1, 1)), F.lit(_dt.date(1970, 1, 2))
    if isinstance(dtype, T.BooleanType):
        return F.lit(False), F.lit(True)
    if isinstance(dtype, (T.NumericType,)):
        return F.lit(0).cast(dtype), F.lit(1).cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return (F.lit(_dt.datetime(1970, 1, 1)).cast(dtype),
                F.lit(_dt.datetime(1970, 1, 2)).cast(dtype))
    raise TypeError(f"require_not_null: unsupported type {dtype.simpleString()}")


def require_not_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Declare ``names`` non-nullable and fail any task that meets a null.

    ``coalesce(c, if(isnull(raise_error(..)), a, b))`` is non-nullable (both
    branches are literals) and cannot be folded (raise_error is not foldable),
    so the check runs inside codegen for every row that is read.  No RDD round
    trip, no optimiser barrier.
    """
    names = list(names)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    replaced = {}
    for n in names:
        a, b = _two_literals(types[n])
        guard = F.when(F.raise_error(F.lit(f"null value in non-nullable column {n}")).isNull(), a).otherwise(b)
        replaced[n] = F.coalesce(F.col(n), guard)
    return df.withColumns(replaced)


REASON = "reason"


def reject_reasons(checks: Mapping[str, Column]) -> Column:
    """The names of the failed checks of a row, in their order, joined by ``;``;
    null for a row that passes all.  A check whose condition is null has failed."""
    failed = F.concat_ws(";", *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()])
    return F.nullif(failed, F.lit(""))


def not_null_checks(names: Iterable[str]) -> dict[str, Column]:
    return {f"null {n}": F.col(f"`{n}`").isNotNull() for n in names}


def split_rejects(df: DataFrame, checks: Mapping[str, Column], path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their ``reason``): rows that fail a check
    are kept with all their columns instead of failing the job.

    ``df`` is computed once, by a write to ``path`` that parts the rows; each
    side then reads its own folder only.  Good rows keep the columns of ``df``.
    """
    names, flag = df.columns, "rejected"
    while flag in names:
        flag = "_" + flag
    reason = REASON
    while reason in names:
        reason = "_" + reason
    marked = df.withColumn(reason, reject_reasons(checks))
    marked.withColumn(flag, F.col(reason).isNotNull()).write.mode("errorifexists").partitionBy(flag).parquet(path)
    schema = T.StructType([*marked.schema.fields, T.StructField(flag, T.BooleanType())])
    both = df.sparkSession.read.schema(schema).parquet(path)
    cols = [F.col(f"`{n}`") for n in names]
    return both.where(~F.col(flag)).select(*cols), both.where(F.col(flag)).select(*cols, F.col(reason))


def allow_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Declare ``names`` nullable (values unchanged)."""
    return df.withColumns({n: F.when(F.col(n).isNotNull(), F.col(n)) for n in names})


def set_nullable(df: DataFrame, names: Iterable[str], nullable: bool = True) -> DataFrame:
    """One call for both directions: ``nullable=False`` asserts (see
    :func:`require_not_null`), ``nullable=True`` relaxes (:func:`allow_null`)."""
    return allow_null(df, names) if nullable else require_not_null(df, names)
