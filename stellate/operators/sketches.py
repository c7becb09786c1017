"""Profiles that are kept per partition and merged.

A profile of a large table is gathered once per part (a month of arrivals) and
stored: counts, moments, least and greatest value, and a KLL quantile sketch of
each numeric column.  A profile of a year, or of everything, is then merged from
the stored rows; a new month costs a look at that month alone.

A merged quantile's rank is off by at most a share of ``rank_error(k)`` of the
values (with 99 percent confidence; parts with fewer than ``k`` values are exact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a sketch: about 3 x K doubles.
K = 4096


def rank_error(k: int = K) -> float:
    """Share of the values by which a quantile's rank may be off (KLL, single
    sided, 99 percent confidence)."""
    return 2.296 / k ** 0.9021


def _numeric(df: DataFrame, by: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in by]


def partition_profile(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, k: int = K) -> DataFrame:
    """(by..., column, n, n_null, mean, m2, min, max, sketch): one row a part
    and column, from one aggregate with a map-side part."""
    cols = list(columns or _numeric(df, by))
    aggs, cells = [], []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        parts = {"n": F.count(v), "n_null": F.count_if(v.isNull()), "mean": F.avg(v), "m2": F.var_pop(v) * F.count(v),
                 "min": F.min(v), "max": F.max(v), "sketch": F.kll_sketch_agg_double(v, k)}
        aggs += [a.alias(f"__{i}_{name}") for name, a in parts.items()]
        cells.append(F.struct(F.lit(c).alias("column"), *[F.col(f"__{i}_{name}").alias(name) for name in parts]))
    keys = [F.col(f"`{b}`") for b in by]
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.inline(F.array(*cells)))


def merge_profiles(parts: DataFrame, by: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75),
                   k: int = K) -> DataFrame:
    """(by..., column, n, n_null, mean, std, min, max, quantiles): the stored
    parts merged to coarser ones (``by`` empty: to one row a column)."""
    keys = [*[f"`{b}`" for b in by], "column"]
    total = F.sum("n")
    means = parts.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(total, F.lit(0))).alias("__mean"))
    same = F.lit(True)
    for b in [*by, "column"]:
        same = same & F.col(f"p.`{b}`").eqNullSafe(F.col(f"m.`{b}`"))
    # Squares about the common mean, from those about each part's own.
    near = parts.alias("p").join(means.alias("m"), same).select("p.*", "__mean")
    square = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("__mean")) ** 2)
    merged = near.groupBy(*keys).agg(
        total.alias("n"), F.sum("n_null").alias("n_null"), F.first("__mean").alias("mean"),
        F.when(total > 1, F.sqrt(square / (total - 1))).alias("std"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", k).alias("__sketch"))
    wanted = F.when(F.col("n") > 0, F.array(*[F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q))) for q in probs]))
    return merged.withColumn("quantiles", wanted).drop("__sketch")
