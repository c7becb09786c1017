"""Distinct, keyed de-duplication and duplicate reports.

All of them are aggregations with a map-side partial step, so a key that
holds a large share of the rows is reduced inside every map task before the
shuffle: no single task ever receives all rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One output task never emits more than this many copies of one duplicated row.
DUPLICATE_CHUNK_ROWS = 1 << 20


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (null equals null)."""
    return df.dropDuplicates()


def _pick_by_key(df: DataFrame, keys, order_by, pick_max: bool) -> DataFrame:
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    order = _names(order_by) if order_by is not None else rest
    # Tie-break by every other column so the survivor never depends on file
    # order or on task scheduling.
    order = order + [c for c in rest if c not in order]
    # The ordering struct holds every column, so it is the row itself.
    ordering = F.struct(*[F.col(f"`{c}`") for c in order])
    pick = F.max if pick_max else F.min
    out = (df.groupBy(*keys)
           .agg(pick(ordering).alias("__row"))
           .select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def dedupe_by_key(df: DataFrame, keys, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in ascending ``order_by`` (nulls first).

    Deterministic replacement for ``dropDuplicates(keys)``, whose survivor is
    whichever row a task happens to see first.
    """
    return _pick_by_key(df, keys, order_by, pick_max=False)


def latest_per_key(df: DataFrame, keys, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last in ascending ``order_by`` (nulls lose).

    Equivalent to "sort by key, order; keep last" without a global sort.
    """
    return _pick_by_key(df, keys, order_by, pick_max=True)


def duplicate_rows(df: DataFrame, chunk_rows: int = DUPLICATE_CHUNK_ROWS) -> DataFrame:
    """Every occurrence of a row after its first (bag difference df - distinct(df)).

    One aggregation counts each distinct row (map-side combined).  The
    surplus copies of each row are cut into chunks of ``chunk_rows``; the
    chunk rows are shuffled and each emits its copies, so a row repeated
    billions of times is generated by many tasks, not one.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    counts = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") > 1)
              .withColumn("__extra", F.col("__n") - 1))
    chunks = counts.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                        F.floor((F.col("__extra") - 1) / chunk_rows).cast("long"))))
    chunks = chunks.withColumn("__len", F.least(F.lit(chunk_rows).cast("long"),
                                                F.col("__extra") - F.col("__chunk") * chunk_rows))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__len")))
    return (chunks.repartition(*cols, F.col("__chunk"))
            .withColumn("__copy", copies).select(*cols))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(name).distinct()

