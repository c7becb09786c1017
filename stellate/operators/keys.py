"""Surrogate keys and materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def materialize(df: DataFrame, label: str = "materialized") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: the lineage is cut and the rows are fixed.

    Needed wherever two actions must see the very same rows (ids that depend
    on partitioning); a lost executor re-reads the files instead of
    recomputing a different answer.  The plan runs once (an eager RDD
    checkpoint would run it twice) and the copy is columnar and compressed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def unique_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a unique BIGINT id, no shuffle.

    ``monotonically_increasing_id() + 1``: unique, increasing per partition,
    gapped; depends on partitioning, so materialise the result before more
    than one action reads it.
    """
    return df.withColumn(name, F.monotonically_increasing_id() + 1)


def _numbered(stored: DataFrame, pos: str, columns: Sequence[str], name: str, start: int,
              first: bool = True) -> DataFrame:
    """Dense ids from (partition, position) numbers fixed by files: an id is
    the number of rows in earlier partitions plus the row's position."""
    # One row per partition (a table bounded by their number, not by the data):
    # rows before it = running sum of the partition sizes.
    part = F.shiftright(F.col(pos), _ROW_BITS)
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (stored.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
               .select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    joined = stored.join(F.broadcast(offsets), part == F.col("__p"))
    ident = (F.col("__off") + F.col(pos).bitwiseAND((1 << _ROW_BITS) - 1) + start).alias(name)
    cols = [F.col(f"`{c}`") for c in columns]
    return joined.select(ident, *cols) if first else joined.select(*cols, ident)


def number_rows(df: DataFrame, name: str = "id", start: int = 1) -> DataFrame:
    """Add ids ``start``, ``start + 1``, ... in any order, without a shuffle:
    positions are fixed by writing the rows once."""
    pos = "__number_pos"
    stored = materialize(df.withColumn(pos, F.monotonically_increasing_id()), "numbered")
    return _numbered(stored, pos, df.columns, name, start, first=False)


def dense_ids(df: DataFrame, order_by: Sequence[str], name: str = "id",
              num_partitions: int | None = None, first: bool = True) -> DataFrame:
    """Add ids 1..N following ``order_by`` (ties broken by the other columns).

    Distributed: range-partition and sort within partitions; each row's
    (partition, position) is taken right after the sort and the result is
    materialised.  A running sum over the per-partition row counts (one row
    per partition) gives each partition's offset, broadcast back to the rows;
    a row's id is its partition's offset plus its position.  Nothing passes
    through the driver and no window spans the data.
    """
    spark = df.sparkSession
    order = list(order_by) + [c for c in df.columns if c not in order_by]
    # The last tie-break is a per-row tag: it only orders rows that are equal
    # in every column (so results do not depend on it), but it lets the range
    # partitioner split a row repeated a billion times over many partitions.
    # It is fixed by files before the rows are ranged: a task that is run
    # again after a loss sees the same tags.
    tag, pos = "__dense_tag", "__dense_pos"
    order_cols = [F.col(f"`{c}`") for c in order] + [F.col(tag)]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = materialize(df.withColumn(tag, F.monotonically_increasing_id()), "dense_tags")
    ranged = (tagged
              .repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn(pos, F.monotonically_increasing_id()))
    stored = materialize(ranged.drop(tag), "dense_ids")
    return _numbered(stored, pos, df.columns, name, 1, first)
