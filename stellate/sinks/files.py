"""Parquet and CSV sinks.  Any Hadoop path works (local, HDFS, s3a://...)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: str | None = None, rebalance: bool = False, touched_only: bool = False) -> None:
    """Write Parquet, optionally hive-partitioned by one column.

    Without ``rebalance`` every task writes its rows straight out (one file
    per partition value present in the task): no extra shuffle, which is
    right when values are few per task (a month of arrivals is one year).
    ``rebalance=True`` first shuffles by the partition value (REBALANCE hint)
    so each value is written by few tasks — fewer, larger files when many
    values are spread over many tasks — and AQE splits a value holding a
    large share of the rows over several writers.  A null partition value
    lands in ``<col>=__HIVE_DEFAULT_PARTITION__``.  ``mode='errorifexists'``
    refuses to replace existing data.  ``touched_only`` with ``overwrite``
    replaces just the partitions that ``df`` has rows in; the files of all
    others stay.
    """
    if touched_only and not (partition_by and mode == "overwrite"):
        raise ValueError("touched_only needs partition_by and mode='overwrite'")
    out = df.hint("rebalance", partition_by) if (partition_by and rebalance) else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    w.parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite",
              header: bool = True, sep: str = ",", single_file: bool = False) -> None:
    """Write delimited text.  ``single_file`` is for small results (profiles,
    reports): it coalesces to one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).option("sep", sep).csv(path)
