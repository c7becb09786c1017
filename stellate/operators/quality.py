"""Data-quality checks as a report DataFrame.

Each table is scanned once: one global aggregate computes the row count and
the null-key count together (only the key column is read, and Parquet prunes
the rest).  The report has one row per (table, check):

    table string, check string, n_rows bigint, n_bad bigint, passed boolean

Run the null-key check on a table whose key is not under a non-null
assertion (``require_not_null``) — or on the written files, as the load
does.  An asserted key is proven non-null by the optimizer, so the count is
folded to 0 and the assertion itself is never evaluated by the check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

CHECK_NOT_EMPTY = "not_empty"
CHECK_NULL_KEY = "null_key"


class QualityCheckError(RuntimeError):
    pass


def table_checks(name: str, df: DataFrame, key: str, *, min_rows: int = 1,
                 null_key_threshold: int = 0) -> DataFrame:
    """Two report rows for one table (one aggregate)."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col(f"`{key}`").isNull()).alias("n_null"))
    checks = F.array(
        F.struct(F.lit(CHECK_NOT_EMPTY).alias("check"),
                 F.when(F.col("n_rows") < min_rows, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_bad"),
                 (F.col("n_rows") >= min_rows).alias("passed")),
        F.struct(F.lit(CHECK_NULL_KEY).alias("check"),
                 F.col("n_null").alias("n_bad"),
                 (F.col("n_null") <= null_key_threshold).alias("passed")),
    )
    return agg.select(F.lit(name).alias("table"), "n_rows", F.inline(checks)).select(
        "table", "check", "n_rows", "n_bad", "passed")


def observed(name: str, df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and null keys while it is written: the checks
    cost no job of their own.  The counts are those of the tasks that wrote."""
    seen = Observation(f"checks-{name}")
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(F.col(f"`{key}`").isNull()).alias("n_null")), seen


def check_rows(name: str, n_rows: int, n_null: int, *, min_rows: int = 1, null_key_threshold: int = 0) -> list[dict]:
    """The two report rows of a table from its counts."""
    return [{"table": name, "check": CHECK_NOT_EMPTY, "n_rows": n_rows, "n_bad": int(n_rows < min_rows),
             "passed": n_rows >= min_rows},
            {"table": name, "check": CHECK_NULL_KEY, "n_rows": n_rows, "n_bad": n_null,
             "passed": n_null <= null_key_threshold}]


def quality_report(tables: Mapping[str, tuple[DataFrame, str]], *, min_rows: int = 1,
                   null_key_threshold: int = 0) -> DataFrame:
    """Report over several tables: ``{name: (df, key)}``.

    ``null_key_threshold`` is the number of null keys tolerated (0 = none).
    """
    parts = [table_checks(name, df, key, min_rows=min_rows,
                          null_key_threshold=null_key_threshold)
             for name, (df, key) in tables.items()]
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


def enforce(report: DataFrame, on_fail: str = "report") -> list[dict]:
    """Collect the (small: two rows per table) report and act on failures.

    ``report`` returns the rows, ``raise`` raises QualityCheckError naming the
    failed checks.
    """
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed and on_fail == "raise":
        names = ", ".join(f"{r['table']}:{r['check']}({r['n_bad']})" for r in failed)
        raise QualityCheckError(f"quality checks failed: {names}")
    if on_fail not in ("report", "raise"):
        raise ValueError(f"on_fail must be 'report' or 'raise', not {on_fail!r}")
    return rows
