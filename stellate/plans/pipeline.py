"""End-to-end load (extract -> star schema -> write -> checks) and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stellate import schemas
from stellate.operators.dedupe import duplicate_rows
from stellate.operators.profile import describe, null_counts, null_counts_long, summary
from stellate.operators.columns import not_null_checks, split_rejects
from stellate.operators.quality import check_rows, enforce, observed
from stellate.plans import tables as TB
from stellate.session import remove_path, scratch_path, scratch_scope
from stellate.sinks import snapshots
from stellate.sinks.files import write_csv, write_parquet
from stellate.sources import driver_tables
from stellate.sources.files import (
    demographics_broken, demographics_rejects, read_arrivals, read_demographics, read_lookup,
    read_temperatures, temperatures_broken, temperatures_rejects,
)


@dataclass
class LoadSources:
    arrivals: DataFrame
    demographics: DataFrame
    temperatures: DataFrame
    countries: DataFrame
    states: DataFrame | None = None
    ports: DataFrame | None = None
    # {file: (column, n_rows, n_bad)}: malformed values, for the report.
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    # {file: (defect, n_rows, n_bad)}: records with too few or too many fields.
    broken: dict[str, DataFrame] = field(default_factory=dict)


def sources_from_files(spark: SparkSession, input_dir: str, *,
                       temperatures_path: str | None = None,
                       clean_lookups: bool = True, strict: bool = False) -> LoadSources:
    """The file layout of the original load: ``sas_data/`` (Parquet), the
    demographics and temperature CSVs and three lookup CSVs.  The footers of
    the arrivals files must hold the declared columns.  ``strict`` fails on a
    malformed number and on a record with too few or too many fields; otherwise
    both are counted in the quality report."""
    base = input_dir.rstrip("/")
    demographics_path = f"{base}/us-cities-demographics.csv"
    temperatures_path = temperatures_path or f"{base}/GlobalLandTemperaturesByCity.csv"
    broken = "raise" if strict else "drop"
    return LoadSources(
        arrivals=read_arrivals(spark, f"{base}/sas_data", check=True),
        demographics=read_demographics(spark, demographics_path, malformed="raise" if strict else "drop",
                                       broken=broken),
        temperatures=read_temperatures(spark, temperatures_path, malformed="raise" if strict else "null",
                                       broken=broken),
        broken={"demographics": demographics_broken(spark, demographics_path),
                "temperatures": temperatures_broken(spark, temperatures_path)},
        rejects={"demographics": demographics_rejects(spark, demographics_path),
                 "temperatures": temperatures_rejects(spark, temperatures_path)},
        countries=read_lookup(spark, f"{base}/country_mapping.csv", "country", clean=clean_lookups),
        states=read_lookup(spark, f"{base}/state_code_dim.csv", "state", clean=clean_lookups),
        ports=read_lookup(spark, f"{base}/port_code.csv", "port", clean=clean_lookups),
    )


def sources_from_driver_tables(spark: SparkSession, sf_dir: str) -> LoadSources:
    return LoadSources(
        arrivals=driver_tables.arrivals(spark, sf_dir),
        demographics=driver_tables.demographics(spark, sf_dir),
        temperatures=driver_tables.temperatures(spark, sf_dir),
        countries=driver_tables.country_lookup(spark, sf_dir),
    )


def build_star(src: LoadSources, *, calendar_null_dates: str = "raise", strict_dates: bool = False,
               assert_keys: bool = True) -> dict:
    """``{name: (builder, TableSpec)}`` for the five star tables; a builder
    gives the table's DataFrame.

    DataFrames are lazy except for the dense ids (weather, demographics), which
    materialise their small inputs once when they are built.
    """
    dated = TB.with_arrival_dates(src.arrivals)
    return {
        "fact_immigration": (lambda: TB.build_fact_immigration(dated, assert_keys=assert_keys),
                             schemas.FACT_IMMIGRATION),
        "dim_immigrant": (lambda: TB.build_dim_immigrant(dated, assert_keys=assert_keys), schemas.DIM_IMMIGRANT),
        "dim_weather": (lambda: TB.build_dim_weather(src.temperatures, src.countries, strict_dates=strict_dates),
                        schemas.DIM_WEATHER),
        "dim_calendar": (lambda: TB.build_dim_calendar(src.arrivals, null_dates=calendar_null_dates,
                                                       assert_keys=assert_keys), schemas.DIM_CALENDAR),
        "dim_usdemog": (lambda: TB.build_dim_usdemog(src.demographics), schemas.DIM_USDEMOG),
    }


REPORT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("check", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_bad", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])


def _reject_rows(src: LoadSources) -> list[dict]:
    """Report rows for malformed values and broken records: one per column or
    defect that has any."""
    rows = []
    for kind, frames in (("column", src.rejects), ("defect", src.broken)):
        for name, frame in frames.items():
            for r in frame.where("n_bad > 0").collect():  # at most one row per column or defect
                told = (f"{name}.{r['column']}", "malformed") if kind == "column" else (name, r["defect"])
                rows.append({"table": told[0], "check": told[1], "n_rows": r["n_rows"], "n_bad": r["n_bad"],
                             "passed": False})
    return rows


def _frames(spark: SparkSession, src: LoadSources, star: dict, specs: dict, quarantine: bool, write_lookups: bool):
    """(name, frame, key, partition column) of all tables to write."""
    jobs = []
    for name, spec in specs.items():
        df = star[name][0]()
        if quarantine:
            df, bad = split_rejects(df, not_null_checks([spec.key]), scratch_path(spark, f"split-{name}"))
            jobs.append((f"quarantine_{name}", bad, None, None))
        jobs.append((name, df, spec.key, spec.partition_by))
    if write_lookups:
        jobs += [(name, df, None, None) for name, df in ((schemas.DIM_COUNTRY.name, src.countries),
                                                         (schemas.DIM_STATE.name, src.states),
                                                         (schemas.DIM_PORT.name, src.ports)) if df is not None]
    return jobs


def write_checked(spark: SparkSession, out: str, run: str, jobs, *, null_key_threshold: int = 0,
                  parallel_writes: int = 4) -> tuple[dict[str, snapshots.Table], list[dict]]:
    """Write the tables of a run as concurrent jobs, and check them by what was
    counted while they were written: (tables, report rows)."""
    def write(job):
        name, df, key, part = job
        seen = None
        if key:
            df, seen = observed(name, df, key)
        table = snapshots.write_table(df, out, run, name, partition_by=part)
        found = seen.get if seen else None
        return name, table, found and check_rows(name, found["n_rows"], found["n_null"],
                                                 null_key_threshold=null_key_threshold)

    # The writes are independent Spark jobs: submit them together so the
    # scheduler overlaps small dimensions with the big fact table.
    with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
        done = list(pool.map(write, jobs))
    return {name: table for name, table, _ in done}, [r for _, _, rows in done for r in rows or []]


def run_load(spark: SparkSession, src: LoadSources, output_dir: str, *,
             on_fail: str = "report", null_key_threshold: int = 0,
             calendar_null_dates: str = "raise", write_lookups: bool = True,
             parallel_writes: int = 4, strict_dates: bool = False,
             tables: Sequence[str] | None = None, quarantine: bool = False, keep: int = 2) -> DataFrame:
    """Build, write, check and publish the star schema.

    Each table is computed exactly once, by its write below
    ``<output_dir>/_data`` (ids are therefore fixed by the files); up to
    ``parallel_writes`` writes run as concurrent jobs.  Row counts and null-key
    counts are observed during the writes, so the checks read nothing.  A null
    key is a row like any other until the check counts it; with ``quarantine``
    such rows go to the table ``quarantine_<name>`` with their reason instead.
    The report (two rows per table, one per column with malformed input and per
    defect of broken records) is written to ``<output_dir>/_quality_report``,
    kept in the commit and returned.  ``on_fail='raise'`` raises
    QualityCheckError before anything is published: readers stay with the last
    load.  With ``on_fail='report'`` the tables are published whatever the
    checks say.

    Publishing is one commit file (``sinks.snapshots``): read the tables with
    ``read_table(spark, output_dir, name)``.  Tables that this load leaves out
    are published again as they were.  The last ``keep`` commits stay readable.

    ``calendar_null_dates``: ``raise`` keeps a missing arrival date in the
    calendar, where the null-key check finds it; ``drop`` leaves it out.
    ``tables`` loads only some of the star tables.
    """
    if on_fail not in ("report", "raise"):
        raise ValueError(f"on_fail must be 'report' or 'raise', not {on_fail!r}")
    out, run = output_dir.rstrip("/"), snapshots.new_run()
    base, published = snapshots.current(spark, out), False
    star = build_star(src, calendar_null_dates=calendar_null_dates, strict_dates=strict_dates, assert_keys=False)
    specs = {name: spec for name, (_, spec) in star.items() if tables is None or name in tables}
    try:
        # Intermediates (range-partitioned copies behind the dense ids) are
        # removed once every table is written.
        with scratch_scope(spark):
            written, rows = write_checked(spark, out, run, _frames(spark, src, star, specs, quarantine, write_lookups),
                                          null_key_threshold=null_key_threshold, parallel_writes=parallel_writes)
        rows += _reject_rows(src)
        report = spark.createDataFrame([tuple(r[f] for f in REPORT_SCHEMA.fieldNames()) for r in rows], REPORT_SCHEMA)
        write_parquet(report.coalesce(1), f"{out}/_quality_report")
        if on_fail == "raise":
            enforce(report, "raise")
        snapshots.commit(spark, out, written, base, {"report": rows})
        published = True
    finally:
        if not published:
            remove_path(spark, snapshots.run_folder(out, run))
    snapshots.expire(spark, out, keep)
    return report


def profile_arrivals(arrivals: DataFrame, output_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Null counts (one row, one column per input column incl. the two derived
    dates) and the column summary; optionally written as CSV files."""
    dated = TB.with_arrival_dates(arrivals)
    nulls, summ = null_counts(dated), summary(arrivals)
    if output_dir:
        write_csv(nulls, f"{output_dir.rstrip('/')}/arrivals_null_profile", single_file=True)
        write_csv(summ, f"{output_dir.rstrip('/')}/arrivals_summary", single_file=True)
    return nulls, summ


def profile_source(df: DataFrame) -> dict[str, DataFrame]:
    """Null counts per column, duplicate rows and the exact numeric description."""
    return {"nulls": null_counts_long(df), "duplicates": duplicate_rows(df),
            "describe": describe(df)}
