import os

import pytest
from pyspark.sql import functions as F

from stellate import schemas
from stellate.operators.quality import QualityCheckError
from stellate.plans.pipeline import (
    profile_arrivals, profile_source, run_load, sources_from_driver_tables,
)
from stellate.sinks.snapshots import CommitConflict, commit, current, expire, read_table
from stellate.sources import driver_tables

from conftest import SMOKE_DIR


def test_end_to_end_load(spark, tmp_dir):
    out = os.path.join(tmp_dir, "star")
    report = run_load(spark, sources_from_driver_tables(spark, SMOKE_DIR), out,
                      calendar_null_dates="drop")
    rows = report.collect()
    assert len(rows) == 10 and all(r.passed for r in rows)
    for spec in schemas.STAR_TABLES:
        back = read_table(spark, out, spec.name)
        assert back.count() > 0
        if spec.partition_by:
            assert all(p.startswith(spec.partition_by + "=") for p in current(spark, out).tables[spec.name].roots[0][1])
    fact = read_table(spark, out, "fact_immigration")
    assert fact.select("immig_id").distinct().count() == fact.count()
    assert "arr_year=__HIVE_DEFAULT_PARTITION__" in current(spark, out).tables["fact_immigration"].roots[0][1]
    # partition pruning on the written layout
    plan = fact.where(F.col("arr_year") == 1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arr_year" in plan
    assert spark.read.parquet(f"{out}/_quality_report").count() == 10
    assert read_table(spark, out, "dim_countrymapping").count() == 30


def test_profiles(spark, tmp_dir):
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    nulls, summ = profile_arrivals(arrivals, tmp_dir)
    assert len(nulls.columns) == 30
    n = arrivals.count()
    counts = summ.where("summary = 'count'").collect()[0].asDict()
    wide = nulls.collect()[0].asDict()
    assert all(int(counts[c]) + wide[c] == n for c in arrivals.columns)
    prof = profile_source(driver_tables.demographics(spark, SMOKE_DIR))
    assert prof["duplicates"].count() == 0
    assert prof["describe"].count() == 8


def test_null_keys_are_reported_not_fatal(spark, tmp_dir):
    src = sources_from_driver_tables(spark, SMOKE_DIR)
    src.arrivals = src.arrivals.withColumn("cicid", F.when(F.col("cicid") % 5 != 0, F.col("cicid")))
    out = os.path.join(tmp_dir, "star")
    rows = {(r["table"], r["check"]): r for r in run_load(spark, src, out).collect()}
    assert not rows["dim_immigrant", "null_key"].passed and rows["dim_immigrant", "null_key"].n_bad == 1
    assert not rows["dim_calendar", "null_key"].passed  # undated arrivals
    assert spark.read.parquet(f"{out}/_quality_report").where("NOT passed").count() == 2
    assert read_table(spark, out, "fact_immigration").count() > 0


def test_a_failed_check_leaves_the_old_tables(spark, tmp_dir):
    out = os.path.join(tmp_dir, "star")
    good = sources_from_driver_tables(spark, SMOKE_DIR)
    run_load(spark, good, out, calendar_null_dates="drop", on_fail="raise", tables=["dim_usdemog", "dim_weather"])
    before = read_table(spark, out, "dim_usdemog").count()
    bad = sources_from_driver_tables(spark, SMOKE_DIR)
    bad.demographics = bad.demographics.limit(0)
    with pytest.raises(QualityCheckError):
        run_load(spark, bad, out, on_fail="raise", tables=["dim_usdemog"])
    assert read_table(spark, out, "dim_usdemog").count() == before > 0
    assert spark.read.parquet(f"{out}/_quality_report").where("NOT passed").count() == 1
    assert len(os.listdir(f"{out}/_data")) == 1  # nothing left of the failed load
    run_load(spark, bad, out, tables=["dim_usdemog"])  # report mode publishes
    assert read_table(spark, out, "dim_usdemog").count() == 0


def test_a_load_that_stops_between_tables_is_not_seen(spark, tmp_dir, monkeypatch):
    """The old load stays whole, whichever table the new one stops at."""
    from stellate.plans import pipeline
    from stellate.sinks import snapshots

    out = os.path.join(tmp_dir, "star")
    src = sources_from_driver_tables(spark, SMOKE_DIR)
    names = ["dim_usdemog", "dim_weather", "dim_calendar"]
    run_load(spark, src, out, calendar_null_dates="drop", tables=names, write_lookups=False)
    before = {n: read_table(spark, out, n).count() for n in names}
    write, done = snapshots.write_table, []

    def stop_at_the_second(df, out_, run, name, **k):
        if len(done) == 1:
            raise OSError("the driver is gone")
        done.append(name)
        return write(df, out_, run, name, **k)

    less = sources_from_driver_tables(spark, SMOKE_DIR)
    less.demographics, less.arrivals = less.demographics.limit(3), less.arrivals.limit(3)
    monkeypatch.setattr(pipeline.snapshots, "write_table", stop_at_the_second)
    with pytest.raises(OSError):
        run_load(spark, less, out, calendar_null_dates="drop", tables=names, write_lookups=False, parallel_writes=1)
    monkeypatch.undo()
    assert {n: read_table(spark, out, n).count() for n in names} == before
    # A commit file that was cut off is passed over.
    with open(f"{out}/_commits/{9:020d}.json", "w") as f:
        f.write('{"tables": {')
    assert {n: read_table(spark, out, n).count() for n in names} == before
    run_load(spark, less, out, calendar_null_dates="drop", tables=["dim_usdemog"], write_lookups=False)
    assert read_table(spark, out, "dim_usdemog").count() == 3
    assert read_table(spark, out, "dim_weather").count() == before["dim_weather"]  # published again as it was


def test_of_two_loads_at_once_the_second_fails(spark, tmp_dir):
    out = os.path.join(tmp_dir, "star")
    base = current(spark, out)
    commit(spark, out, {}, base)
    with pytest.raises(CommitConflict):
        commit(spark, out, {}, base)


def test_expired_runs_are_removed(spark, tmp_dir):
    out = os.path.join(tmp_dir, "star")
    src = sources_from_driver_tables(spark, SMOKE_DIR)
    for _ in range(3):
        run_load(spark, src, out, tables=["dim_usdemog"], write_lookups=False)
    assert len(os.listdir(f"{out}/_data")) == 2 and current(spark, out).version == 3
    os.makedirs(f"{out}/_data/stopped/dim_usdemog")
    expire(spark, out, keep=1)
    assert len(os.listdir(f"{out}/_data")) == 2
    expire(spark, out, keep=1, unpublished=True)
    assert len(os.listdir(f"{out}/_data")) == 1 and read_table(spark, out, "dim_usdemog").count() > 0


def test_checks_run_no_job_of_their_own(spark, tmp_dir):
    """Row and null-key counts come with the writes: one job a table, none reads it."""
    src = sources_from_driver_tables(spark, SMOKE_DIR)
    plans = []
    DataFrame = type(spark.range(1))
    collect = DataFrame.collect
    out = os.path.join(tmp_dir, "star")
    try:
        DataFrame.collect = lambda self: plans.append(self._jdf.queryExecution().toString()) or collect(self)
        run_load(spark, src, out, tables=["dim_calendar"], write_lookups=False)
        assert not [p for p in plans if "_data" in p]
        read_table(spark, out, "dim_calendar").collect()
    finally:
        DataFrame.collect = collect
    assert [p for p in plans if "_data" in p]


def test_null_keys_go_to_quarantine(spark, tmp_dir):
    src = sources_from_driver_tables(spark, SMOKE_DIR)
    src.arrivals = src.arrivals.withColumn("cicid", F.when(F.col("cicid") % 5 != 0, F.col("cicid")))
    out = os.path.join(tmp_dir, "star")
    rows = run_load(spark, src, out, quarantine=True, tables=["dim_immigrant", "dim_calendar"], write_lookups=False).collect()
    assert all(r.passed for r in rows)
    bad = read_table(spark, out, "quarantine_dim_immigrant").collect()
    assert len(bad) == 1 and bad[0]["reason"] == "null cicid" and bad[0]["cicid"] is None
    assert read_table(spark, out, "dim_immigrant").where("cicid IS NULL").count() == 0
    assert [r["reason"] for r in read_table(spark, out, "quarantine_dim_calendar").collect()] == ["null arr_date"]
