import os

import pytest
from pyspark.sql import functions as F

from stellate.plans import tables as TB
from stellate.plans.refresh import SURVIVORS, refresh_arrivals
from stellate.sinks.snapshots import current, read_table
from stellate.sources import driver_tables

from conftest import SMOKE_DIR

TABLES = ("dim_immigrant", "dim_calendar", "fact_immigration")


def _rows(df):
    cols = sorted(c for c in df.columns if c != "immig_id")
    return sorted(map(str, df.select(*cols).collect()))


def _one_load(arrivals):
    dated = TB.with_arrival_dates(arrivals)
    return {"dim_immigrant": TB.build_dim_immigrant(dated), "dim_calendar": TB.build_dim_calendar(arrivals, null_dates="drop"),
            "fact_immigration": TB.build_fact_immigration(dated, with_id=False)}


@pytest.mark.parametrize("split", ["cicid % 3 = 0", "biryear % 2 = 0", "arrdate < 14000"])
def test_two_deliveries_equal_one_load(spark, tmp_dir, split):
    """Split by traveller; through travellers, so that survivors change hands
    (some lose their year, some gain one); and by date."""
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    # A record of the same traveller in another year, and one without a date.
    again = arrivals.where("cicid % 4 = 1").withColumn("arrdate", F.col("arrdate") - 800).withColumn("i94cit", F.col("i94cit") - 1)
    undated = arrivals.where("cicid % 7 = 2").withColumn("arrdate", F.lit(None).cast("double")).withColumn("i94cit", F.lit(1.0))
    arrivals = arrivals.unionByName(again).unionByName(undated)
    out = os.path.join(tmp_dir, "star")
    first = F.coalesce(F.expr(split), F.lit(False))
    refresh_arrivals(spark, arrivals.where(first), out)
    refresh_arrivals(spark, arrivals.where(~first).unionByName(arrivals.where("cicid % 10 = 0")), out)
    for name, want in _one_load(arrivals).items():
        assert _rows(read_table(spark, out, name)) == _rows(want), name
    fact = read_table(spark, out, "fact_immigration")
    n = fact.count()
    assert fact.select("immig_id").distinct().count() == n == fact.agg(F.max("immig_id")).first()[0]


def test_untouched_years_keep_their_files(spark, tmp_dir):
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    out = os.path.join(tmp_dir, "star")
    year = F.year(TB.sas_to_date("arrdate"))
    late = (year == 1995) & (F.col("cicid") % 2 == 0)
    refresh_arrivals(spark, arrivals.where(~F.coalesce(late, F.lit(False))), out)

    def files(name):
        df = read_table(spark, out, name).select("arr_year", F.input_file_name().alias("f")).distinct()
        return {y: {r.f for r in df.collect() if r.arr_year == y} for y in {r.arr_year for r in df.collect()}}

    before = files(SURVIVORS), files("fact_immigration")
    refresh_arrivals(spark, arrivals.where(late), out)
    after = files(SURVIVORS), files("fact_immigration")
    assert {y for y in after[0] if after[0][y] != before[0].get(y)} == {1995}
    assert before[1][1995] < after[1][1995]  # facts are added beside the old files
    assert all(after[1][y] == before[1][y] for y in before[1] if y != 1995)
    report = refresh_arrivals(spark, arrivals.where(late), out)  # the same delivery again changes nothing
    assert (files(SURVIVORS), files("fact_immigration")) == after
    assert {r["n_rows"] for r in report.collect()} == {0}
    assert current(spark, out).version == 3


def test_a_plain_load_is_not_carried_on(spark, tmp_dir):
    from stellate.plans.pipeline import run_load, sources_from_driver_tables

    src = sources_from_driver_tables(spark, SMOKE_DIR)
    run_load(spark, src, tmp_dir + "/star", tables=["dim_immigrant"], write_lookups=False)
    with pytest.raises(ValueError):
        refresh_arrivals(spark, src.arrivals, tmp_dir + "/star")


def test_a_batch_reads_only_its_years(spark, tmp_dir):
    """The streaming load's look at loaded rows is pruned to the batch's years."""
    from stellate.streaming.incremental import new_rows

    rows = TB.fact_rows(TB.with_arrival_dates(driver_tables.arrivals(spark, SMOKE_DIR))).dropDuplicates()
    path = os.path.join(tmp_dir, "fact")
    rows.write.partitionBy("arr_year").parquet(path)
    loaded = spark.read.schema(rows.schema).parquet(path)
    for years in ("arr_year = 1995", "arr_year = 1995 OR arr_year IS NULL", "arr_year IS NULL"):
        found = new_rows(rows.where(years), loaded)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "PartitionFilters" in line and "star" not in line and path in line]
        assert scans and all("PartitionFilters: []" not in line for line in scans)
        assert found.count() == 0
    assert new_rows(rows, loaded.where("arr_year <> 1995")).count() == rows.where("arr_year = 1995 OR arr_year IS NULL").count()
