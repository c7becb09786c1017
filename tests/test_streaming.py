import os

import pytest

from stellate.plans import tables as TB
from stellate.sinks.files import write_parquet
from stellate.sources import driver_tables
from stellate.streaming import start_fact_stream

from conftest import SMOKE_DIR


def test_incremental_equals_batch(spark, tmp_dir):
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    feed = os.path.join(tmp_dir, "feed")
    # Two deliveries that share rows: the stream must not load them twice.
    write_parquet(arrivals.repartition(3), feed + "/day1")
    write_parquet(arrivals.repartition(2), feed + "/day2")
    out = os.path.join(tmp_dir, "fact")
    q = start_fact_stream(spark, feed + "/*", out, os.path.join(tmp_dir, "state"),
                          max_files_per_trigger=2)
    q.awaitTermination()
    loaded = spark.read.parquet(out)
    assert loaded.select("batch_id").distinct().count() >= 2
    cols = [c for c in loaded.columns if c not in ("immig_id", "batch_id")]
    batch = TB.build_fact_immigration(TB.with_arrival_dates(arrivals), with_id=False)
    assert loaded.count() == batch.count()
    assert loaded.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert loaded.select("immig_id").distinct().count() == loaded.count()


def test_ids_stay_apart_over_many_partitions(spark, tmp_dir):
    """Two batches of 600 partitions each; a replay of the second changes nothing."""
    from stellate.streaming.incremental import _writer

    rows = driver_tables.arrivals(spark, SMOKE_DIR)
    rows = TB.fact_rows(TB.with_arrival_dates(rows)).dropDuplicates()
    out = os.path.join(tmp_dir, "fact")
    write = _writer(out)
    write(rows.where("cicid % 2 = 0").repartition(600), 0)
    write(rows.repartition(600), 1)
    first = spark.read.parquet(out).where("batch_id = 1").count()
    write(rows.repartition(600), 1)
    loaded = spark.read.parquet(out)
    n = rows.count()
    assert loaded.count() == n and loaded.where("batch_id = 1").count() == first < n
    assert loaded.select("immig_id").distinct().count() == n
    assert loaded.selectExpr("max(immig_id)").first()[0] == n


def test_late_and_undated_rows_are_loaded_once(spark, tmp_dir):
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    feed, out, state = (os.path.join(tmp_dir, x) for x in ("feed", "fact", "state"))
    write_parquet(arrivals.where("arrdate > 14000"), feed + "/day1")
    start_fact_stream(spark, feed + "/*", out, state).awaitTermination()
    write_parquet(arrivals.where("arrdate <= 14000 OR arrdate IS NULL OR cicid % 3 = 0"), feed + "/day2")
    start_fact_stream(spark, feed + "/*", out, state).awaitTermination()
    loaded = spark.read.parquet(out)
    cols = [c for c in loaded.columns if c not in ("immig_id", "batch_id")]
    batch = TB.build_fact_immigration(TB.with_arrival_dates(arrivals), with_id=False).select(*cols)
    assert loaded.count() == batch.count()
    assert loaded.select(*cols).exceptAll(batch).count() == 0


def test_output_of_another_checkpoint_is_refused(spark, tmp_dir):
    arrivals = driver_tables.arrivals(spark, SMOKE_DIR)
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "fact")
    write_parquet(arrivals, feed)
    start_fact_stream(spark, feed, out, os.path.join(tmp_dir, "state")).awaitTermination()
    with pytest.raises(ValueError):
        start_fact_stream(spark, feed, out, os.path.join(tmp_dir, "other"))
