"""Incremental fact load with Structured Streaming.

The batch load is re-run in full for every refresh.  This is the same fact
build as a stream over the arrivals folder: new Parquet files are picked up,
turned into fact rows, de-duplicated against everything loaded before, given
ids and appended.  ``trigger(availableNow=True)`` makes it a scheduled job
that processes what has arrived and stops.

* The stream itself keeps no state.  Each micro-batch drops its own repeated
  rows and then, by an anti-join on all columns, the rows that earlier batches
  wrote.  Only the ``arr_year`` partitions that the batch touches are read from
  the target, so neither memory nor the time of a batch grows with years that
  no longer change, and no row is ever too late to be loaded.
* Ids are dense: a batch numbers its rows from the highest id of the batches
  before it, kept in ``<output>/_ids``, one row per batch.
* Each micro-batch writes to its own ``batch_id=<n>`` folder in overwrite
  mode and looks only at batches below it, so a batch replayed after a failure
  replaces its earlier attempt: the sink is idempotent.  Read the table with
  ``spark.read.parquet(out)``.
* A new checkpoint location starts at batch 0 again; it is refused for an
  output folder that already holds batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stellate import schemas
from stellate.operators.columns import allow_null, require_not_null
from stellate.operators.keys import number_rows
from stellate.plans.tables import fact_rows, with_arrival_dates
from stellate.session import path_exists, scratch_scope

_FACT = T.StructType([T.StructField(n, t) for n, t in schemas.OUTPUT_COLUMNS["fact_immigration"]]
                     + [T.StructField("batch_id", T.LongType())])
_IDS = "batch long, last long"


def fact_stream(spark: SparkSession, arrivals_dir: str, *,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of fact rows (without ids, repeats included)."""
    reader = spark.readStream.schema(schemas.ARRIVALS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = fact_rows(with_arrival_dates(reader.parquet(arrivals_dir)))
    return allow_null(require_not_null(rows, ["cicid"]), ["I94VISA"])


def new_rows(batch: DataFrame, loaded: DataFrame) -> DataFrame:
    """Distinct rows of ``batch`` that ``loaded`` (same columns and more) lacks.

    Rows are compared in full, null equal to null.  The years of the batch (a
    handful, collected) are literals in a filter on ``loaded``, so only their
    partitions are listed and read."""
    rows = batch.dropDuplicates()
    years = [r[0] for r in batch.select("arr_year").distinct().collect()]
    known = F.col("arr_year").isin([y for y in years if y is not None])
    old = loaded.select(*batch.columns).where(known | F.col("arr_year").isNull() if None in years else known)
    a, b = rows.alias("__a"), old.alias("__b")
    same = reduce(lambda x, y: x & y, [F.col(f"__a.`{c}`").eqNullSafe(F.col(f"__b.`{c}`"))
                                       for c in batch.columns])
    return a.join(b, same, "left_anti")


def _writer(output_dir: str):
    out = output_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            rows, last = batch.dropDuplicates(), 0
            if path_exists(spark, f"{out}/_ids"):
                ids = spark.read.schema(_IDS).parquet(f"{out}/_ids/*")
                last = ids.where(F.col("batch") < batch_id).agg(F.max("last")).first()[0] or 0
                loaded = spark.read.schema(_FACT).parquet(out).where(F.col("batch_id") < batch_id)
                rows = new_rows(batch, loaded)
            numbered = number_rows(rows, "immig_id", start=last + 1)
            numbered.write.mode("overwrite").partitionBy("arr_year").parquet(f"{out}/batch_id={batch_id}")
            top = numbered.agg(F.max("immig_id")).first()[0] or last
        spark.createDataFrame([(batch_id, top)], _IDS).coalesce(1).write.mode("overwrite") \
            .parquet(f"{out}/_ids/batch-{batch_id}")

    return write_batch


def start_fact_stream(spark: SparkSession, arrivals_dir: str, output_dir: str,
                      checkpoint_location: str, *,
                      max_files_per_trigger: int | None = None,
                      available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental fact load; returns the running query."""
    if not path_exists(spark, f"{checkpoint_location.rstrip('/')}/offsets") and \
            path_exists(spark, f"{output_dir.rstrip('/')}/_ids"):
        raise ValueError(f"{output_dir} holds batches of another checkpoint than {checkpoint_location}")
    stream = fact_stream(spark, arrivals_dir, max_files_per_trigger=max_files_per_trigger)
    w = (stream.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint_location)
         .foreachBatch(_writer(output_dir)))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
