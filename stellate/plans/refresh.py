"""Refresh of a published star schema with a new delivery of arrivals.

The original load rebuilds everything for each delivery.  Here a delivery costs
what it touches, and the tables after any number of deliveries, in any split, are
those of one load over all of them:

* ``fact_immigration``: rows that the delivery's years don't hold yet are added
  beside the files that are there; ids go on from the highest one;
* ``dim_calendar``: dates that aren't there yet are added;
* ``dim_immigrant``: a traveller's row is the least of all records in the survivor
  order, whichever delivery held it.  The survivors (``immigrant_survivors``) are
  kept with those that have no arrival year, as these leave a traveller out of
  the dimension.  Travellers of the delivery whose survivor changes are put into
  their years anew: only the years that lose or gain a row are rewritten.  The
  dimension is the survivors' files without the partition of no year.

All three are published by one commit.  Only the years and one id reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate import schemas
from stellate.operators.dedupe import dedupe_by_key
from stellate.operators.keys import materialize, number_rows
from stellate.plans import tables as TB
from stellate.plans.pipeline import REPORT_SCHEMA, write_checked
from stellate.session import remove_path, scratch_scope
from stellate.sinks import snapshots

SURVIVORS = "immigrant_survivors"


def _same(a: str, b: str, names: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in names])


def _years(df: DataFrame, name: str = "arr_year") -> list:
    return [r[0] for r in df.select(name).distinct().collect()]  # a handful


def appended(old: snapshots.Table | None, new: snapshots.Table) -> snapshots.Table:
    """``new`` beside ``old``; partitions may have files of both."""
    return new if old is None else replace(new, roots=old.roots + [r for r in new.roots if r[1] != []])


def without_null(table: snapshots.Table) -> snapshots.Table:
    """The table without the rows that have no partition value."""
    null = snapshots.partition_folder(table.partition_by, None)
    return replace(table, roots=[(p, [f for f in folders if f != null]) for p, folders in table.roots])


def added_rows(spark: SparkSession, out: str, old: snapshots.Table | None, rows: DataFrame, part: str) -> DataFrame:
    """Rows of ``rows`` (distinct) that the published table lacks, by all their
    columns.  Only the partitions that ``rows`` touches are read."""
    if old is None:
        return rows
    held = snapshots.read_partitions(spark, out, old, _years(rows, part)).select(*[f"`{c}`" for c in rows.columns])
    return rows.alias("a").join(held.alias("b"), _same("a", "b", rows.columns), "left_anti")


def upsert_survivors(spark: SparkSession, out: str, old: snapshots.Table | None, batch: DataFrame, key: str,
                     part: str) -> tuple[DataFrame, list]:
    """(rows, partition values): the new contents of the partitions that change
    when ``batch`` (one row a key) meets the published survivors.  A key's
    survivor is the least row of both."""
    if old is None:
        return batch, _years(batch, part)
    held = snapshots._frame(spark, out, old).select(*batch.columns)
    met = materialize(held.alias("h").join(batch.alias("b"), _same("h", "b", [key]), "left_semi"), "survivors-met")
    winners = dedupe_by_key(met.unionByName(batch), [key])
    changed = materialize(winners.alias("w").join(met.alias("m"), _same("w", "m", batch.columns), "left_anti"),
                          "survivors-changed")
    left = met.alias("m").join(changed.alias("c"), _same("m", "c", [key]), "left_semi")
    values = list(dict.fromkeys(_years(changed, part) + _years(left, part)))
    stay = snapshots.read_partitions(spark, out, old, values).select(*batch.columns).alias("s").join(
        changed.alias("c"), _same("s", "c", [key]), "left_anti")
    return stay.unionByName(changed), values


def refresh_arrivals(spark: SparkSession, arrivals: DataFrame, output_dir: str, *, keep: int = 2,
                     null_key_threshold: int = 0) -> DataFrame:
    """Add a delivery of arrivals to the published tables (or publish the first
    ones); returns the checks of what was written.

    A published ``dim_immigrant`` without its survivors (from ``run_load``)
    can't be carried on and is refused."""
    out, run = output_dir.rstrip("/"), snapshots.new_run()
    base = snapshots.current(spark, out)
    had = base.tables if base else {}
    if schemas.DIM_IMMIGRANT.name in had and SURVIVORS not in had:
        raise ValueError(f"{out} holds dim_immigrant without {SURVIVORS}; refresh goes on from a refresh")
    published, last = False, int((base.info if base else {}).get("last_id", 0))
    fact, calendar, part = schemas.FACT_IMMIGRATION, schemas.DIM_CALENDAR, schemas.DIM_IMMIGRANT.partition_by
    try:
        with scratch_scope(spark):
            dated = materialize(TB.with_arrival_dates(arrivals), "delivery")
            rows = added_rows(spark, out, had.get(fact.name),
                              TB.build_fact_immigration(dated, with_id=False, assert_keys=False), fact.partition_by)
            rows = number_rows(materialize(rows, "new-facts"), "immig_id", start=last + 1)
            dates = added_rows(spark, out, had.get(calendar.name), TB.build_dim_calendar(
                dated, null_dates="drop", assert_keys=False), calendar.partition_by)
            batch = materialize(dedupe_by_key(TB.immigrant_rows(dated), ["cicid"]), "delivery-survivors")
            survivors, values = upsert_survivors(spark, out, had.get(SURVIVORS), batch, "cicid", part)
            written, report = write_checked(spark, out, run, [
                (fact.name, rows, fact.key, fact.partition_by), (calendar.name, dates, calendar.key, calendar.partition_by),
                (SURVIVORS, survivors, "cicid", part)], null_key_threshold=null_key_threshold)
            n_new = next(r["n_rows"] for r in report if r["table"] == fact.name)
        kept = snapshots.replaced(had.get(SURVIVORS), written[SURVIVORS], values)
        snapshots.commit(spark, out, {
            fact.name: appended(had.get(fact.name), written[fact.name]),
            calendar.name: appended(had.get(calendar.name), written[calendar.name]),
            SURVIVORS: kept, schemas.DIM_IMMIGRANT.name: without_null(kept)}, base,
            {"report": report, "last_id": last + n_new})
        published = True
    finally:
        if not published:
            remove_path(spark, snapshots.run_folder(out, run))
    snapshots.expire(spark, out, keep)
    return spark.createDataFrame([tuple(r[f] for f in REPORT_SCHEMA.fieldNames()) for r in report], REPORT_SCHEMA)
