"""Tables that are published together, by one small commit file.

A load writes its tables below ``<out>/_data/<run>/`` and then one file
``_commits/<version>.json`` that names, for every table, the folders that hold
it.  Readers follow the greatest complete commit, so they see all tables of a
load or none; nothing is renamed or copied, which on an object store is the
same.  A commit file ends with a mark; one that was cut off is passed over.  A
commit file is made only where there is none: of two loads that began with one
version, the second fails and leaves the tables alone.

A partitioned table may be spread over runs: a refresh writes the partitions
that it touches and commits them beside the untouched ones of earlier runs,
whose files stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stellate.session import list_folders, list_names, read_bytes, remove_path, write_new
from stellate.sinks.files import write_parquet

_END = "\n#end"


class CommitConflict(RuntimeError):
    pass


@dataclass
class Table:
    """Where a table lies: ``roots`` holds (folder, partition folders or None)."""

    schema: str
    partition_by: str | None
    roots: list[tuple[str, list[str] | None]]


@dataclass
class Snapshot:
    version: int
    tables: dict[str, Table]
    info: dict = field(default_factory=dict)


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def run_folder(out: str, run: str) -> str:
    return f"{out.rstrip('/')}/_data/{run}"


def write_table(df: DataFrame, out: str, run: str, name: str, partition_by: str | None = None,
                rebalance: bool = False) -> Table:
    """Write a table of a run; it is published by a commit that holds it."""
    path = f"_data/{run}/{name}"
    full = f"{out.rstrip('/')}/{path}"
    write_parquet(df, full, mode="errorifexists", partition_by=partition_by, rebalance=rebalance)
    folders = list_folders(df.sparkSession, full) if partition_by else None
    return Table(df.schema.json(), partition_by, [(path, folders)])


def _versions(spark: SparkSession, out: str) -> list[int]:
    names = list_names(spark, f"{out.rstrip('/')}/_commits")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, out: str, version: int) -> Snapshot | None:
    text = read_bytes(spark, f"{out.rstrip('/')}/_commits/{version:020d}.json").decode()
    if not text.endswith(_END):
        return None
    held = json.loads(text[:-len(_END)])
    return Snapshot(version, {n: Table(t["schema"], t["partition_by"], [(p, v) for p, v in t["roots"]])
                              for n, t in held["tables"].items()}, held["info"])


def current(spark: SparkSession, out: str, version: int | None = None) -> Snapshot | None:
    """The last complete commit (or the given one); None without any."""
    for v in reversed(_versions(spark, out)):
        if version is None or v == version:
            found = _load(spark, out, v)
            if found is not None:
                return found
    return None


def commit(spark: SparkSession, out: str, tables: dict[str, Table], base: Snapshot | None = None,
           info: dict | None = None) -> Snapshot:
    """Publish ``tables`` together with those of ``base`` that they don't
    replace.  ``base`` is what the load began with; if another load has
    committed since, CommitConflict is raised."""
    versions = _versions(spark, out)
    newest = current(spark, out)
    if (newest.version if newest else None) != (base.version if base else None):
        raise CommitConflict(f"{out}: another load was published meanwhile")
    merged = {**(base.tables if base else {}), **tables}
    version = (versions[-1] if versions else 0) + 1
    text = json.dumps({"tables": {n: {"schema": t.schema, "partition_by": t.partition_by, "roots": t.roots}
                                  for n, t in merged.items()}, "info": info or {}}, indent=1)
    if not write_new(spark, f"{out.rstrip('/')}/_commits/{version:020d}.json", (text + _END).encode()):
        raise CommitConflict(f"{out}: another load was published meanwhile")
    return Snapshot(version, merged, info or {})


def read_table(spark: SparkSession, out: str, name: str, snapshot: Snapshot | None = None) -> DataFrame:
    """A published table, of the last commit unless a snapshot is given."""
    snapshot = snapshot or current(spark, out)
    if snapshot is None or name not in snapshot.tables:
        raise FileNotFoundError(f"{out} holds no published table {name}")
    return _frame(spark, out, snapshot.tables[name])


def _frame(spark: SparkSession, out: str, table: Table) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(table.schema))
    found = None
    for path, folders in table.roots:
        root = f"{out.rstrip('/')}/{path}"
        if folders == []:
            continue
        paths = [root] if folders is None else [f"{root}/{f}" for f in folders]
        part = spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*[f"`{n}`" for n in schema.names])
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def export_tables(spark: SparkSession, out: str, target: str, names: Iterable[str] | None = None) -> None:
    """Write the published tables as plain folders ``<target>/<name>``, for
    readers that know no commits."""
    snapshot = current(spark, out)
    for name in names or (snapshot.tables if snapshot else ()):
        write_parquet(read_table(spark, out, name, snapshot), f"{target.rstrip('/')}/{name}",
                      partition_by=snapshot.tables[name].partition_by)


def partition_folder(name: str, value) -> str:
    return f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def read_partitions(spark: SparkSession, out: str, table: Table, values: Iterable) -> DataFrame:
    """The partitions of the given values (None: rows without one), by their
    folders: nothing else is listed or read."""
    wanted = {partition_folder(table.partition_by, v) for v in values}
    return _frame(spark, out, Table(table.schema, table.partition_by,
                                    [(p, [f for f in folders or [] if f in wanted]) for p, folders in table.roots]))


def replaced(old: Table | None, new: Table, values: Iterable) -> Table:
    """``old`` with the partitions of ``values`` taken from ``new``; those that
    ``new`` hasn't any more are gone, all others keep their files."""
    if old is None:
        return new
    gone = {partition_folder(new.partition_by, v) for v in values}
    kept = [(p, [f for f in folders or [] if f not in gone]) for p, folders in old.roots]
    return Table(new.schema, new.partition_by, [r for r in kept if r[1]] + new.roots)


def expire(spark: SparkSession, out: str, keep: int = 2, unpublished: bool = False) -> None:
    """Remove the commits but the last ``keep``, and the tables that only those
    held.  ``unpublished`` also removes what no commit holds, left by loads that
    were stopped; only for a time when no load runs."""
    out = out.rstrip("/")
    held, gone, kept = set(), set(), 0
    for v in reversed(_versions(spark, out)):
        snapshot = _load(spark, out, v)
        paths = {p for t in snapshot.tables.values() for p, _ in t.roots} if snapshot else set()
        if snapshot and kept < keep:
            kept += 1
            held |= paths
        elif kept:
            gone |= paths
            remove_path(spark, f"{out}/_commits/{v:020d}.json")
    if unpublished and kept:
        gone |= {f"_data/{run}/{name}" for run in list_names(spark, f"{out}/_data")
                 for name in list_names(spark, f"{out}/_data/{run}")}
    for path in sorted(gone - held):
        remove_path(spark, f"{out}/{path}")
    for run in sorted({path.split("/")[1] for path in gone}):
        if not list_names(spark, f"{out}/_data/{run}"):
            remove_path(spark, f"{out}/_data/{run}")
