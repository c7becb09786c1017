"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import remove_path, scratch_path

#: ASCII white space as the corpus contracts define it, and its complement.
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: their Python
    workers import it, wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="stellate-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared checkpoint folder; return what was
    written and its path.  Cuts the lineage: a lost executor re-reads files."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        remove_path(spark, path)


def doc_hash(id_col: Column) -> Column:
    """crc32 of the id written as decimal text; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary"))


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """True for rows of the held-out fold.  A null id is never held out, and
    never learned from either (see ``learnable``)."""
    return F.coalesce(doc_hash(id_col) % folds == fold, F.lit(False))


def learnable(id_col: Column, folds: int, fold: int) -> Column:
    return F.coalesce(doc_hash(id_col) % folds != fold, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name
