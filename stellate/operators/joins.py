"""Lookup (code table) joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(data: DataFrame, lookup: DataFrame, on, *,
                defaults: Mapping[str, object] | None = None,
                casts: Mapping[str, str] | None = None,
                suffixes: tuple[str, str] = ("_map", "_data")) -> DataFrame:
    """Attach lookup columns to every data row (right outer equi-join).

    * every data row is kept; a key with several lookup rows multiplies it;
    * output columns: lookup columns first (key included), then data columns;
    * unmatched lookup columns get ``defaults`` and are then cast by ``casts``;
    * overlapping non-key columns are suffixed, as a pandas merge does;
    * null keys never match (SQL equality).

    No hint and no counting: Spark broadcasts the lookup when its size in
    bytes, estimated or seen at run time, is below its threshold, and joins
    by shuffle otherwise, where it splits the data rows of a hot key (also
    the null key) over several tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    overlap = (set(lookup.columns) & set(data.columns)) - set(keys)
    if overlap:
        lookup = lookup.withColumnsRenamed({c: c + suffixes[0] for c in overlap})
        data = data.withColumnsRenamed({c: c + suffixes[1] for c in overlap})
    lookup_cols = lookup.columns
    data_cols = [c for c in data.columns if c not in keys]
    joined = lookup.alias("__l").join(data.alias("__d"), on=keys, how="right")
    out = []
    for c in lookup_cols:
        col = F.col(c) if c in keys else F.col(f"__l.`{c}`")
        if defaults and c in defaults:
            col = F.coalesce(col, F.lit(defaults[c]))
        if casts and c in casts:
            col = col.cast(casts[c])
        out.append(col.alias(c))
    out += [F.col(f"__d.`{c}`").alias(c) for c in data_cols]
    return joined.select(*out)
