"""Conversations as ordered turns, without a window over a conversation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.llm.common import col, partitions, ship, stored

#: Turns of a conversation that are worked on together.
CHUNK = 4096


def same(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of the named columns of two aliased tables, null equal to null."""
    found = F.lit(True)
    for n in names:
        found = found & F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`"))
    return found


def ordered_turns(turns: DataFrame, conv: str, order: Sequence[str], carry: dict[str, Column],
                  label: str = "turns") -> DataFrame:
    """(conv, idx, carried columns): the turns of every conversation numbered
    from 0 in the order of ``order`` (nulls first), stored.

    The rows are ranged by conversation and order, so that a conversation that
    holds a large share of them is spread over many tasks.  Each task numbers
    the rows of its range as they come; what a conversation had in the ranges
    before it is added from a table of one row a range, which is broadcast.
    """
    spark = turns.sparkSession
    ship(spark)
    keys = [col(conv).asc_nulls_first()] + [col(c).asc_nulls_first() for c in order]
    ranged = turns.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    named = ranged.select(col(conv).alias("conv"), F.spark_partition_id().alias("part"),
                          *[c.alias(n) for n, c in carry.items()])
    schema = T.StructType(list(named.schema.fields) + [T.StructField("pos", T.LongType())])

    def number(batches):
        last, count = None, 0            # the conversation of the last row; its rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(0).dictionary_encode(null_encoding="encode")
            ids = codes.indices.to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            length = np.diff(np.r_[start, len(ids)])
            pos = np.arange(len(ids)) - np.repeat(start, length)
            values = codes.dictionary
            first, final = values[int(ids[0])].as_py(), values[int(ids[-1])].as_py()
            if last is not None and last[0] == first:
                pos[:length[0]] += count
            last, count = (final,), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos.astype("int64"))],
                                             names=[*batch.schema.names, "pos"])

    rows = stored(named.mapInArrow(number, schema), label)[0]
    # The last conversation of each range, and how many of its rows are there.
    ends = rows.groupBy("part").agg(F.max(F.struct(F.col("conv").isNotNull().alias("k"), "conv", "pos")).alias("e"))
    ends = ends.select("part", F.col("e.conv").alias("conv"), (F.col("e.pos") + 1).alias("n"))
    a, b = ends.alias("a"), ends.alias("b")
    # One row a range on either side: earlier ranges that end in the same
    # conversation as this one begins with.
    heads = rows.where("pos = 0").groupBy("part").agg(
        F.min(F.struct(F.col("conv").isNotNull().alias("k"), "conv")).alias("h")).select(
        "part", F.col("h.conv").alias("conv")).alias("a")
    before = (heads.join(F.broadcast(b), (F.col("b.part") < F.col("a.part")) & same("a", "b", ["conv"]))
              .groupBy("a.part", "a.conv").agg(F.sum("b.n").alias("off")).alias("o"))
    idx = (F.col("r.pos") + F.coalesce(F.col("o.off"), F.lit(0))).alias("idx")
    return rows.alias("r").join(F.broadcast(before), same("r", "o", ["part", "conv"]), "left").select(
        "r.conv", idx, *[F.col(f"r.`{n}`") for n in carry])


def hashed_in_order(df: DataFrame, key: str, order: Sequence[str], piece: str, sep: str, out: str) -> DataFrame:
    """(key, out): the lower-case SHA-256 of the ``piece`` texts of each key,
    joined by ``sep`` in the order of ``order``.

    Pieces are read in order and hashed as they come, so a key of any length
    takes the memory of one batch.  A hash is made in order by its nature; all
    else about a long key is spread.
    """
    spark = df.sparkSession
    ship(spark)
    rows = (df.select(col(key).alias("key"), *[col(c) for c in order], col(piece).cast("binary").alias("piece"))
            .repartition(partitions(spark), "key")
            .sortWithinPartitions(F.col("key").asc_nulls_first(), *[col(c) for c in order])
            .select("key", "piece"))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(out, T.StringType())])
    joint = sep.encode()
    kind = schema[0].dataType

    def run(batches):
        import hashlib

        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)
        now, digest = None, None
        for batch in batches:
            done_keys, done = [], []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if now is not None and now[0] == k:
                    digest.update(joint)
                else:
                    if now is not None:
                        done_keys.append(now[0]), done.append(digest.hexdigest())
                    now, digest = (k,), hashlib.sha256()
                digest.update(v.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done_keys, arrow), pa.array(done, pa.string())],
                                                 names=[key, out])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], arrow), pa.array([digest.hexdigest()], pa.string())],
                                             names=[key, out])

    return rows.mapInArrow(run, schema)
