"""Packing documents into fixed-length token sequences, first fit decreasing.

Each document becomes its token ids and an end id.  Whole sequences are cut
from the front of long documents; what is left of each document (shorter than a
sequence) goes to a group drawn at random, and each group is packed on its own:
longest first, each into the first bin with room, found in a tournament tree
whose nodes hold the largest room below them.  Bins that end up with more than
``slack`` free places are opened again and their pieces laid end to end, cut at
the sequence length; the last part of a group is cut into powers of two, which
need no padding.

A group holds about ``group_documents`` rests, each below the sequence length,
so its size is bounded whatever the data; the number of groups follows the
number of documents.

Defined cases: a null or empty text is the end id alone; rows that repeat are
documents of their own; a null id stays null; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, ship, stored
from stellate.llm.tokens import encoder

LENGTH, GROUP, SLACK, END = 1024, 8192, 8, 0


def _cut(batches: Iterator[pa.RecordBatch], source, length: int, end: int) -> Iterator[pa.RecordBatch]:
    """The ids of each text in parts of ``length``, the rest last."""
    names = ["_id", "start", "length", "doc_tokens", "ids"]
    tokens = encoder(source.value)
    for batch in batches:
        row, start, size, total, parts, held = [], [], [], [], [], 0
        last = batch.num_rows - 1
        for i, ids in tokens.encode(batch.column("_text")):
            ids = np.append(ids, end).astype("<u4")
            for at in range(0, len(ids), length):
                part = ids[at:at + length]
                row.append(i)
                start.append(at)
                size.append(len(part))
                total.append(len(ids))
                parts.append(part.tobytes())
            held += len(ids)
            if held > 1 << 20 or i == last:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(row)), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(total, pa.int64()), pa.array(parts, pa.binary())], names)
                row, start, size, total, parts, held = [], [], [], [], [], 0


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; items are taken longest first."""
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)  # node k is the better of 2k and 2k + 1
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    for i, need in zip(order.tolist(), sizes[order].tolist()):
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < need:
                k += 1
        where[i], offset[i] = k - leaves, capacity - room[k]
        room[k] -= need
        while k > 1:
            k //= 2
            best = room[2 * k] if room[2 * k] >= room[2 * k + 1] else room[2 * k + 1]
            if room[k] == best:
                break
            room[k] = best
    return where, offset


def pack_group(sizes: np.ndarray, capacity: int, slack: int) -> list[tuple[int, int, int, int, int]]:
    """(item, first, length, sequence, offset) of each piece of a group."""
    where, offset = first_fit_decreasing(sizes, capacity)
    fill = np.bincount(where, weights=sizes).astype(np.int64)
    exact = (fill & (fill - 1)) == 0
    firm = (capacity - fill <= slack) | exact
    number = np.cumsum(firm) - 1
    keep = firm[where]
    pieces = [(int(i), 0, int(sizes[i]), int(number[where[i]]), int(offset[i])) for i in np.flatnonzero(keep)]
    # The open bins end to end: whole sequences, then powers of two.
    loose = np.flatnonzero(~keep)
    loose = loose[np.lexsort((offset[loose], where[loose]))]
    left = int(sizes[loose].sum())
    lengths = [capacity] * (left // capacity)
    lengths += [1 << b for b in range(capacity.bit_length(), -1, -1) if left % capacity >> b & 1]
    sequence, used = int(firm.sum()), 0
    it = iter(lengths)
    size = next(it, 0)
    for i in loose.tolist():
        first = 0
        while first < sizes[i]:
            if used == size:
                sequence, used, size = sequence + 1, 0, next(it)
            n = min(int(sizes[i]) - first, size - used)
            pieces.append((i, first, n, sequence, used))
            first, used = first + n, used + n
    return pieces


def _pack(group: pa.Table, capacity: int, slack: int) -> pa.Table:
    group = group.combine_chunks()
    pieces = np.array(pack_group(group["length"].to_numpy(), capacity, slack), np.int64).reshape(-1, 5)
    item, first, size, sequence, offset = pieces.T
    rows, ids = group.take(pa.array(item)), group["ids"].to_pylist()
    number = rows["pack_group"].to_numpy()
    # Odd numbers: whole sequences that are one piece have the even ones.
    return pa.table({
        "_id": rows["_id"], "start": rows["start"].to_numpy() + first, "length": size,
        "doc_tokens": rows["doc_tokens"],
        "ids": pa.array([ids[i][4 * f:4 * (f + n)] for i, f, n in zip(item.tolist(), first.tolist(), size.tolist())],
                        pa.binary()),
        "sequence_id": 2 * ((number << 31) | sequence) + 1, "offset": offset})


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         group_documents: int = GROUP, slack: int = SLACK, end: int = END, seed: int = 7) -> DataFrame:
    """Pieces (id, start, length, doc_tokens, ids, sequence_id, offset).

    ``ids``: the piece's token ids as little-endian unsigned 32-bit integers.
    ``tokenizer``: the tokenizer's JSON text.  ``length``: a power of two."""
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer)
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, start long, length long, doc_tokens long, ids binary"
    parts = stored(rows.mapInArrow(lambda it: _cut(it, source, length, end), schema)
                   .withColumn("no", F.monotonically_increasing_id()), "pieces")[0]
    whole = parts.filter(F.col("length") == length).select(
        "_id", "start", "length", "doc_tokens", "ids", (F.col("no") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = parts.filter(F.col("length") < length)
    groups = max(1, -(-rest.count() // group_documents))
    packed = (rest.withColumn("pack_group", F.pmod(F.xxhash64(F.lit(seed), "no"), F.lit(groups)))
              .drop("no").groupBy("pack_group")
              .applyInArrow(lambda t: _pack(t, length, slack), schema + ", sequence_id long, offset long"))
    return whole.unionByName(packed).withColumnRenamed("_id", id_col)
