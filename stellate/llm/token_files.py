"""Token ids in files, coded by a static range asymmetric numeral system.

One frequency table, counted over all ids, is shared by all blocks.  A block
holds ``BLOCK`` ids and can be decoded alone: its ids are dealt to ``LANES``
interleaved coder states, so that a step codes one id of each lane (and of
many blocks) at once, and the 32-bit words that the lanes let go follow each
other in the order in which the decoder takes them in.  Every ``CHECK`` steps a
block keeps the states and the place in its words, from which decoding can
start in the middle; the decoder starts at all of them at once.  A block also
keeps the crc32 of its ids, and the documents that begin in it.

Files: ``<path>/blocks`` (one shard for each range of ids, in ascending order of
the document id) and ``<path>/table``, written and read by Spark, so any file
system that Spark knows will do.

Defined cases: a null or empty text is the end id alone; a null document id
comes last; rows with equal ids keep some fixed order; an empty table gives
files without blocks.  Ids are int, bigint or string; others raise when the
files are written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.llm.common import col, ship, stored
from stellate.llm.tokens import encoder

BLOCK, LANES, CHECK, SCALE = 1 << 16, 64, 256, 18
#: Ids of a shard, and blocks coded together.
SHARD, TOGETHER = 4_000_000, 32
_LOW = np.uint64(1 << 31)
_32, _5, _HALF = np.uint64(32), np.uint64(5), np.uint64(0xFFFFFFFF)


# ---- the coder ------------------------------------------------------------

class Table:
    """Frequencies of ids scaled to a power of two; each known id has one."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, scale: int):
        self.scale = np.uint64(scale)
        n = int(symbols.max()) + 1 if len(symbols) else 1
        # For coding: frequency and the sum of those before it, in one number.
        cum = np.cumsum(freq) - freq
        self.known = np.zeros(n, np.uint64)
        self.known[symbols] = (freq.astype(np.uint64) << _32) | cum.astype(np.uint64)
        # For decoding: the id of each slot, its frequency and place in it.
        self.symbol = np.repeat(symbols.astype(np.uint32), freq)
        self.slot = (np.repeat(freq, freq).astype(np.uint64) << _32) | \
            (np.arange(len(self.symbol)) - np.repeat(cum, freq)).astype(np.uint64)

    @staticmethod
    def scaled(counts: np.ndarray, scale: int) -> np.ndarray:
        """Counts (all above 0) scaled to sum to 2**scale, none to 0."""
        total = 1 << scale
        freq = np.maximum(1, (counts.astype(np.float64) * (total / counts.sum())).astype(np.int64))
        order = np.argsort(-freq, kind="stable")
        over = int(freq.sum()) - total
        if over < 0:
            freq[order[0]] -= over
        while over > 0:
            big = order[freq[order] > 1][:over]
            freq[big] -= 1
            over -= len(big)
        return freq


def encode_blocks(ids: np.ndarray, table: Table) -> list[tuple[bytes, bytes]]:
    """(checkpoints, words) of each row of ``ids`` (blocks of equal length)."""
    blocks, n = ids.shape
    steps = -(-n // LANES)
    padded = np.zeros((blocks, steps * LANES), np.int64)  # the pad id must be known
    padded[:] = ids[:, :1]
    padded[:, :n] = ids
    grid = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2))
    x = np.full((blocks, LANES), _LOW, np.uint64)
    words = np.empty((steps, blocks, LANES), np.uint32)
    out = np.empty((steps, blocks, LANES), bool)
    states, top, total = {}, np.uint64(63) - table.scale, np.uint64(1) << table.scale
    for t in range(steps - 1, -1, -1):
        f = table.known[grid[t]]
        c = f & _HALF
        f >>= _32
        full = np.greater_equal(x, f << top, out=out[t])
        words[t] = x  # the low half is kept
        x >>= full.astype(np.uint64) << _5
        q = x // f
        x += q * (total - f) + c
        if t % CHECK == 0:
            states[t] = x.copy()
    result = []
    marks = sorted(states)
    for b in range(blocks):
        taken = np.concatenate([[0], np.cumsum(out[:, b].sum(axis=1))])
        head = b"".join(int(taken[t]).to_bytes(8, "little") + states[t][b].tobytes() for t in marks)
        result.append((head, words[:, b][out[:, b]].tobytes()))
    return result


def decode_spans(blocks: list[tuple[int, bytes, bytes]], spans: list[tuple[int, int, int]],
                 table: Table) -> list[np.ndarray]:
    """Ids lo to hi of block k for each span (k, lo, hi), of blocks (number of
    ids, checkpoints, words).  Only the segments behind the checkpoints that a
    span touches are decoded, all of them side by side."""
    size, segment = 8 + 8 * LANES, CHECK * LANES
    bases = np.cumsum([0] + [len(w) // 4 for _, _, w in blocks])
    stream = np.frombuffer(b"".join(w for _, _, w in blocks) + bytes(4), np.uint32).astype(np.uint64)
    at, x, left = [], [], []
    for k, lo, hi in spans:
        n, head, _ = blocks[k]
        for j in range(lo // segment, -(-hi // segment)):
            part = head[j * size:(j + 1) * size]
            at.append(bases[k] + int.from_bytes(part[:8], "little"))
            x.append(np.frombuffer(part[8:], np.uint64))
            left.append(min(CHECK, -(-n // LANES) - j * CHECK))
    if not at:
        return [np.empty(0, np.uint32) for _ in spans]
    at, x, left = np.array(at, np.int64), np.array(x), np.array(left)
    mask, longest = (np.uint64(1) << table.scale) - np.uint64(1), int(left.max())
    ids = np.zeros((longest, *x.shape), np.uint32)
    order = np.argsort(-left, kind="stable")  # segments that end early come last
    at, x, left = at[order], x[order], left[order]
    for t in range(longest):
        m = int(np.searchsorted(-left, -t, "left"))  # segments of more than t steps
        slot = (x[:m] & mask).astype(np.int64)
        ids[t, :m] = table.symbol[slot]
        f = table.slot[slot]
        v = (f >> _32) * (x[:m] >> table.scale) + (f & _HALF)
        need = v < _LOW
        rank = np.cumsum(need, axis=1)
        word = stream[np.minimum(at[:m, None] + np.maximum(rank - 1, 0), len(stream) - 1)]
        x[:m] = np.where(need, (v << _32) | word, v)
        at[:m] += rank[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    flat, result, j = ids.transpose(1, 0, 2)[back].reshape(len(order), -1), [], 0
    for k, lo, hi in spans:
        first, last = lo // segment, -(-hi // segment)
        # All segments of a block but its last are full.
        result.append(flat[j:j + last - first].ravel()[lo - first * segment:hi - first * segment])
        j += last - first
    return result


# ---- writing --------------------------------------------------------------

def _squeeze(ids: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Ids on their way to the shards: byte planes, compressed; a first byte
    tells how many there are of each id."""
    kind = "<u2" if ids.max() < 1 << 16 else "<u4"
    planes = ids.astype(kind).view(np.uint8).reshape(len(ids), -1).T
    return bytes([len(planes)]) + press.compress(planes.tobytes())


def _unsqueeze(data: bytes, press: zstandard.ZstdDecompressor) -> np.ndarray:
    planes = np.frombuffer(press.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.uint32)


def _tokenise(batches: Iterator[pa.RecordBatch], source, end: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Ids of the texts; one more row, without data, holds how often each id
    came in the task."""
    tokens, press, total = encoder(source.value), zstandard.ZstdCompressor(level=1), np.zeros(1, np.int64)
    for batch in batches:
        data, waiting, held = [], [], 0
        for k, (_, ids) in enumerate(tokens.encode(batch.column("_text")), 1):
            ids = np.append(ids, end)
            data.append(_squeeze(ids, press))
            waiting.append(ids)
            held += len(ids)
            if held > 1 << 20 or k == batch.num_rows:
                total = _plus(total, np.bincount(np.concatenate(waiting)))
                waiting, held = [], 0
        none = pa.nulls(len(data), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(data, pa.binary()), none, none], schema=schema)
    known = np.flatnonzero(total)
    yield pa.RecordBatch.from_pylist([{"tokens": known.tolist(), "counts": total[known].tolist()}], schema)


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two arrays of which the shorter one ends in zeros."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    a[:len(b)] += b
    return a


_BLOCK_SCHEMA = ("shard int, block int, first long, n_ids long, ids_crc32 long, checkpoints binary, words binary, "
                 "open_doc long, open_id {0}, open_at long, open_tokens long, first_doc long, "
                 "doc_ids array<{0}>, doc_tokens array<long>")


def _encode(batches: Iterator[pa.RecordBatch], shared, arrow_id: pa.DataType) -> Iterator[pa.RecordBatch]:
    table, press, shard = Table(*shared.value), zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
    docs, waiting, held, block, first = [], [], 0, 0, 0
    done_docs, carry = 0, (None, None, 0, 0)

    def blocks(ids: np.ndarray, length: int):
        nonlocal docs, block, first, done_docs, carry
        grid = ids.reshape(-1, length)
        rows = []
        for k, (head, words) in enumerate(encode_blocks(grid, table)):
            # Documents that begin in this block, and the one that is open.
            start, opened = first, carry
            mine = []
            while docs and docs[0][1] < start + length:
                mine.append(docs.pop(0))
            rows.append((shard, block, start, length, zlib.crc32(grid[k].astype("<u4").tobytes()), head, words,
                         *opened, done_docs, [d[0] for d in mine], [d[2] for d in mine]))
            done_docs += len(mine)
            end = start + length
            if mine:
                ident, at, n = mine[-1]
                carry = (done_docs - 1, ident, end - at, n) if at + n > end else (None, None, 0, 0)
            elif opened[0] is not None:
                at = opened[2] + length
                carry = (opened[0], opened[1], at, opened[3]) if at < opened[3] else (None, None, 0, 0)
            block, first = block + 1, end
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(),
                 arrow_id, pa.int64(), pa.int64(), pa.int64(), pa.list_(arrow_id), pa.list_(pa.int64())]
        names = [f.split()[0] for f in _BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    seen = 0
    for batch in batches:
        for ident, data in zip(batch.column("_id").to_pylist(), batch.column("data")):
            ids = _unsqueeze(data.as_py(), press)
            docs.append((ident, seen, len(ids)))
            seen += len(ids)
            waiting.append(ids)
            held += len(ids)
            if held >= TOGETHER * BLOCK:
                ids = np.concatenate(waiting)
                whole = len(ids) // BLOCK * BLOCK
                for lo in range(0, whole, TOGETHER * BLOCK):
                    yield blocks(ids[lo:min(whole, lo + TOGETHER * BLOCK)], BLOCK)
                waiting, held = [ids[whole:]], len(ids) - whole
    ids = np.concatenate(waiting) if waiting else np.empty(0, np.uint32)
    whole = len(ids) // BLOCK * BLOCK
    for lo in range(0, whole, TOGETHER * BLOCK):
        yield blocks(ids[lo:min(whole, lo + TOGETHER * BLOCK)], BLOCK)
    if len(ids) > whole:
        yield blocks(ids[whole:], len(ids) - whole)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                      end: int = 0, shard_ids: int = SHARD) -> None:
    """Write the ids of all documents to ``path`` in ascending id order.
    ``tokenizer``: the tokenizer's JSON text."""
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer)
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    arrow_id = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    longs = pa.list_(pa.int64())
    schema = pa.schema([("_id", arrow_id), ("data", pa.binary()), ("tokens", longs), ("counts", longs)])
    ids = stored(rows.mapInArrow(lambda it: _tokenise(it, source, end, schema),
                                 f"_id {kind}, data binary, tokens array<long>, counts array<long>")
                 .withColumn("no", F.monotonically_increasing_id()), "token-ids")[0]
    # One row for each id of the vocabulary: its size is the bound.
    counts = sorted((r["token"], r["count"]) for r in ids.select(F.explode(F.arrays_zip("tokens", "counts")).alias("x"))
                    .groupBy("x.tokens").agg(F.sum("x.counts")).toDF("token", "count").collect())
    symbols = np.array([t for t, _ in counts], np.int64)
    scale = max(SCALE, len(symbols).bit_length() + 2)
    freq = Table.scaled(np.array([c for _, c in counts], np.int64), scale) if counts else np.empty(0, np.int64)
    spark.createDataFrame([(int(t), int(f), scale) for t, f in zip(symbols, freq)],
                          "token long, freq long, scale int").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((symbols, freq, scale))
    shards = max(1, -(-sum(c for _, c in counts) // shard_ids))
    order = [F.col("_id").asc_nulls_last(), F.col("no")]
    (ids.filter("data IS NOT NULL").repartitionByRange(shards, *order).sortWithinPartitions(*order).select("_id", "data")
     .mapInArrow(lambda it: _encode(it, shared, arrow_id), _BLOCK_SCHEMA.format(kind))
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


# ---- reading --------------------------------------------------------------

def _decode(batches: Iterator[pa.RecordBatch], shared, arrow_id: pa.DataType, whole: bool) -> Iterator[pa.RecordBatch]:
    """The documents that lie in one block each, with a look at the block's
    checksum; or else the parts of those that do not."""
    table = Table(*shared.value)
    names = ["shard", "doc", "_id", "at", "n_tokens", "local", "ids"]
    types = [pa.int32(), pa.int64(), arrow_id, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for lo in range(0, batch.num_rows, TOGETHER):
            rows = batch.slice(lo, TOGETHER).to_pylist()
            blocks = [(r["n_ids"], r["checkpoints"], r["words"]) for r in rows]
            found = []  # (row, first id in the block, end, what is returned)
            for k, r in enumerate(rows):
                at = 0
                if r["open_doc"] is not None:
                    at = min(r["n_ids"], r["open_tokens"] - r["open_at"])
                    found.append((k, 0, at, (r["shard"], r["open_doc"], r["open_id"], r["open_at"], r["open_tokens"],
                                             r["first"] - r["open_at"])))
                for j, (ident, n) in enumerate(zip(r["doc_ids"], r["doc_tokens"])):
                    found.append((k, at, min(at + n, r["n_ids"]),
                                  (r["shard"], r["first_doc"] + j, ident, 0, n, r["first"] + at)))
                    at += n
            found = [f for f in found if (f[2] - f[1] == f[3][4]) == whole]
            if whole:
                out = []
                data = [x.astype("<u4").tobytes()
                        for x in decode_spans(blocks, [(k, 0, b[0]) for k, b in enumerate(blocks)], table)]
                for r, d in zip(rows, data):
                    if zlib.crc32(d) != r["ids_crc32"]:
                        raise ValueError(f"shard {r['shard']}, block {r['block']}: checksum does not match")
                out = [(*f, data[k][4 * a:4 * b]) for k, a, b, f in found]
            else:
                parts = decode_spans(blocks, [f[:3] for f in found], table)
                out = [(*f, x.astype("<u4").tobytes()) for (_, _, _, f), x in zip(found, parts)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of each document in the files; ``ids`` as
    little-endian unsigned 32-bit integers, checked against the checksums."""
    ship(spark)
    rows = spark.read.parquet(f"{path}/table").collect()  # bounded by the vocabulary
    rows.sort()
    shared = spark.sparkContext.broadcast((np.array([r.token for r in rows], np.int64),
                                           np.array([r.freq for r in rows], np.int64),
                                           rows[0].scale if rows else SCALE))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["open_id"].dataType.simpleString()
    arrow_id = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    # One row a shard: how many ids come before it.  Read back from a file its
    # size is known, so that the ids aren't shuffled to meet it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "shards")[0]
    schema = f"shard int, doc long, _id {kind}, at long, n_tokens long, local long, ids binary"
    # Documents that go on in the next block, about one a block, are put
    # together; only the segments that hold them are decoded for that.
    joined = (blocks.mapInArrow(lambda it: _decode(it, shared, arrow_id, False), schema).groupBy("shard", "doc")
              .agg(F.first("_id").alias("_id"), F.first("n_tokens").alias("n_tokens"), F.first("local").alias("local"),
                   F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
              .withColumn("ids", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))")))
    cols = ["shard", "_id", "n_tokens", "local", "ids"]
    docs = (blocks.mapInArrow(lambda it: _decode(it, shared, arrow_id, True), schema).select(*cols)
            .unionByName(joined.select(*cols)))
    return docs.join(offsets, "shard").select(F.col("_id").alias(id_col), (F.col("before") + F.col("local")).alias("start"),
                                              "n_tokens", "ids")
