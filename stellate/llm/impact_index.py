"""Exact top-k search with an impact-ordered, score-at-a-time index.

Vectors are cut into blocks.  A block's index has, for each dimension, its
vectors in the order of their component, in segments of equal quantised value.
A query goes through the segments of all dimensions by descending impact: how
much the component adds to the least that this dimension can add.  Each vector
gathers lower bounds; what is still ahead of the query bounds from above what
any vector can gain.  Segments are left out only on proof: the exact scores of
the best vectors so far give a threshold that no vector outside the possible
ones can reach.  Possible members are scored exactly.

Blocks of vectors meet blocks of queries as an equi-join on the pair of block
numbers, each pair a piece of work of its own; of each pair the best k a query
go on to a window over the query.

Defined cases: vectors that are null or hold null or non-finite components
take no part; a shorter vector has 0 where others go on; equal scores go to
the smaller id, a null id last; rows that share an id are vectors of their own,
and a query's own row is not its candidate; inner products must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import col, ship, stored

SCALE, K, BLOCK, QUERIES, LEVELS = 1024, 10, 4096, 1024, 16
#: Segments between two looks at whether the rest can be left out.
LOOK = 64


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.when(vector.isNotNull() & fine, F.transform(wide, lambda x: F.floor(x * scale)))


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class BlockIndex:
    """Vectors of a block, and their order and segments in each dimension."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.x = x
        n, width = x.shape
        low, high = x.min(0), x.max(0)
        step = np.maximum(1, -(-(high - low + 1) // levels))
        level = (x - low) // step
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        counts = np.stack([np.bincount(level[:, d], minlength=levels) for d in range(width)]) if width else \
            np.zeros((0, levels), int)
        self.ends = np.cumsum(counts, axis=1)
        self.least = low[:, None] + step[:, None] * np.arange(levels)
        self.most = np.minimum(self.least + step[:, None] - 1, high[:, None])
        self.filled = counts > 0
        # Exact in doubles as long as no sum can leave 53 bits.
        self.wide = float(np.abs(x).max(initial=0))

    def exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.wide * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2**53:
            return (self.x[rows].astype(float) @ q.astype(float)).astype(np.int64)
        return self.x[rows] @ q

    def search(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can be among the best k, row ``own`` left out, and their
        exact scores."""
        n = len(self.x)
        size = q[:, None]
        top = np.where(size > 0, size * self.most, size * self.least)
        bottom = np.where(size > 0, size * self.least, size * self.most)
        d, level = np.nonzero(self.filled & (size != 0))
        if not len(d) or n <= 2 * k:
            rows = np.flatnonzero(np.arange(n) != own)
            return rows, self.exact(rows, q)
        # Above the least that a dimension adds to any vector.
        floor = np.where(self.filled, bottom, np.iinfo(np.int64).max).min(1)
        up, down = top[d, level] - floor[d], bottom[d, level] - floor[d]
        order = np.argsort(-up, kind="stable")
        d, level, up, down = d[order], level[order], up[order], down[order]
        slack = np.zeros(len(q))
        np.maximum.at(slack, d, up - down)
        slack = slack.sum()
        start = np.where(level > 0, self.ends[d, level - 1], 0)
        size = self.ends[d, level] - start
        got = np.zeros(n)
        base = int(floor[np.unique(d)].sum())
        for lo in range(0, len(d), LOOK):
            hi = min(lo + LOOK, len(d))
            s, m = start[lo:hi], size[lo:hi]
            at = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m - s, m)
            rows = self.order[np.repeat(d[lo:hi], m), at]
            got += np.bincount(rows, np.repeat(down[lo:hi], m).astype(float), n)
            # What each dimension can still add: its next segment, if any.
            ahead = np.zeros(len(q))
            np.maximum.at(ahead, d[hi:], up[hi:])
            if 2 * ahead.sum() > got.max():
                continue
            shown = got.copy()
            if own >= 0:
                shown[own] = -1
            best = np.argpartition(-shown, k - 1)[:k]
            threshold = int(self.exact(best, q).min()) - base
            # Half a unit of room for sums in doubles.
            possible = np.flatnonzero(got + slack + ahead.sum() + 0.5 >= threshold)
            if hi == len(d) or 8 * len(possible) <= n:
                break
        else:
            possible = np.arange(n)
        possible = possible[possible != own]
        return possible, self.exact(possible, q)


def _build(block: pa.Table, width: int) -> pa.Table:
    """One row: the ids, rows and vectors of a block."""
    x = _matrix(block["v"].to_pylist(), width)
    return pa.table({"block": block["block"].slice(0, 1), "ids": [block["_id"].to_pylist()],
                     "rows": [block["row"].to_pylist()], "x": pa.array([x.tobytes()], pa.binary())})


def _search(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    last, index = None, None
    for batch in batches:
        for r in range(batch.num_rows):
            g = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
            ids = g["ids"]
            if g["block"] != last:
                last, index = g["block"], BlockIndex(np.frombuffer(g["x"], np.int64).reshape(-1, width))
            rank = np.argsort(np.argsort([(2**63 - 1) if i is None else i for i in ids], kind="stable"), kind="stable")
            place = {row: i for i, row in enumerate(g["rows"])}
            out: list[tuple] = []
            for q, row, ident in zip(np.frombuffer(g["qx"], np.int64).reshape(-1, width), g["qrows"], g["qids"]):
                rows, score = index.search(q, k, place.get(row, -1))
                best = np.lexsort((rank[rows], -score))[:k]
                out += [(row, ident, ids[i], int(s)) for i, s in zip(rows[best].tolist(), score[best].tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)],
                                                 ["row", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, k: int = K, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each row for which
    ``queries`` holds, by integer inner product."""
    ship(vectors.sparkSession)
    rows = vectors.select(col(id_col).cast("long").alias("_id"), integers(col(vector_col), scale).alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")).filter("v IS NOT NULL")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")[0]
    n, asked, width = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("v"))).first()
    width = width or 0
    blocks, ask_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))
    schema = "block int, ids array<long>, rows array<long>, x binary"

    def built(df: DataFrame, count: int, seed: int) -> DataFrame:
        number = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(count)).cast("int")
        return (df.select(number.alias("block"), "_id", "row", "v").groupBy("block")
                .applyInArrow(lambda t: _build(t, width), schema))

    index = stored(built(rows, blocks, 1), "index")[0]
    asks = stored(built(rows.filter("asks"), ask_blocks, 2), "queries")[0]
    left = index.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))))
    right = asks.select(F.col("block").alias("ask"), F.col("ids").alias("qids"), F.col("rows").alias("qrows"),
                        F.col("x").alias("qx")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = left.join(right.hint("shuffle_hash"), ["block", "ask"])
    found = pairs.mapInArrow(lambda it: _search(it, k, width), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
