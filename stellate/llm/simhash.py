"""SimHash near-duplicates by a binary trie self-join.

A fingerprint holds one bit for each of the 64 bits of the shingles' XXH64:
set if over half the shingles, repeats included, have it set.  Documents link
if their fingerprints differ in at most ``budget`` bits; the result is the
connected component of each document.

The join walks pairs of trie nodes: a pair carries the bits in which the two
paths differ so far, its four pairs of children follow, and a pair is dropped
as soon as its differing bits exceed the budget.  To spread the walk over a
cluster, the 64 bits are cut into ``SEGMENTS`` segments.  Two fingerprints
within the budget agree wholly in at least CLEAN of them, so for each choice of
CLEAN segments a trie that has those first needs only the pairs of a node with
itself at that depth: each such node is a piece of work of its own.  A node
with more than ``limit`` fingerprints is walked further down in Spark, as pairs
of child nodes with their differing bits, until each pair is small.  Within a
task the walk keeps a union-find forest, so a piece of n fingerprints gives at
most n - 1 links, however many pairs match.

Defined cases: a null text is empty; a text without words has fingerprint 0; a
null id takes part and ranks last; rows that share id and text are one
document, of which ``drop_near_duplicates`` keeps one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, fresh, ship, stored
from stellate.llm.components import components

#: Bits of each segment, from the highest; any 6 - 2 = 4 differing bits leave two clean.
SEGMENTS, CLEAN = (11, 11, 11, 11, 10, 10), 2
BUDGET, SHINGLE, SEED = 4, 4, 42
#: Fingerprints of a piece of work, and trie bits of one step down in Spark.
LIMIT, STEP = 4096, 4


# ---- fingerprints ---------------------------------------------------------

def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of each k-word shingle (of all words, if fewer)."""
    words = (text or "").encode().lower().split()  # both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(k, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    spans = zip((end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``sizes`` hashes (none empty)."""
    # Four 16-bit counters fit a word, so runs are summed in parts of 65535.
    parts = -(-sizes // 65535)
    first = np.cumsum(parts) - parts
    inner = np.arange(int(parts.sum())) - np.repeat(first, parts)
    start = np.repeat(np.cumsum(sizes) - sizes, parts) + inner * 65535
    counts = np.empty((len(start), 64), np.int64)
    for b in range(16):
        s = np.add.reduceat((hashes >> np.uint64(b)) & np.uint64(0x0001000100010001), start)
        for j in range(4):
            counts[:, b + 16 * j] = (s >> np.uint64(16 * j)) & np.uint64(0xFFFF)
    bits = 2 * np.add.reduceat(counts, first, axis=0) > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(batch.num_rows, np.uint64)
        rows, hashes, held = [], [], 0
        for i, text in enumerate(batch.column("_text")):
            h = shingle_hashes(text.as_py(), k)
            if len(h):
                rows.append(i)
                hashes.append(h)
                held += len(h)
            if rows and (held > 200_000 or i == batch.num_rows - 1):
                out[rows] = majority(np.concatenate(hashes), np.array([len(x) for x in hashes]))
                rows, hashes, held = [], [], 0
        if rows:
            out[rows] = majority(np.concatenate(hashes), np.array([len(x) for x in hashes]))
        cols = [c for c in batch.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(out.view(np.int64))],
                                         [*cols, "fp"])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``rows`` with the text in ``_text`` replaced by its fingerprint ``fp``
    (the 64 bits as a signed long)."""
    ship(rows.sparkSession)
    kept = rows.drop("_text").schema
    return rows.mapInArrow(lambda it: _fingerprint_batches(it, shingle), kept.add("fp", "long"))


# ---- trie self-join -------------------------------------------------------

def _orders() -> list[list[int]]:
    """Orders of the segments: each choice of CLEAN segments, then the rest."""
    all_ = range(len(SEGMENTS))
    return [[*c, *(i for i in all_ if i not in c)] for c in combinations(all_, CLEAN)]


def _offsets(order: list[int]) -> tuple[dict[int, int], dict[int, int]]:
    """Lowest bit of each segment in the fingerprint and in the reordered one."""
    old, new, at = {}, {}, 64
    for i, w in enumerate(SEGMENTS):
        at -= w
        old[i] = at
    at = 64
    for i in order:
        at -= SEGMENTS[i]
        new[i] = at
    return old, new


def _reordered(fp: Column, order: list[int]) -> Column:
    old, new = _offsets(order)
    out = F.lit(0).cast("long")
    for i in order:
        seg = F.shiftrightunsigned(fp, old[i]).bitwiseAND((1 << SEGMENTS[i]) - 1)
        out = out.bitwiseOR(F.shiftleft(seg, new[i]))
    return out


def restore(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Fingerprints of reordered ones."""
    old, new = _offsets(order)
    out = np.zeros_like(values)
    for i in order:
        seg = (values >> np.uint64(new[i])) & np.uint64((1 << SEGMENTS[i]) - 1)
        out |= seg << np.uint64(old[i])
    return out


class Forest:
    """Union-find over the positions of an array, fed with many links at once."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_join(x: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, depth: np.ndarray,
              err: np.ndarray, budget: int, leaf: int = 64, block: int = 400_000) -> np.ndarray:
    """Roots that join all positions of ``x`` within the budget of each other.

    Piece k pairs the nodes x[lo:mid] and x[mid:hi], or x[lo:hi] with itself
    if mid == lo; ``depth`` bits of their paths are settled and ``err`` of
    those differ.  Each node's values are in ascending order.
    """
    forest, ones = Forest(len(x)), {}
    self_ = mid == lo
    todo = []
    for d in np.unique(depth):
        at = depth == d
        todo.append((int(d), lo[at], np.where(self_, hi, mid)[at], np.where(self_, lo, mid)[at], hi[at], err[at]))
    while todo:
        d, a0, a1, b0, b1, e = todo.pop()
        if len(a0) > block:
            half = len(a0) // 2
            todo += [(d, *(v[:half] for v in (a0, a1, b0, b1, e))), (d, *(v[half:] for v in (a0, a1, b0, b1, e)))]
            continue
        na, nb, same = a1 - a0, b1 - b0, a0 == b0
        live = (na > 0) & (nb > 0) & ~(same & (na < 2)) & (e <= budget)
        # All that is left may differ: every pair matches, so a star will do.
        full = live & (e + (64 - d) <= budget)
        for p, q, n in ((a0, a0, na), (a0, b0, nb)):
            _expand(forest, p[full], q[full], n[full])
        live &= ~full
        small = live & (na * nb <= leaf)
        _compare(forest, x, a0[small], na[small], b0[small], nb[small], budget)
        live &= ~small
        if not live.any():
            continue
        if d not in ones:
            bit = (x >> np.uint64(63 - d)) & np.uint64(1)
            ones[d] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        c = ones[d]
        a0, a1, b0, b1, e, same = (v[live] for v in (a0, a1, b0, b1, e, same))
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        other = ~same  # a node paired with itself has its mixed pair once
        todo.append((d + 1, np.concatenate([a0, am, a0, am[other]]), np.concatenate([am, a1, am, a1[other]]),
                     np.concatenate([b0, bm, bm, b0[other]]), np.concatenate([bm, b1, b1, bm[other]]),
                     np.concatenate([e, e, e + 1, e[other] + 1])))
    return forest.root


def _expand(forest: Forest, p: np.ndarray, q: np.ndarray, n: np.ndarray) -> None:
    if len(p):
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        forest.link(np.repeat(p, n), np.repeat(q, n) + inner)


def _compare(forest: Forest, x: np.ndarray, a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray,
             budget: int) -> None:
    """Compare all pairs of small nodes."""
    step = 20_000
    for k in range(0, len(a), step):
        s = slice(k, k + step)
        n = na[s] * nb[s]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(nb[s], n)
        i, j = np.repeat(a[s], n) + inner // width, np.repeat(b[s], n) + inner % width
        near = (np.bitwise_count(x[i] ^ x[j]) <= budget) & (i != j)
        forest.link(i[near], j[near])


def _links(batches: Iterator[pa.RecordBatch], budget: int, rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Forest links of each piece of work; the rows of a piece follow each other."""
    orders, keys, held = _orders(), ("ord", "depth", "a", "b"), None
    for batch in batches:
        part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "err", "v")}
        held = part if held is None else {c: np.concatenate([held[c], part[c]]) for c in part}
        n = len(held["v"])
        if n < rows:
            continue
        new = np.logical_or.reduce([held[c][1:] != held[c][:-1] for c in keys])
        last = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
        if last:
            yield from _join_pieces({c: v[:last] for c, v in held.items()}, orders, keys, budget)
            held = {c: v[last:] for c, v in held.items()}
    if held is not None and len(held["v"]):
        yield from _join_pieces(held, orders, keys, budget)


def _join_pieces(part: dict, orders: list, keys: tuple, budget: int) -> Iterator[pa.RecordBatch]:
    x = part["v"].view(np.uint64)
    new = np.concatenate([[True], np.logical_or.reduce([part[c][1:] != part[c][:-1] for c in keys])])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(x))
    depth = part["depth"][lo].astype(np.int64)
    # A piece of two nodes has those of the lower node first.
    upper = (x >> (np.uint64(64) - part["depth"].astype(np.uint64))).view(np.int64) != part["a"]
    mid = np.where(part["a"][lo] == part["b"][lo], lo, hi - np.add.reduceat(upper.astype(np.int64), lo))
    root = trie_join(x, lo, mid, hi, depth, part["err"][lo].astype(np.int64), budget)
    i = np.flatnonzero(root != np.arange(len(x)))
    u, v = np.empty(len(i), np.uint64), np.empty(len(i), np.uint64)
    for k, order in enumerate(orders):
        at = part["ord"][i] == k
        u[at], v[at] = restore(x[i[at]], order), restore(x[root[i[at]]], order)
    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def hamming_links(distinct: DataFrame, *, budget: int = BUDGET, limit: int = LIMIT) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of the distinct
    fingerprints ``fp`` that differ in at most ``budget`` bits."""
    if budget > len(SEGMENTS) - CLEAN:
        raise ValueError("the budget must leave enough clean segments")
    ship(distinct.sparkSession)
    tries = distinct.select(F.inline(F.array(*[
        F.struct(F.lit(k).cast("byte").alias("ord"), _reordered(F.col("fp"), o).alias("v"))
        for k, o in enumerate(_orders())])))
    leads = F.create_map(*[F.lit(x) for k, o in enumerate(_orders())
                           for x in (k, sum(SEGMENTS[i] for i in o[:CLEAN]))])
    tries = tries.withColumn("depth", leads[F.col("ord").cast("int")])


    tries = tries.withColumn("a", F.expr("shiftrightunsigned(v, 64 - depth)"))
    sizes = tries.groupBy("ord", "depth", "a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    nodes = stored(sizes, "trie-nodes")[0]
    fit = nodes.filter(F.col("n") <= limit)
    work = [tries.join(fit.select("ord", "a"), ["ord", "a"], "left_semi")
            .select("ord", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("err"), "v")]
    # Large nodes: pairs of nodes further down, with their differing bits.
    front = nodes.filter(F.col("n") > limit).select(
        "ord", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("err"))
    if not front.isEmpty():
        deep = stored(tries.join(front.select("ord", "a"), ["ord", "a"], "left_semi")
                      .select("ord", "depth", "v"), "trie-large")[0]
        down = 0
        while not front.isEmpty():
            down += STEP
            now = F.expr(f"least(depth + {down}, 64)")
            below = (deep.select("ord", "depth", F.expr(f"shiftrightunsigned(v, 64 - depth - {down - STEP})").alias("up"),
                                 F.expr(f"shiftrightunsigned(v, greatest(64 - depth - {down}, 0))").alias("low"))
                     .groupBy("ord", "depth", "up", "low").agg(F.count(F.lit(1)).alias("n")))
            below = stored(below, "trie-below")[0]
            one = below.select("ord", F.col("up").alias("a"), F.col("low").alias("x"), F.col("n").alias("nx"))
            two = below.select("ord", F.col("up").alias("b"), F.col("low").alias("y"), F.col("n").alias("ny"))
            pairs = (front.join(one, ["ord", "a"]).join(two, ["ord", "b"])
                     .filter("a <> b OR x <= y")
                     .withColumn("err", F.expr("bit_count(x ^ y)").cast("int"))
                     .filter((F.col("err") <= budget) & F.expr("x <> y OR nx > 1")))
            pairs = stored(pairs.select("ord", "depth", F.col("x").alias("a"), F.col("y").alias("b"), "err",
                                        "nx", "ny"), "trie-pairs")[0]
            ok = F.when(F.col("a") == F.col("b"), F.col("nx")).otherwise(F.col("nx") + F.col("ny")) <= limit
            ok = ok | (F.col("depth") + down >= 64)
            at = deep.select("ord", F.expr(f"shiftrightunsigned(v, greatest(64 - depth - {down}, 0))").alias("node"), "v")
            ready = pairs.filter(ok).select("ord", now.alias("depth"), "a", "b", "err")
            sides = ready.withColumn("node", F.explode(F.expr("array_distinct(array(a, b))")))
            work.append(sides.join(at, ["ord", "node"]).select("ord", "depth", "a", "b", "err", "v"))
            front = pairs.filter(~ok).select("ord", "depth", "a", "b", "err")
    rows = work[0]
    for more in work[1:]:
        rows = rows.unionByName(more)
    keys = ["ord", "depth", "a", "b"]
    return (rows.repartition(*keys).sortWithinPartitions(*keys, "v")
            .mapInArrow(lambda it: _links(it, budget), "u long, v long"))


# ---- documents ------------------------------------------------------------

def row_key(ident: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("-")), F.lit("\u0000"),
                                  F.coalesce(text, F.lit(""))).cast("binary")))


def _classes(marked: DataFrame, budget: int, limit: int) -> DataFrame:
    """(fp, first): for each fingerprint the first row of its component, of a
    table of rows (fp, me), where ``me`` orders rows."""
    distinct = stored(marked.groupBy("fp").agg(F.min("me").alias("me")), "fingerprints")[0]
    roots = components(hamming_links(distinct.select("fp"), budget=budget, limit=limit))
    to = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    to = stored(to, "classes")[0]
    first = to.groupBy("root").agg(F.min("me").alias("first"))
    return to.select("fp", "root").join(first, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    budget: int = BUDGET, limit: int = LIMIT) -> DataFrame:
    """(id, fp, component_id) of every row of ``docs``; the component is named
    by its smallest id (null if none of its rows has one)."""
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    marked = stored(fingerprints(rows, shingle), "simhash")[0]
    me = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    first = _classes(marked.select("fp", me.alias("me")), budget, limit)
    return marked.join(first, "fp").select(F.col("_id").alias(id_col), "fp",
                                           F.col("first.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, budget: int = BUDGET, limit: int = LIMIT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.
    Of rows that share id and text, the one whose other columns (maps aside)
    are least stays, so that reruns agree."""
    key = row_key(col(id_col), col(text_col))
    rows = docs.select(col(id_col).alias("_id"), key.alias("key"), col(text_col).alias("_text"))
    marked = stored(fingerprints(rows, shingle), "simhash")[0]
    me = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "key")
    first = _classes(marked.select("fp", me.alias("me")), budget, limit)
    mine = fresh("_key", docs.columns)
    stay = stored(first.select(F.col("first.key").alias(mine)).distinct(), "stay")[0]
    others = [f.name for f in docs.schema if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
    row = F.struct(*[col(c) for c in docs.columns])
    least = F.min_by(row, F.struct(*[col(c) for c in others])) if others else F.first(row)
    return (docs.withColumn(mine, key).join(stay, mine, "left_semi").groupBy(mine).agg(least.alias("row"))
            .select("row.*"))
