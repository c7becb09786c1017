"""The trie of all conversations' prefixes, as flat node tables.

A node is a distinct sequence of first turns (role and text); the root is the
empty one.  Its members are the conversations that begin with it.

Method.  Each turn has a digest (SHA-256 of its role's length, role and text),
and a prefix the digest ``P * B + turn`` modulo 2^127 - 1 of the prefix before it,
which can be carried over the chunks of a long conversation.  A table of turns
(no texts) is dealt by conversation and chunk; each task cuts it into shards of at
most ``SHARD`` turns.  In a shard the distinct digests are enumerated and given
slots 0, 1, 2, ... by a minimal perfect hash: a level of bits keeps the digests
that hash to a bit alone, the others go on to the next level, and a slot is the
rank of the digest's bit.  The digest stored at a slot is compared with the one
looked up, so a foreign digest or a collision is found, not counted.

1. Counts are scattered into flat arrays by slot: members, least conversation,
   and what a node must agree on (depth, parent, last turn).  Shards' nodes are
   merged by digest; a node whose prefixes differ in any of these stops the job,
   so two prefixes never share a node unseen.
2. A node is owned by its least member.  Owned nodes' weights, (members - 1) x
   bytes of the last turn, and leaf marks are scattered into the arrays of the
   owner's shard, and accumulated through the parent-slot array in order of
   depth, deepest first.  As an owner's whole path lies in its shard, each node
   gets its subtree's share from every shard, and the merged sums are exact.
   What later chunks of a conversation hold is added at the last turn of a chunk.

So neither a first turn nor a conversation that holds a third of all rows meets in
one task: shards are pieces of the input, merges are sums with a map-side part.
Children of a node get its id by a join in which nodes with more than a 10,000th
of all children are broadcast (there are fewer than 10,000 of those).  The ids
that end in a node are put in order by range, joined to pieces in many tasks, and
the pieces hashed as they come.

Defined results: turns in order of turn number (nulls first), then role, then
text; null role or text: empty; rows without a conversation id belong to none and
are left out; repeated rows are turns of their own; a conversation without turns
is a member of the root; an empty table has no node.  Texts are read whole.  SQL
can't carry the digests; the tests compare with plain dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, partitions, ship, stored
from stellate.llm.conversations import CHUNK, hashed_in_order, ordered_turns, same

#: Turns that a shard's arrays hold, about.
SHARD = 1 << 17
MODULUS = (1 << 127) - 1
BASE = 0x3B9A_F1C5_72D6_84E9_0D1C_5AB7_93F2_6E41
ROOT = (1).to_bytes(16, "big")
#: Nodes with more than this share of all children are told to them by broadcast.
HOT_SHARE = 10_000
#: Bytes of a piece of joined ids.
PIECE = 1 << 16


class SlotTable:
    """Minimal perfect hash of distinct 16-byte digests, given as (n, 2) uint64.

    ``lookup`` gives each digest's slot, -1 for one that isn't in the table."""

    LOAD = 2                             # bits a digest in a level

    def __init__(self, keys: np.ndarray):
        self.levels = []
        left, base = keys, 0
        while len(left):
            if len(self.levels) == 256:
                raise ValueError("digests are not distinct")
            size = self.LOAD * len(left) + 1
            at = self._hash(left, len(self.levels), size)
            count = np.bincount(at, minlength=size)
            alone = count == 1
            self.levels.append((size, alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros_like(keys)
        slots = self._slots(keys)
        self.keys[slots] = keys
        # Verified: every slot taken once, each digest found where it was put.
        if len(np.unique(slots)) != len(keys) or not np.array_equal(self.keys[slots], keys):
            raise ValueError("digests are not distinct")

    @staticmethod
    def _hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xBF58476D1CE4E5B9 * (level + 1) % 2 ** 64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = self._hash(keys[open_], level, size)
            hit = alone[at]
            found[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return found

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        ok = slots >= 0
        ok[ok] = (self.keys[slots[ok]] == keys[ok]).all(1)
        return np.where(ok, slots, -1)


def _pairs(column) -> np.ndarray:
    """16-byte values as (n, 2) uint64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 2), dtype="<u8")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]].copy().view("<u8").reshape(-1, 2)


def _binary(pairs: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(pairs).astype("<u8").tobytes()
    return pa.array([data[i:i + 16] for i in range(0, len(data), 16)], pa.binary())


def _distinct(keys: np.ndarray) -> np.ndarray:
    return np.unique(np.ascontiguousarray(keys).view([("a", "<u8"), ("b", "<u8")]).ravel()).view("<u8").reshape(-1, 2)


def _chunk_ends(batches):
    """Digests of whole chunks, begun at 0: (conv, chunk, end)."""
    now, value, convs, chunks, ends = None, 0, [], [], []
    for batch in batches:
        conv, chunk = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, t in enumerate(batch.column(2)):
            if (conv[i], chunk[i]) != now:
                if now is not None:
                    convs.append(now[0]), chunks.append(now[1]), ends.append(value.to_bytes(16, "big"))
                now, value = (conv[i], chunk[i]), 0
            value = (value * BASE + int.from_bytes(t.as_buffer(), "big")) % MODULUS
    if now is not None:
        convs.append(now[0]), chunks.append(now[1]), ends.append(value.to_bytes(16, "big"))
    yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(chunks, pa.int64()), pa.array(ends, pa.binary())],
                                     names=["conv", "chunk", "end"])


def _carries(table: pa.Table, size: int) -> pa.Table:
    """The digest before each chunk but the first of one conversation."""
    table = table.sort_by("chunk")
    value, carry, power = 1, [], pow(BASE, size, MODULUS)
    for end in table.column("end").to_pylist():
        value = (value * power + int.from_bytes(end, "big")) % MODULUS
        carry.append(value.to_bytes(16, "big"))
    return pa.table({"conv": table.column("conv"), "chunk": pc.add(table.column("chunk"), 1),
                     "carry": pa.array(carry, pa.binary())})


def _digests(batches):
    """(conv, chunk, depth, turn, bytes, carry) in order -> with the digests of
    each prefix and of its parent."""
    now, value = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, chunk = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        digest, parent = [], []
        for i, (turn, carry) in enumerate(zip(batch.column(3), batch.column(5))):
            if (conv[i], chunk[i]) != now:
                now = (conv[i], chunk[i])
                value = int.from_bytes(carry.as_buffer(), "big") if carry.is_valid else 1
            parent.append(value.to_bytes(16, "big"))
            value = (value * BASE + int.from_bytes(turn.as_buffer(), "big")) % MODULUS
            digest.append(value.to_bytes(16, "big"))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(5)), pa.array(digest, pa.binary()), pa.array(parent, pa.binary())],
            names=["conv", "chunk", "depth", "turn", "bytes", "digest", "parent"])


def _shards(batches):
    """Batches joined to tables of about ``SHARD`` rows, cut only between chunks
    of a conversation."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < SHARD:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        conv, chunk = (table.column(n).to_numpy() for n in ("conv", "chunk"))
        cut = np.flatnonzero((conv[1:] != conv[:-1]) | (chunk[1:] != chunk[:-1]))
        if not len(cut):
            continue
        at = int(cut[-1]) + 1
        yield table.slice(0, at)
        held, rows = table.slice(at).to_batches(), table.num_rows - at
    if rows:
        yield pa.Table.from_batches(held)


class Shard:
    """A shard's distinct digests in their slots; the slot of every row."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.table = table
        keys = _pairs(table.column("digest"))
        self.slots = SlotTable(_distinct(keys))
        self.at = self.slots.lookup(keys)
        self.size = len(self.slots.keys)
        # One row that stands for each slot.
        self.row = np.zeros(self.size, dtype=np.int64)
        self.row[self.at] = np.arange(len(keys))

    def column(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()


def _counted(batches):
    """Turns -> the nodes of each shard with their members."""
    for table in _shards(batches):
        s = Shard(table)
        conv = s.column("conv")
        members = np.zeros(s.size, dtype=np.int64)
        np.add.at(members, s.at, 1)
        least = np.full(s.size, np.iinfo(np.int64).max)
        np.minimum.at(least, s.at, conv)
        pick = pa.array(s.row)
        yield pa.RecordBatch.from_arrays(
            [_binary(s.slots.keys), table.column("parent").combine_chunks().take(pick),
             table.column("depth").combine_chunks().take(pick), table.column("turn").combine_chunks().take(pick),
             table.column("bytes").combine_chunks().take(pick), pa.array(members), pa.array(least)],
            names=["digest", "parent", "depth", "turn", "bytes", "n", "least"])


def _accumulated(batches, size: int):
    """Turns with what their owned nodes weigh -> each shard's share of the sums
    over subtrees."""
    for table in _shards(batches):
        s = Shard(table)
        depth = s.column("depth")[s.row]
        weight, leaves = np.zeros(s.size, dtype=np.int64), np.zeros(s.size, dtype=np.int64)
        np.add.at(weight, s.at, s.column("weight"))
        np.add.at(leaves, s.at, s.column("leaf"))
        # A chunk's first nodes have no parent in the shard; what they sum up to
        # reaches the turns before by the chunk's rest (see ``rests``).
        parent = s.slots.lookup(_pairs(table.column("parent").combine_chunks().take(pa.array(s.row))))
        parent[(depth - 1) % size == 0] = -1
        order = np.argsort(-depth, kind="stable")
        ends = np.flatnonzero(np.diff(depth[order])) + 1
        for level in np.split(order, ends):
            level = level[parent[level] >= 0]
            np.add.at(weight, parent[level], weight[level])
            np.add.at(leaves, parent[level], leaves[level])
        some = (weight != 0) | (leaves != 0)
        yield pa.RecordBatch.from_arrays([_binary(s.slots.keys[some]), pa.array(weight[some]), pa.array(leaves[some])],
                                         names=["digest", "weight", "leaves"])


def _joined_ids(batches):
    """(key, id) in order -> pieces of ids joined by commas."""
    names = ["digest", "first", "piece"]

    def batch_of(out):
        keys, firsts, pieces = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()),
                                           pa.array(pieces, pa.string())], names=names)

    now, first, held, length = None, None, [], 0
    for batch in batches:
        out = []
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (k != now or length > PIECE):
                out.append((now, first, ",".join(held)))
                held, length = [], 0
            if not held:
                now, first = k, i
            held.append(str(i))
            length += len(held[-1]) + 1
        yield batch_of(out)
    if held:
        yield batch_of([(now, first, ",".join(held))])


@dataclass
class Trie:
    """``nodes``: digest, parent, depth, conv (least member), parent_conv,
    n_convs, n_children, n_leaves, weight (sum over the subtree of (members - 1)
    times bytes).  ``ends``: (conv, digest), where each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def turn_digest(role: Column, text: Column) -> Column:
    """A turn as 120 bits of its SHA-256, in 16 bytes."""
    body = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.lit("00"), F.substring(F.sha2(body.cast("binary"), 256), 1, 30)))


def numbered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv, idx, turn digest, bytes of the text): the turns of every
    conversation in order, without their texts."""
    clean = rows.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    out = ordered_turns(clean, "conv", ["turn", "role", "text"], {
        "turn": turn_digest(F.col("role"), F.col("text")), "bytes": F.octet_length("text").cast("long")}, "trie-turns")
    return stored(out, "trie-order")[0]


def rebuilt(turns: DataFrame, convs: DataFrame, span: int = 5, folds: int = 9) -> DataFrame:
    """(conv, depth, turn, bytes): each conversation c with its first h turns
    taken from conversation c - c % span, where h = crc32(c) % folds; turns of
    its own follow from its turn h on.  A turn goes to at most ``span``
    conversations."""
    def h(c: Column) -> Column:
        return F.crc32(c.cast("string").cast("binary")) % folds

    own = convs.alias("c")
    base = turns.where((F.col("idx") < folds - 1) & (F.col("conv") % span == 0)).select(
        F.explode(F.sequence(F.col("conv") - (span - 1), F.col("conv") + (span - 1))).alias("target"),
        F.col("conv").alias("source"), "idx", "turn", "bytes")
    base = base.where((F.col("idx") < h(F.col("target")))
                      & (F.col("target") - F.col("target") % span == F.col("source"))).alias("b")
    taken = base.join(own, F.col("b.target") == F.col("c.conv"), "left_semi").select(
        F.col("target").alias("conv"), (F.col("idx") + 1).alias("depth"), "turn", "bytes")
    taken = stored(taken, "trie-taken")[0]
    given = taken.groupBy("conv").agg(F.max("depth").alias("given")).alias("g")
    rest = (turns.where(F.col("idx") >= h(F.col("conv"))).alias("t").join(given, same("t", "g", ["conv"]), "left")
            .select("t.conv", (F.col("t.idx") - h(F.col("t.conv")) + F.coalesce("g.given", F.lit(0)) + 1).alias("depth"),
                    "t.turn", "t.bytes"))
    return taken.unionByName(rest)


def prefix_trie(turns: DataFrame, convs: DataFrame, chunk: int = CHUNK) -> Trie:
    """The trie of ``turns`` (conv, depth from 1 without gaps, turn, bytes) of
    the conversations ``convs`` (conv)."""
    spark = turns.sparkSession
    ship(spark)
    n = partitions(spark)
    cut = stored(turns.select("conv", F.floor((F.col("depth") - 1) / chunk).cast("long").alias("chunk"),
                              F.col("depth").cast("long").alias("depth"), "turn", "bytes"), "trie-cut")[0]
    # Digests before the chunks of conversations that have several.
    more = cut.where("chunk > 0").groupBy("conv").agg(F.max("chunk").alias("last")).alias("m")
    whole = (cut.alias("t").join(more, F.col("t.conv") == F.col("m.conv")).where("t.chunk < m.last")
             .select("t.conv", "t.chunk", "t.depth", "t.turn")
             .repartition(n, "conv", "chunk").sortWithinPartitions("conv", "chunk", "depth").select("conv", "chunk", "turn"))
    carries = (whole.mapInArrow(_chunk_ends, "conv long, chunk long, end binary")
               .groupBy("conv").applyInArrow(lambda t: _carries(t, chunk), "conv long, chunk long, carry binary"))
    dealt = (cut.alias("t").join(carries.alias("k"), same("t", "k", ["conv", "chunk"]), "left")
             .select("t.*", "k.carry").repartition(n, "conv", "chunk").sortWithinPartitions("conv", "chunk", "depth"))
    turns = stored(dealt.mapInArrow(
        _digests, "conv long, chunk long, depth long, turn binary, bytes long, digest binary, parent binary"),
        "trie-digests")[0]
    in_order = ["conv", "chunk", "depth"]

    # 1. Nodes, merged over the shards by digest.
    parts = turns.repartition(n, "conv", "chunk").sortWithinPartitions(*in_order).mapInArrow(
        _counted, "digest binary, parent binary, depth long, turn binary, bytes long, n long, least long")
    told = F.struct("parent", "depth", "turn", "bytes")
    merged = parts.groupBy("digest").agg(F.sum("n").alias("n_convs"), F.min("least").alias("conv"),
                                         F.min(told).alias("told"), F.max(told).alias("other"))
    clash = F.raise_error(F.lit("two prefixes share a digest")).cast("long")
    nodes = stored(merged.select(
        "digest", "told.*", "conv", F.when(F.col("told") == F.col("other"), F.col("n_convs")).otherwise(clash)
        .alias("n_convs")), "trie-nodes")[0]
    children = stored(nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
                      .withColumnRenamed("parent", "digest"), "trie-children")[0]
    counted = nodes.alias("v").join(children.alias("k"), F.col("v.digest") == F.col("k.digest"), "left").select(
        "v.*", F.coalesce("k.n_children", F.lit(0)).cast("long").alias("n_children"))
    counted = stored(counted, "trie-counted")[0]

    # 2. Weights and leaves go to the owner's turns; each (conv, depth) is one row on either side.
    owned = counted.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight"),
                           F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf")).alias("o")
    zero = F.lit(0).cast("long")
    weighed = turns.alias("t").join(owned, same("t", "o", ["conv", "depth"]), "left").select(
        "t.conv", "t.chunk", "t.depth", "t.digest", "t.parent", F.coalesce("o.weight", zero).alias("weight"),
        F.coalesce("o.leaf", zero).alias("leaf"))
    weighed = stored(weighed, "trie-weighed")[0]
    rests = _rests(weighed, more, chunk)
    full = (weighed.alias("t").join(rests.alias("r"), same("t", "r", ["conv", "depth"]), "left")
            .select("t.conv", "t.chunk", "t.depth", "t.digest", "t.parent",
                    (F.col("t.weight") + F.coalesce("r.weight", zero)).alias("weight"),
                    (F.col("t.leaf") + F.coalesce("r.leaf", zero)).alias("leaf")))
    shares = full.repartition(n, "conv", "chunk").sortWithinPartitions(*in_order).mapInArrow(
        partial(_accumulated, size=chunk), "digest binary, weight long, leaves long")
    sums = shares.groupBy("digest").agg(F.sum("weight").alias("weight"), F.sum("leaves").alias("n_leaves")).alias("s")
    summed = counted.alias("v").join(sums, F.col("v.digest") == F.col("s.digest"), "left").select(
        "v.digest", "v.parent", "v.depth", "v.conv", "v.n_convs", "v.n_children",
        F.coalesce("s.n_leaves", zero).alias("n_leaves"), F.coalesce("s.weight", zero).alias("weight"))
    root = _root(convs, children, counted)
    every = stored(summed.unionByName(root), "trie-summed")[0]

    last = turns.groupBy("conv").agg(F.max(F.struct("depth", "digest")).alias("e")).select("conv", "e.digest").alias("l")
    ends = convs.alias("c").join(last, F.col("c.conv") == F.col("l.conv"), "left").select(
        "c.conv", F.coalesce("l.digest", F.lit(bytearray(ROOT))).alias("digest"))
    return Trie(_with_parents(every), ends)


def _rests(weighed: DataFrame, more: DataFrame, chunk: int) -> DataFrame:
    """(conv, depth, weight, leaf): for the last turn of each chunk but a
    conversation's last, what its owner has in the chunks behind it."""
    from pyspark.sql import Window

    sums = (weighed.alias("t").join(more.alias("m"), F.col("t.conv") == F.col("m.conv"), "left_semi")
            .groupBy("conv", "chunk").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf")))
    behind = Window.partitionBy("conv").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (sums.select("conv", ((F.col("chunk") + 1) * chunk).alias("depth"), F.sum("weight").over(behind).alias("weight"),
                        F.sum("leaf").over(behind).alias("leaf"))
            .where("weight IS NOT NULL"))


def _root(convs: DataFrame, children: DataFrame, counted: DataFrame) -> DataFrame:
    """The root's row, or none without a conversation (three rows of sums are
    collected)."""
    members = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).first()
    below = children.where(F.col("digest") == F.lit(bytearray(ROOT))).agg(F.max("n_children").alias("n")).first()
    sums = counted.agg(F.count_if(F.col("n_children") == 0).alias("leaves"),
                       F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("weight")).first()
    row = (bytearray(ROOT), None, 0, members["conv"], members["n"], below["n"] or 0, max(1, sums["leaves"]),
           sums["weight"] or 0)
    return counted.sparkSession.createDataFrame(
        [row] if members["n"] else [], "digest binary, parent binary, depth long, conv long, n_convs long, "
        "n_children long, n_leaves long, weight long")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds ``parent_conv``.  A node is hot with more than a 10,000th of all
    children, so fewer than 10,000 nodes are broadcast; a shuffle tells the
    children of the others."""
    total = nodes.agg(F.sum("n_children").alias("n")).first()["n"] or 0
    is_hot = F.col("n_children") * HOT_SHARE > total
    ids = nodes.where("n_children > 0").select(
        F.col("digest").alias("parent"), F.col("conv").alias("parent_conv"), is_hot.alias("hot"))
    told = nodes.alias("v").join(F.broadcast(ids.where("hot").alias("h")), F.col("v.parent") == F.col("h.parent"),
                                 "left").select("v.*", "h.parent_conv")
    told = stored(told, "trie-told")[0]
    cold = told.where("parent_conv IS NULL AND parent IS NOT NULL").drop("parent_conv").alias("v")
    rest = cold.join(ids.where("NOT hot").alias("h"), F.col("v.parent") == F.col("h.parent")).select(
        "v.*", "h.parent_conv")
    return told.where("parent_conv IS NOT NULL OR parent IS NULL").unionByName(rest)


def ends_digest(trie: Trie) -> DataFrame:
    """(digest, ends_sha256): the SHA-256 of the ids of the conversations that
    end in a node, ascending, joined by commas."""
    spark = trie.ends.sparkSession
    schema = "digest binary, first long, piece string"
    pieces = (trie.ends.select("digest", "conv").repartitionByRange(partitions(spark), "digest", "conv")
              .sortWithinPartitions("digest", "conv").mapInArrow(_joined_ids, schema))
    return hashed_in_order(pieces, "digest", ["first"], "piece", ",", "ends_sha256")
