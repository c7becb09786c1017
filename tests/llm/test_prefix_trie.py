"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.llm import prefix_trie as pt

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def rebuilt(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    for c in convs:
        convs[c] = [(r, x) for _, _, r, x in sorted(convs[c])]
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    rows = []
    for node in sorted(members, key=len, reverse=True):
        pass
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(convs[c]) == len(node))))
        rows.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                     len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(spark, rows, chunk=4096, df=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4) if df is None else df
    convs = df.where("conv_id IS NOT NULL").select(F.col("conv_id").alias("conv")).distinct()
    t = pt.prefix_trie(pt.rebuilt(pt.numbered_turns(df), convs), convs, chunk=chunk)
    out = t.nodes.alias("v").join(pt.ends_digest(t).alias("e"), F.expr("v.digest = e.digest"), "left").select(
        "v.conv", "v.depth", "v.parent_conv", "v.n_convs", "v.n_children", "v.n_leaves", "v.weight",
        F.coalesce("e.ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return sorted(map(tuple, out.collect()), key=str)


def make_rows(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for c in range(0, 2 * n, 1 + seed % 2):
        for t in range(rng.randrange(1, most)):
            turn = None if rng.random() < 0.05 else rng.choice([t, t, t + 3])
            rows.append((c, turn, rng.choice(["user", "assistant", "", None]), rng.choice(["a", "bé", "", None, "a", "ccc"])))
    return rows + [(None, 1, "user", "x")] * 3


@pytest.mark.parametrize("seed,most", [(1, 12), (2, 5)])
def test_against_dictionaries(spark, seed, most):
    rows = make_rows(seed, 80, most)
    assert found(spark, rows) == trie(rebuilt(rows))


@pytest.mark.parametrize("chunk", [1, 4])
def test_chunks_change_nothing(spark, chunk):
    rows = make_rows(3, 30, 25)
    assert found(spark, rows, chunk) == trie(rebuilt(rows))


def test_hot_first_turn_and_copies(spark):
    """A third of all conversations share a first turn, many are copies."""
    rows = [(c, t, "user", f"t{t}" if c % 3 == 0 else f"{c % 7}.{t}") for c in range(400) for t in range(4)]
    assert found(spark, rows) == trie(rebuilt(rows))


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    # A conversation whose own turns all come before its turn h and whose base is absent.
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert found(spark, rows) == trie(rebuilt(rows)) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_clashing_names(spark):
    rows = make_rows(4, 10, 6)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS idx", "3 AS depth", "4 AS digest")
    assert found(spark, rows, df=df) == trie(rebuilt(rows))


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2 ** 63, size=(20_000, 2), dtype=np.uint64)
    table = pt.SlotTable(keys)
    assert sorted(table.lookup(keys)) == list(range(len(keys)))
    assert (table.lookup(rng.integers(0, 2 ** 63, size=(1000, 2), dtype=np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        pt.SlotTable(np.concatenate([keys[:3], keys[:1]]))


def test_shards_are_cut_between_chunks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pt, "SHARD", 10)
    conv = np.repeat(np.arange(20), 7)
    batches = [pa.RecordBatch.from_arrays([pa.array(conv[i:i + 9]), pa.array(conv[i:i + 9] * 0)], names=["conv", "chunk"])
               for i in range(0, len(conv), 9)]
    shards = [t.column("conv").to_pylist() for t in pt._shards(batches)]
    assert sum(shards, []) == conv.tolist() and len(shards) > 5
    assert all(a[-1] != b[0] for a, b in zip(shards, shards[1:]))
