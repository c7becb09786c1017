"""SimHash classes against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from stellate.llm import simhash as S

from llm_fixtures import make  # noqa: F401

AWKWARD = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, " \n\t"), (6, "one"), (7, "ONE"),
           (8, "É b"), (9, "é b"), (None, "a b c d e f"), (None, "lonely words here now"), (1, "a b c d e f"),
           (11, "x " * 70000)]


def fingerprint(text):
    words = (text or "").encode().lower().split()
    k = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(values, budget):
    """Smallest position that each value reaches."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def clusters(n, seed=0):
    """Values of which many are a few bits from another one."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 2**64, n // 4, dtype=np.uint64)]
    while len(out) < n:
        v = out[rng.integers(len(out))]
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            v ^= 1 << int(b)
        out.append(v)
    return sorted(set(out))


def test_majority_of_long_runs():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 70000, 3, 131071])
    h = rng.integers(0, 2**64, sizes.sum(), dtype=np.uint64)
    got, at = S.majority(h, sizes), 0
    for fp, n in zip(got, sizes):
        bits = [2 * int(((h[at:at + n] >> np.uint64(b)) & np.uint64(1)).sum()) > n for b in range(64)]
        assert int(fp) == sum(1 << b for b in range(64) if bits[b])
        at += n


@pytest.mark.parametrize("leaf", [1, 64])
def test_trie_join_matches_all_pairs(leaf):
    x = np.array(clusters(600), np.uint64)
    zero = np.zeros(1, np.int64)
    root = S.trie_join(x, zero, zero, zero + len(x), zero, zero, 4, leaf=leaf, block=1000)
    want = brute([int(v) for v in x], 4)
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(int(r), set()).add(i)
    assert sorted(map(min, groups.values())) == sorted(set(want))
    assert all(want[i] == min(g) for g in groups.values() for i in g)


@pytest.mark.parametrize("limit", [4096, 1, 3])
def test_links_join_all_pairs(spark, limit):
    # A third of the values share their leading bits, so nodes are split.
    near = [0xABCDEF0123456789 ^ (1 << a) ^ (1 << b) for a in range(0, 20, 3) for b in range(30, 60, 7)]
    x = sorted(set(clusters(200, 3)) | set(near) | {0, 2**64 - 1, 2**63})
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in x], "fp long").repartition(3)
    got = {r.node: r.root for r in S.components(S.hamming_links(df, limit=limit)).collect()}
    signed = [v - 2**64 if v >= 2**63 else v for v in x]
    want, groups = brute(x, 4), {}
    for i, w in enumerate(want):
        groups.setdefault(w, []).append(signed[i])
    assert got == {v: min(g) for g in groups.values() for v in g if v != min(g)}


def test_documents(make):
    docs = make(AWKWARD, "fp", "first", "key", "n")
    rows = S.near_duplicates(docs).collect()
    assert len(rows) == len(AWKWARD)
    fps = sorted((r.doc_id is None, r.doc_id or 0, r.fp % 2**64) for r in rows)
    assert fps == sorted((i is None, i or 0, fingerprint(t)) for i, t in AWKWARD)
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[2] == by_id[1] == 1 and by_id[4] == by_id[5] == by_id[3] == 3 and by_id[7] == 6
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(
        {r.component_id for r in rows if r.component_id is not None})
    assert [r.text for r in got if r.doc_id is None] == ["lonely words here now"]


def test_least_of_rows_that_share_id_and_text(make):
    rows = [(1, "one two three four five", "en", s) for s in ("c", "b", "a", "d")] + [(2, "another text with some words", "fr", "z")]
    for part in (rows, rows[::-1]):
        docs = make(part, "row").repartition(4)
        got = S.drop_near_duplicates(docs)
        assert got.columns == docs.columns
        assert sorted((r.doc_id, r.source) for r in got.collect()) == [(1, "a"), (2, "z")]
    bare = make(rows).select("doc_id", "text")
    assert sorted(r.doc_id for r in S.drop_near_duplicates(bare).collect()) == [1, 2]


def test_empty(make):
    docs = make([(1, "a")]).limit(0)
    assert S.near_duplicates(docs).count() == 0
    assert S.drop_near_duplicates(docs).count() == 0
