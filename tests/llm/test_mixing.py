"""Targets by hand, and samples by their promises."""

import pytest

from stellate.llm import mixing

from llm_fixtures import make  # noqa: F401


def by_hand(sizes):
    """Reshare by weight until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else weight[s] * left / free for s in names}
        over = {s for s in names if s not in full and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        full |= over


def rows():
    out = [(i, "w " * (i % 17), "en", f"s{i % 5}") for i in range(900)]
    out += [(1000 + i, "tiny word", "en", "a" if i else None) for i in range(4)]
    out += [(2000, "x " * 900, "en", "S"), (2001, None, "en", "S"), (2002, "", "en", "empty"), (3, "w w", "en", "s3"),
            (None, "no id here", "en", "s1"), (None, "no id here", "en", "s1"), (5, "é ö", "en", "é"), (5, "é ö", "en", "é")]
    return out


def test_targets_and_samples(make):
    docs = make(rows(), "size", "copies", "p", "w", "key")
    got = mixing.mix_sources(docs, names=("n", "total", "goal", "times", "words")).collect()
    assert len(got) == len(rows())
    sizes = {}
    for _, t, _, s in rows():
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = by_hand(sizes)
    taken, largest = {}, {}
    for r in got:
        assert r.n == len((r.text or "").split()) and r.total == sizes[r.source]
        assert r.goal == pytest.approx(want[r.source])
        assert 0 <= r.times <= 3 and r.words == r.times * r.n
        taken[r.source] = taken.get(r.source, 0) + r.words
        largest[r.source] = max(largest.get(r.source, 0), r.n)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    assert all(abs(taken[f"s{i}"] - want[f"s{i}"]) <= 2 for i in range(5))  # sizes to choose from
    light = mixing.mix_sources(docs, carry=["doc_id"], names=("n", "total", "goal", "times", "words")).collect()
    assert sorted((str(r.doc_id), r.n, r.times) for r in light) == sorted((str(r.doc_id), r.n, r.times) for r in got)


def test_reruns_agree_whatever_the_partitions(make):
    docs = make(rows())
    one = mixing.mix_sources(docs, carry=["doc_id"]).collect()
    two = mixing.mix_sources(docs.repartition(7, "n_chars"), carry=["doc_id"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_inclusion_is_near_the_promise(make):
    # One source of weight 1 beside one of weight 2 and equal size: two thirds.
    docs = make([(i, "a b", "en", "ab"[i % 2]) for i in range(3000)])
    got = mixing.mix_sources(docs, carry=["doc_id", "source"]).collect()
    assert sum(r.taken for r in got if r.source == "a") == 2000
    assert {r.copies for r in got if r.source == "b"} == {1, 2}


def test_importance_moves_the_odds(spark, make):
    from pyspark.sql import functions as F

    docs = make([(i, "a b", "en", "ab"[i % 2]) for i in range(2000)]).withColumn("imp", F.col("doc_id") % 4 + 1)
    got = mixing.mix_sources(docs, importance="imp", carry=["doc_id", "source", "imp"]).collect()
    part = {k: sum(r.copies for r in got if r.imp == k) for k in (1, 3)}
    assert part[3] > 2 * part[1]
    assert abs(sum(r.taken for r in got if r.source == "a") - 2 * 2000 / 3) <= 4


@pytest.mark.parametrize("seed", [0])
def test_thresholds_match_a_plain_sort(spark, seed):
    import random

    rnd = random.Random(seed)
    units, wanted = [], []
    for source, top in (("a", 5), ("b", 60), (None, 4000), ("tiny", 1)):
        mine = [(source, k, rnd.randint(1, top) if rnd.random() < 0.9 else top * 20)
                for k in rnd.sample(range(1 << mixing.KEY_BITS), rnd.randint(1, 120))]
        units += mine
        wanted.append((source, rnd.random() * sum(s for _, _, s in mine)))
    cuts, more = mixing.thresholds(spark.createDataFrame(units, "source string, key long, size long").repartition(5),
                                   spark.createDataFrame(wanted, "source string, words double"))
    cut = {r.source: r.cut for r in cuts.collect()}
    got = {(r.source, r.key) for r in more.collect()}
    got |= {(s, k) for s, k, _ in units if k < cut[s]}
    want = set()
    for source, gap in wanted:
        left = []
        for k, size in sorted((k, size) for s, k, size in units if s == source):
            if size <= gap:
                want.add((source, k))
                gap -= size
            else:
                left.append((size, k))
        if left and min(left)[0] - gap < gap:
            want.add((source, min(left)[1]))
    assert got == want


def test_sample_repeats_rows(make):
    docs = make(rows(), "_copies", "_again")
    got = mixing.sample_mix(docs)
    assert got.columns == docs.columns
    times = sum(r.copies for r in mixing.mix_sources(docs, names=("n", "a", "b", "copies", "d"), carry=["doc_id"]).collect())
    assert got.count() == times


def test_empty(make):
    docs = make([(1, "a")])
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    wordless = mixing.mix_sources(make([(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in wordless] == [(0, 0.0, 0)] * 2
