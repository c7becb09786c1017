"""Trees against a plain walk, and a classifier that must tell junk."""

import numpy as np
import pytest

from stellate.llm import quality as Q

from llm_fixtures import make  # noqa: F401


def walk(trees, row):
    raw = trees.base
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        k = 0
        while k < len(f):
            k = 2 * k + 2 if row[f[k]] > t[k] else 2 * k + 1
        raw += leaf[k - len(f)]
    return 1 / (1 + np.exp(-raw))


def test_trees_learn_and_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < 0)).astype(float)
    trees = Q.fit_trees(x[:1500], y[:1500], rounds=60)
    assert ((trees.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert trees.score(x[:50]) == pytest.approx([walk(trees, r) for r in x[:50]])
    assert trees.score(x[:0]).shape == (0,)


def best_split(x, g, h, rows, l2=1.0, least=2.0):
    """The best gain of any cut between two values, by trying them all."""
    def part(r):
        return g[r].sum() ** 2 / (h[r].sum() + l2)

    best = (1e-9, None, None)
    for j in range(x.shape[1]):
        for cut in np.unique(x[rows, j])[:-1]:
            left, right = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
            if min(h[left].sum(), h[right].sum()) >= least:
                gain = part(left) + part(right) - part(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, j, set(left.tolist()))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_splits_are_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (160, 3)).astype(float)  # fewer values than bins, so that no cut is lost
    y = ((x[:, seed % 3] > 5) & (x[:, 2] < 8) ^ (rng.random(160) < 0.1)).astype(float)
    trees = Q.fit_trees(x, y, rounds=1, depth=2, bins=2000)
    p = (y.sum() + 0.5) / (len(y) + 1)
    g, h = p - y, np.full(len(y), p * (1 - p))
    todo = [(0, np.arange(len(y)))]
    for node, rows in todo:
        gain, j, left = best_split(x, g, h, rows)
        above = x[rows, trees.feature[0, node]] > trees.threshold[0, node]
        if j is None:
            assert not above.any()
            continue
        got = [rows[~above], rows[above]]
        value = sum(g[r].sum() ** 2 / (h[r].sum() + 1) for r in got) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
        assert value == pytest.approx(gain)
        if node == 0:
            todo += [(1, got[0]), (2, got[1])]
    node = 1 + (x[:, trees.feature[0, 0]] > trees.threshold[0, 0]).astype(int)
    leaf = 2 * (node - 1) + (x[np.arange(160), trees.feature[0, node]] > trees.threshold[0, node])
    for k in range(4):
        assert trees.leaf[0, k] == pytest.approx(-0.15 * g[leaf == k].sum() / (h[leaf == k].sum() + 1))


def test_rows_that_share_an_id(spark, make):
    docs = documents()
    twice = docs + [(i, "JUNK!! " * (i + 1)) for i, _ in docs[::2]]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    one, two = (Q.fit_quality(make(rows).repartition(n), labels) for rows, n in ((twice, 2), (twice[::-1], 7)))
    assert (one.leaf == two.leaf).all() and (one.threshold == two.threshold).all()


def test_one_class_or_none():
    assert Q.fit_trees(np.empty((0, 3)), np.empty(0)).score(np.zeros((2, 3))) == pytest.approx([0.5, 0.5])
    assert Q.fit_trees(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3)))[0] == pytest.approx(0.95)


def test_statistics_of_awkward_texts():
    for t in (None, "", " ", "\n\n", "a", "é", "x" * 10**6, "a b " * 10**5, "1 2 3", "!!!"):
        s = Q.statistics(t)
        assert s.shape == (len(Q.FEATURES),) and np.isfinite(s).all()
    assert (Q.statistics(None) == 0).all()


def documents():
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "house", "river", "stone", "cloud"]
    out = []
    for i in range(240):
        t = [str(rng.choice(words)) + str(rng.integers(30)) for _ in range(rng.integers(20, 60))]
        out.append((i, " ".join(t) if i % 4 else " ".join(w.upper() + "!!" for w in t)))
    return out


def test_documents(spark, make):
    docs = documents()
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(200)] + [(5, None, 0), (9999, 1, 0), (None, 1, 0),
                                                                                     (6, 7, 0), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    extra = docs + [(None, docs[1][1]), (500, None), (501, ""), (7, docs[7][1]), (502, "word " * 50000)]
    df = make(extra, "label", "score", "x", "_label_id")
    trees = Q.fit_quality(df, labels)
    got = Q.score_quality(df, trees).collect()
    assert len(got) == len(extra) and all(0 <= r.score <= 1 for r in got)
    right = [((r.score >= 0.3) == (r.doc_id % 4 != 0)) for r in got if r.doc_id is not None and r.doc_id < 240]
    assert np.mean(right) > 0.97
    kept = Q.keep_quality(df, trees)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.score >= Q.THRESHOLD for r in got)
    again = Q.fit_quality(df.repartition(5), labels.repartition(2))
    assert (again.leaf == trees.leaf).all()
    # The bound on labelled rows is kept.
    assert Q.fit_quality(df, labels, sample=10).leaf.shape[0] in (0, 120)


def test_empty_tables(spark, make):
    none, labels = make([(1, "a")]).limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    trees = Q.fit_quality(none, labels)
    assert Q.score_quality(none, trees).count() == 0
    assert Q.keep_quality(make([(1, "a"), (2, None)]), trees).count() == 2
