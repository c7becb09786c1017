"""Unigram sums by hand, and the model as a probability."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import mixing_lm as M
from stellate.llm.common import held_out, learnable

from llm_fixtures import make  # noqa: F401


def rows():
    rng = np.random.default_rng(0)
    words = {"en": "the of and to in is that was for it".split(), "fr": "le la des une est que pour dans sur par".split()}
    out = []
    for i in range(300):
        w = words["en" if i % 2 else "fr"]
        n = int(rng.integers(1, 60))
        text = " ".join(rng.choice(w) + rng.choice(["", "", "x", "y" + str(i % 7)]) for _ in range(n))
        out.append((i, text))
    return out + [(1000, None), (1001, ""), (1002, " \n "), (1003, "The\x00 ÉTÉ \x00"), (None, "no id the of"),
                  (1004, "again " * 5000), (1005, "z" * 3000), (7, "twice the id"), (7, "twice the id")]


def test_scores(make):
    ident = F.col("doc_id")
    docs = make(rows(), "score", "row", "word", "n")
    got = M.score_texts(docs, learn=learnable(ident, 7, 2), held_out=held_out(ident, 7, 2), frequent=40).collect()
    fold = {i: None if i is None else zlib.crc32(str(i).encode()) % 7 for i, _ in rows()}
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows()]
    c = Counter(w for i, ws in tokens if i is not None and fold[i] != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), fold[i] == 2, len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == pytest.approx(by_id[1001].score)
    assert by_id[1004].bits_per_byte < 0.2  # the adaptive stage learns a text's own words
    known = [r for r in got if r.held_out and r.doc_id < 300]
    assert sum(r.score for r in known) > sum(r.base_score for r in known)


def test_words_have_a_probability():
    """All one-byte words, longer ones by their first byte, and the end: the
    model's first symbol sums to 1 over its 256 values."""
    rng = np.random.default_rng(1)
    pairs = M._byte_pairs(rng.integers(0, 50, M.SLOTS), rng.integers(0, 50, M.SLOTS))
    starts = M.starts_of([b"a", b"ab"])
    model = M.assemble(pairs, starts, *(np.zeros(0, t) for t in (int, int, float, float)))
    data, ctx, _, known = M.spell([bytes([b]) + b"q" for b in range(256) if b != 32], starts)
    first = np.flatnonzero(np.arange(len(data)) % 3 == 0)
    total = np.zeros(len(data))
    for b in range(8):
        node, bit, slots = M._bit(data, ctx, known, b)
        p = model.next(b, node, slots)
        total += np.log(np.where(bit == 1, p, 1 - p))
    end = 10 ** model.log10([b""])[0]
    assert np.exp(total[first]).sum() + end == pytest.approx(1, abs=1e-6)


def test_contexts_do_not_depend_on_the_block():
    words = [b"alpha", b"", b"beta", b"alphabet", b"b"]
    _, all_, word = M._contexts(words)
    for k, w in enumerate(words):
        assert (M._contexts([w])[1] == all_[:, word == k]).all()


def test_empty_and_nothing_to_learn(make):
    docs = make([(1, "a b"), (2, None)])
    args = dict(learn=F.lit(False), held_out=F.lit(True))
    assert M.score_texts(docs.limit(0), **args).count() == 0
    got = {r.doc_id: r for r in M.score_texts(docs, **args).collect()}
    assert got[1].train_tokens == 0 and got[1].n_known == 0 and got[2].n_tokens == 1
    assert got[1].base_score == pytest.approx(0.0)
