"""Viterbi against plain dynamic programming; spans and held-out accuracy."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stellate.llm import langid as L

from llm_fixtures import make  # noqa: F401

EN = "the house of that was and with for this are have from they which would there about".split()
FR = "le la des une est que pour dans sur par avec plus tout nous vous leur cette être".split()
RU = "и в не на я быть он с что а по это она этот к но они мы весь который".split()


def texts(n=60, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang, words = (("en", EN), ("fr", FR), ("ru", RU))[i % 3]
        out.append((i, " ".join(rng.choice(words, rng.integers(3, 40))), lang))
    return out


def plain(score, penalty):
    """Best labelling of one text, over all states."""
    n, k = score.shape
    best, back = score[0].copy(), []
    for t in range(1, n):
        step = np.array([[best[j] - (penalty if j != i else 0) for j in range(k)] for i in range(k)])
        back.append(step.argmax(1))
        best = step.max(1) + score[t]
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(best.max())


def value(score, path, penalty):
    return sum(score[t, s] for t, s in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_matches_plain():
    rng = np.random.default_rng(3)
    sizes = np.array([5, 0, 1, 40, 13, 40, 2])
    score = -rng.random((sizes.sum(), 4)).astype(np.float32) * 6
    label, at = L.viterbi(score, sizes, 3.0), 0
    for n in sizes:
        if n:
            want, best = plain(score[at:at + n].astype(float), 3.0)
            assert value(score[at:at + n].astype(float), label[at:at + n].tolist(), 3.0) == pytest.approx(best, abs=1e-4)
        at += n


def test_trigram_buckets_match_plain():
    words = ["a", "été", "abc", "ж"]
    bucket, size = L.trigrams(words)
    want = []
    for w in words:
        d = b" " + w.encode() + b" "
        for i in range(len(d) - 2):
            h = ((d[i] << 16 | d[i + 1] << 8 | d[i + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> 13
            want.append(h % L.BUCKETS)
    assert bucket.tolist() == want and size.tolist() == [len(w.encode()) for w in words]


def test_texts_and_spans(make):
    train = make(texts() + [(900, "no language", None), (901, None, "xx")], "_lang", "bucket", "score")
    model = L.learn_languages(train, where=F.col("doc_id") % 4 != 2)
    assert model.languages == ["en", "fr", "ru"]
    mixed = " ".join(EN[:8] + ["123"] + FR[:8] + RU[:6])
    asked = texts(30, 1) + [(100, None), (101, ""), (102, "12 34 !?"), (103, mixed), (None, "the house"), (104, "日本"),
                            (105, "the " * 30000), (106, "THE HOUSE"), (106, "THE HOUSE")]
    got = L.label_languages(make(asked, "lang_pred", "spans"), model).collect()
    assert len(got) == len(asked)
    by_id = {r.doc_id: r for r in got}
    assert sum(by_id[i].lang_pred == lang for i, _, lang in texts(30, 1)) >= 29
    assert all(0 <= r.score <= 1 for r in got)
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by_id[105].lang_pred == by_id[106].lang_pred == "en" and by_id[105].score == 1
    spans = [(s.lang, s.first, s.words) for s in by_id[103].spans]
    assert [s[0] for s in spans] == ["en", "fr", "ru"] and spans[2][1:] == (17, 6)
    assert sum(s[2] for s in spans) == len(mixed.split())


def model_of(languages):
    logp = np.random.default_rng(7).normal(-8, 2, (L.BUCKETS, len(languages))).astype(np.float32)
    return L.LanguageModel(languages, logp, np.ones((len(L.SCRIPTS), len(languages)), bool))


def test_batch_may_end_with_a_flush():
    model = model_of(["en", "fr", "ru"])
    rows = [(1, "the house"), (2, None), (3, "12 ?"), (4, " ".join(EN[:7] + FR[:5])), (5, "le chat"), (6, "я быть она")]

    def labelled(step, n, per_batch):
        batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in x]), pa.array([t for _, t in x], pa.string())],
                                              ["_id", "_text"])
                   for x in (rows[a:min(a + per_batch, n)] for a in range(0, n, per_batch))]
        got = list(L._label(iter(batches), SimpleNamespace(value=model), 8.0, 5, step))
        assert [b.num_rows for b in got] == [b.num_rows for b in batches]
        return [r for b in got for r in b.to_pylist()]

    want = labelled(4_000_000, len(rows), len(rows))
    assert [r["_id"] for r in want] == [i for i, _ in rows]
    for step in range(0, 3 * 30):  # every text, and so the last of a batch, is the one that fills a step at some size
        for n in range(1, len(rows) + 1):
            assert labelled(step, n, n) == want[:n]
        assert labelled(step, len(rows), 2) == want


def test_last_text_of_a_partition_fills_a_step(make):
    """100 languages: a step holds 40,000 words, and the only long text comes last."""
    model = model_of([f"l{i:02d}" for i in range(100)])
    rows = [(1, "some words"), (2, "the " * 40_000)]
    got = {r.doc_id: r for r in L.label_languages(make(rows).coalesce(1), model).collect()}
    assert set(got) == {1, 2} and got[2].score == 1 and [s.words for s in got[2].spans] == [40_000]


def test_nothing_learned(make):
    model = L.learn_languages(make([(1, None), (2, "12")]))
    got = L.label_languages(make([(1, "some words"), (2, None)]), model).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert L.label_languages(make([(1, "a")]).limit(0), model).count() == 0
