"""Each stage of the pipeline against brute force on its own input."""

import numpy as np
import pytest

import corpus_pipeline as C
from stellate.llm import mixing, quality
from stellate.llm.common import stored

from test_exact_dedup import norm
from test_simhash import brute, fingerprint

from llm_fixtures import make  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    rng = np.random.default_rng(4)
    words = [a + b for a in "stone river house cloud green light north water".split() for b in ("", "s", "ly", "ing", "er")]
    out = []
    for i in range(200):
        t = " ".join(rng.choice(words, rng.integers(30, 120)))
        out.append((i, t if i % 5 else " ".join(w.upper() + "!!" for w in t.split()), "en", f"s{i % 4}"))
    long = " ".join(rng.choice(words, 6000))
    out += [(300, out[1][1], "en", "s1"), (301, out[1][1].replace(" ", "  "), "en", "s1"), (302, long, "en", None),
            (303, long + " end", "en", None), (304, None, "en", "s2"), (305, "", "en", "s2"), (306, "one", None, "s3"),
            (None, out[2][1], "en", "s1"), (7, out[7][1], "en", "s3")]
    return out


@pytest.fixture
def folder(spark, make, tmp_dir):
    make(documents()).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(200)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_dir}/labels.parquet")
    return tmp_dir


def text_of(r):
    return r.text or ""


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "simhash", "mixing", "packing"]
    stages, seen = dict(C.STAGES), {}
    for name in stages:
        before = docs.collect()
        docs = stored(stages[name](spark, docs, folder), f"test-{name}")[0]
        after = seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
        key = lambda r: (str(r.doc_id), text_of(r))
        if name == "quality":
            trees = quality.fit_quality(spark.read.parquet(f"{folder}/documents.parquet"),
                                        spark.read.parquet(f"{folder}/labels.parquet"))
            x = np.array([quality.statistics(r.text) for r in before])
            want = [key(r) for r, s in zip(before, trees.score(x)) if s >= 0.3]
            assert sorted(map(key, after)) == sorted(want)
            assert not any(r.text and r.text.isupper() for r in after)
        elif name == "exact_dedup":
            first = {}
            for r in sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
                first.setdefault(norm(r.text), r.doc_id)
            assert sorted((str(r.doc_id), norm(r.text)) for r in after) == sorted((str(i), t) for t, i in first.items())
        elif name == "simhash":
            order = sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0))
            roots = brute([fingerprint(r.text) for r in order], 4)
            assert sorted(map(key, after)) == sorted(key(r) for i, r in enumerate(order) if roots[i] == i)
            assert len({r.doc_id for r in after} & {302, 303}) == 1
        elif name == "mixing":
            plan = {r.doc_id: r for r in mixing.mix_sources(
                spark.createDataFrame(before, docs.schema), names=("n", "total", "goal", "times", "words")).collect()}
            want = sorted(key(r) for r in before for _ in range(plan[r.doc_id].times))
            assert sorted(map(key, after)) == want
            for s in {r.source for r in before}:
                mine = [p for p in plan.values() if p.source == s]
                assert abs(sum(p.words for p in mine) - mine[0].goal) <= max(p.n for p in mine)
        else:
            from stellate.llm.tokens import UnitEncoder

            tok = UnitEncoder(C.production_tokenizer()).tok
            want = sum(len(tok.encode(text_of(r), add_special_tokens=False).ids) + 1 for r in before)
            assert sum(r.length for r in after) == want
            fill = {}
            for r in after:
                fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for pieces in fill.values():
                ends = np.cumsum([n for _, n in sorted(pieces)])
                assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_run_is_the_stages_in_order(spark, folder):
    got = C.run(spark, folder)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stored(stage(spark, docs, folder), "test-run")[0]
    total = "sum(length)"
    assert sorted(map(str, got.groupBy("doc_id").sum("length").select("doc_id", total).collect())) == \
        sorted(map(str, docs.groupBy("doc_id").sum("length").select("doc_id", total).collect()))


def test_empty_documents(spark, folder, tmp_dir):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, folder), f"test-none-{name}")[0]
        assert docs.count() == 0
