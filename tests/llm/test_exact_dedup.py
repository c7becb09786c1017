"""Exact classes against a dictionary of normalised texts."""

import hashlib
import re

import pytest

from stellate.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

from llm_fixtures import make  # noqa: F401


def rows():
    long = "lorem ipsum " * 3000
    return [(9, "a b"), (2, "a  b"), (3, "a\t\r\nb"), (4, "a b "), (5, None), (6, ""), (7, "   "), (8, "\n"), (10, "é" * 40),
            (11, "é" * 40), (12, "x" * 64), (13, "x" * 64), (14, "x" * 63), (15, "x" * 65), (16, "x" * 65),
            (17, long + "end"), (18, long + "end"), (19, long + "fin"), (20, long), (2, "a b"), (2, "a b"),
            (None, "a b"), (None, "null id"), (None, "null id"), (21, "a b"), (22, "A b")]


def norm(t):
    return re.sub("[ \t-\r]+", " ", t or "")


@pytest.mark.parametrize("width,growth", [(64, 8), (1, 2), (3, 100000)])
def test_classes(make, width, growth):
    docs = make(rows(), "keep_id_", "_n", "_body")
    got = exact_duplicates(docs, carry=["doc_id", "n_chars"], digest="sha", width=width, growth=growth).collect()
    groups = {}
    for i, t in rows():
        groups.setdefault(norm(t), []).append(i)
    want = sorted((str(i), str(min((x for x in groups[norm(t)] if x is not None), default=None)), len(groups[norm(t)]),
                   hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows())
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.sha) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.sha for r in kept}) == len(groups)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_filter_keeps_whole_rows(make):
    docs = make(rows(), "kept", "keep_id")
    got = drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    texts = {norm(r.text) for r in got.collect()}
    assert texts == {norm(t) for _, t in rows()} and got.count() == len(texts)


def test_empty(make):
    none = make([(1, "a")]).limit(0)
    assert exact_duplicates(none).count() == 0
    assert drop_exact_duplicates(none).count() == 0
