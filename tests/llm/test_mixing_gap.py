"""A document that doesn't fit makes way for those behind it."""

import pytest

from stellate.llm import mixing

from llm_fixtures import make  # noqa: F401


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_a_very_long_document_at_the_cut(make, seed):
    docs = make([(i, "w " * 100) for i in range(1000)] + [(5000, "w " * 50000)])
    got = mixing.mix_sources(docs, share=0.5, seed=seed, carry=["doc_id"]).collect()
    assert sum(r.size for r in got) == 150_000
    assert abs(sum(r.taken for r in got) - 75_000) <= 50


def test_rows_of_a_unit_stay_together(make):
    rows = [(i, "w " * (1 + i % 90), "en", None if i % 2 else "a") for i in range(400)]
    got = mixing.mix_sources(make(rows + rows), carry=["doc_id", "source"], share=0.4, max_repeat=1).collect()
    copies = {}
    for r in got:
        copies.setdefault(r.doc_id, set()).add(r.copies)
    assert all(len(c) == 1 for c in copies.values())
    for s in (None, "a"):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2  # units of null are multiples of 4
