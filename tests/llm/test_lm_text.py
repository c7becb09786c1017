"""The words of texts: code, slots, probabilities, and what order is worth."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from stellate.llm import mixing_lm as M
from stellate.llm.common import held_out, learnable

SF = "/root/testdata/sf0.01/documents.parquet"


def model(seed=0, words=9, bits=12):
    rng = np.random.default_rng(seed)
    code = M.Code.of(rng.integers(1, 500, words + 2))
    size = len(code.size) + (3 << bits)
    pairs = M._byte_pairs(rng.integers(0, 40, size), rng.integers(0, 40, size))
    return M.assemble_text(code, bits, pairs, *(np.zeros(0, t) for t in (int, int, float, float)))


def test_code_is_a_full_prefix_code():
    for weights in ([5, 1, 1, 1], [1] * 37, [2 ** k for k in range(20)], [3, 4]):
        code = M.Code.of(np.array(weights))
        assert sum(2.0 ** -n for n in code.size) == pytest.approx(1)
        paths = {tuple(code.bits[b:b + n]) for b, n in zip(code.begin, code.size)}
        assert len(paths) == len(weights)
        word, node, bit = code.spread(np.arange(len(weights)))
        assert np.bincount(word).tolist() == code.size.tolist() and len(np.unique(node)) == len(weights) - 1
    assert M.Code.of(np.array([4])).size.tolist() == [0]


def test_words_sum_to_one_in_every_context():
    m = model()
    for head in ([], [3], [3, 4], [8, 8, 2]):
        p = [np.exp(m.coded(np.array([*head, w]), np.arange(len(head) + 1))[-1]) for w in range(m.escape + 1)]
        assert sum(p) == pytest.approx(1, abs=1e-5)


def test_text_probabilities_sum_to_one():
    """All next words: frequent ones and the end, a rare word of the text again,
    and any other rare word."""
    m = model(1)
    rare = [m.escape + 5, m.escape + 9]
    for head in ([0], [0, 1, rare[0], 2], [rare[0], rare[1], rare[0], 3, 3, 3]):
        def log10(x):
            return m.log10(np.array(x), np.array([len(x)]))[0][0]

        nexts = [*range(m.escape), *[r for r in rare if r in head], m.escape + 77]
        assert sum(10 ** (log10(head + [w]) - log10(head)) for w in nexts) == pytest.approx(1, abs=1e-5)


def test_texts_side_by_side_do_not_touch():
    m, rng = model(2), np.random.default_rng(3)
    texts = [rng.integers(0, m.escape + 4, n) for n in (1, 7, 2, 40, 1)]
    alone = [m.log10(t, np.array([len(t)])) for t in texts]
    both, first = m.log10(np.concatenate(texts), np.array([len(t) for t in texts]))
    assert both == pytest.approx([a[0][0] for a in alone])
    assert first.tolist() == np.concatenate([a[1] for a in alone]).tolist()


def test_counts_do_not_depend_on_the_split(spark):
    """Pieces added up by Spark, however the table is dealt, against counts by hand."""
    rng = np.random.default_rng(4)
    code = M.Code.of(rng.integers(1, 90, 30))
    texts = [rng.integers(0, 45, rng.integers(1, 200)).astype(np.int32) for _ in range(60)]
    rows = [(bytearray(t.tobytes()),) for t in texts]
    bits = M.text_bits(5000)
    size = len(code.size) + (3 << bits)
    want = np.zeros((size, 2), int)
    for t in texts:
        for i in range(len(t)):
            lo = max(0, i - 2)
            _, bit, slots = M.TextModel(code, bits).parts(t[lo:i + 1], np.arange(lo, i + 1), i - lo)
            for s in slots:
                np.add.at(want, (s, bit), 1)
    for parts in (1, 5):
        got = M.learn_text(spark.createDataFrame(rows, "number binary").repartition(parts), code, 5000)
        assert (got[0].pairs == M._byte_pairs(want[:, 0], want[:, 1])).all()
    assert M.text_bits(10) == M.LEAST_BITS and M.text_bits(10 ** 12) == M.MOST_BITS


@pytest.fixture(scope="module")
def scored(spark):
    """All documents, and the held-out ones once more with their words shuffled."""
    docs = spark.read.parquet(SF).select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    rng = random.Random(5)

    def mixed(text):
        words = (text or "").split()
        rng.shuffle(words)
        return " ".join(words)

    rows = [(-r.doc_id - 1, mixed(r.text)) for r in docs.where(out).collect()]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    got = M.score_texts(both, learn=learnable(F.col("doc_id"), 7, 2) & (F.col("doc_id") >= 0),
                        held_out=F.coalesce(out, F.lit(False)) | (F.col("doc_id") < 0)).collect()
    return {r.doc_id: r for r in got}


def test_held_out_total(scored):
    """Better than the unigram base, which spells nothing, and than -232,364 and
    -245,812, the totals of earlier models on these documents."""
    held = [r for i, r in scored.items() if r.held_out and i >= 0]
    assert len(held) == 146
    assert sum(r.score for r in held) > -230_000 > sum(r.base_score for r in held)


def test_order_counts(scored):
    held = [i for i, r in scored.items() if r.held_out and i >= 0]
    plain, mixed = (sum(scored[k].score for k in ids) for ids in (held, [-i - 1 for i in held]))
    assert sum(scored[i].base_score for i in held) == pytest.approx(sum(scored[-i - 1].base_score for i in held))
    assert mixed < 1.03 * plain


def test_code_is_built_in_little_memory():
    """The driver builds the code of up to 65,538 symbols: lists of (node, bit) took
    about 140 bytes for each bit of each path."""
    weights = np.maximum(1, 1_000_000 // np.arange(1, 8193))
    tracemalloc.start()
    try:
        code = M.Code.of(weights)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * code.size.sum()
    # Nodes count down to the leaf, so a path starts at the root; no two paths share a bit at one node.
    assert (code.nodes[code.begin] == len(weights) - 2).all()
    word, node, _ = code.spread(np.arange(len(weights)))
    assert (np.diff(node.astype(int))[np.diff(word) == 0] < 0).all()


def test_words_and_ranks_by_hand():
    texts = ["The cat  the\tCAT\x0bsat", "", None, " \r\n ", " nul\x00 É\x1cx \x85 ", "rare rare the Rare"]
    want = [(t or "").encode().lower().split() for t in texts]
    flat, sizes = M._words(pa.array(texts, pa.string()))
    assert flat.to_pylist() == [w for ws in want for w in ws] and sizes.tolist() == [len(ws) for ws in want]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array([False] * 6), pa.array([True, True, None, True, False, True]),
         pa.array(texts, pa.string())], ["_id", "_out", "learn", "_text"])
    got = list(M._count_words(iter([batch, batch.slice(0, 0)])))[0].to_pydict()
    learn = Counter(w for k in (0, 1, 3, 5) for w in want[k])
    counts = {**dict.fromkeys(want[4], 0), **learn, b"": 4}
    assert len(got["word"]) == len(counts) and dict(zip(got["word"], got["c"])) == counts

    class Shared:
        value = [b"the", b"cat"]

    out = list(M._ranked(iter([batch, batch.slice(0, 0)]), Shared))
    assert [x.num_rows for x in out] == [6, 0]
    known = {b"the": 0, b"cat": 1, b"": 2}
    for row, ws in zip(out[0].to_pylist(), want):
        assert np.frombuffer(row["number"], np.int32).tolist() == [
            known[w] if w in known else 3 + zlib.crc32(w) % ((1 << 31) - 4) for w in [*ws, b""]]
        assert row["tokens"] == len(ws) + 1 and row["bytes"] == sum(len(w) + 1 for w in ws) + 1
        assert dict(zip(row["rare"], row["often"])) == Counter(w for w in ws if w not in known)


def test_spelling_counts_travel_as_pieces():
    """As one count after the other, scaled to a byte and halves rounded up."""
    words, times = [b"a", b"ab", b"abc", b"ba"], np.array([3, 510, 1, 255])
    starts = M.starts_of([b"ab"])

    class Shared:
        value = starts

    batches = [pa.RecordBatch.from_arrays([pa.array(words[k:k + 2], pa.binary()), pa.array(times[k:k + 2])], ["word", "c"])
               for k in (0, 2)]
    pieces = pa.concat_tables([pa.Table.from_batches(M._count_slots(iter([b]), Shared)) for b in batches])
    added = pa.concat_tables([M._add_pieces(pieces.filter(pc.equal(pieces["piece"], k)), np.int64, M._half_up)
                              for k in pieces["piece"].unique().to_pylist()])
    want = np.zeros((M.SLOTS, 2), np.int64)
    data, ctx, word, known = M.spell(words, starts)
    for b in range(8):
        _, bit, slots = M._bit(data, ctx, known, b)
        for k in range(M.CONTEXTS):
            for s, x, w in zip(slots[k].tolist(), bit.tolist(), word.tolist()):
                want[s, x] += times[w]
    want[-1] = 0
    assert want.max() > 255
    by = np.maximum(1, want.max(1) / 255)[:, None]
    scaled = np.floor(want / by + 0.5).astype(int)
    assert (M._whole(added, M.SLOTS) == (scaled[:, 0] | scaled[:, 1] << 8)).all()
