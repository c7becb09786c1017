"""Language-model scores by online logistic context mixing.

The model reads a text word by word and ends it with one more symbol, the end.
A word is coded in bits, and each bit is predicted:

* One of the ``FREQUENT`` most frequent training words (``LEAST_COUNT`` times at
  least), the end, and the escape to all other words are the leaves of a binary code tree (Huffman's, so that a bit
  carries much).  Each bit of the path is predicted in four contexts: none, the
  word before, the word before that, and both; rare words count as contexts like
  all others.  A context is hashed, with the node of the tree, to a slot with two
  counts: how often the bit was 0 and 1.
* Behind the escape, a bit tells whether the word stood in this text before; its
  probability follows the text (repeats so far), and so does the choice among the
  words seen.  Else a bit tells whether the word is known: a known one has its
  share of the rare training words' counts, which are a Spark table of all words;
  a new one is spelled byte by byte and ended by a blank, again in bits that are
  predicted in six hashed contexts (none, the last one to four bytes, all bytes so
  far).

The log odds of a bit's contexts are combined by weights, of which a gate picks
one set for each bit (by how often the longer contexts were seen); the result is
refined by an adaptive map from it to what came true.  At last each word's
probability is mixed with how often it stood in the text so far, by a weight that
follows the share of repeats.  The probabilities of a text's words multiply to
that of the text; they sum to at most 1, as a spelling or a rare word that could
have been coded otherwise keeps its unused share.

Learning, spread over the cluster:

1. counts of words, and counts of all slots, are sums added up by Spark.  Slot
   counts go as compressed pieces of flat arrays, from as many tasks as the text
   needs, not as many as the table has parts;
2. each task passes over its words online, a block after the other: it predicts
   a block from the counts without the occurrence that it predicts, then moves
   the weights of the gates it met; weights are averaged over tasks, each gate
   by the words it has seen; the adaptive maps are again sums.

What grows with the corpus is the table of words with their counts, which is
joined to the rare words of the texts, never broadcast.  Slots grow with the
training words up to ``MOST_BITS`` (they are broadcast, so their size is bounded).
Frequent words are bounded for the same reason.

Defined cases: a null or empty text is the end alone; a null id is neither held
out nor learned from; rows that repeat are documents of their own; without
training documents there is no known word and each bit has probability 1/2.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, ship, stored

#: Contexts and the bits of their slot numbers; the last is the word's start.
CONTEXTS, BITS = 6, (12, 16, 20, 20, 20, 20)
#: Sets of weights of a bit, and buckets of the adaptive map.
SETS, BUCKETS = 8 * 3, 24
#: Most frequent words: leaves of the code tree; their starts are contexts of spellings.
FREQUENT = 65_536
#: A word met less often than this is a rare one: it says how often new words come.
LEAST_COUNT = 4
#: Most common words of which a repeat says nothing about a text.
EVERYDAY = 1000
#: Bits of the slot numbers of a text context, at least and at most.
LEAST_BITS, MOST_BITS = 16, 22
#: Training words that a counting task takes, and slots of a piece.
TASK_WORDS, PIECE = 4_000_000, 1 << 15
_BLOCK, _U = 1 << 15, np.uint32
_R = 0x01000193
#: Inverse of _R modulo 2**32: takes a word's place out of a running sum.
_R_INVERSE = pow(_R, -1, 1 << 32)
_BASE = np.concatenate([[0], np.cumsum([1 << b for b in BITS])]).astype(np.int32)
#: The slot behind all others stands for an unknown start and stays empty.
SLOTS = int(_BASE[-1]) + 1


# ---- contexts -------------------------------------------------------------

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def starts_of(words: list[bytes]) -> np.ndarray:
    """Hashes of all starts of words, sorted."""
    found = [np.zeros(1, _U)]
    for lo, hi in _blocks(words):
        found.append(np.unique(_contexts(words[lo:hi])[1][5]))
    return np.unique(np.concatenate(found))


def _contexts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, contexts, word numbers): all bytes of the words and the blank
    behind each, with the hash of each context in front of each symbol."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(_U)
    size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(data)) - start[word]
    ctx = np.empty((CONTEXTS, len(data)), _U)
    ctx[0] = np.minimum(place, 12)
    run = np.zeros(len(data), _U)
    for k in range(1, 5):  # the last k bytes; 0 in front of the word
        back = np.zeros(len(data), _U)
        back[k:] = data[:-k] + _U(1)
        back[place < k] = 0
        run = run * _U(0x2545F491) + back + _U(1)
        ctx[k] = run
    # All bytes so far: sum of byte * R**place, from one running sum.
    total = np.cumsum((data + _U(1)) * _powers(_R, len(data)), dtype=_U)
    before = np.concatenate([np.zeros(1, _U), total[:-1]])
    ctx[5] = (before - before[start][word]) * _powers(_R_INVERSE, len(data))[start][word]
    return data, ctx, word


def spell(words: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``_contexts``, well mixed; and which symbols have a known start."""
    data, ctx, word = _contexts(words)
    known = starts[np.minimum(np.searchsorted(starts, ctx[5]), len(starts) - 1)] == ctx[5]
    x = ctx * _U(0x85EBCA6B)
    return data, x ^ (x >> _U(15)), word, known


_NODE_HASH = np.arange(256, dtype=_U) * _U(0x9E3779B1)
_SHIFT = np.array([32 - b for b in BITS], _U)[:, None]


def _bit(data: np.ndarray, ctx: np.ndarray, known: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, bit, slots) of bit b of each symbol; node: 1 and the bits so far."""
    node = _U(1 << b) | (data >> _U(8 - b))
    bit = (data >> _U(7 - b)) & _U(1)
    x = ctx ^ _NODE_HASH.take(node)
    x *= _U(0xC2B2AE35)
    x >>= _SHIFT
    slots = x.astype(np.intp)  # what look-ups take without a copy
    slots += _BASE[:-1, None]
    slots[5, ~known] = SLOTS - 1
    return node, bit, slots


# A slot's two counts are scaled to a byte each and held as one number, zeros
# below ones.  What follows from them is looked up: as they are, and, for
# learning, without the occurrence of a 0 or a 1 at hand (65,536 entries each;
# scaled counts are too large for one occurrence to matter).

def _both_ways() -> tuple[np.ndarray, np.ndarray]:
    n0, n1 = np.arange(65536) & 255, np.arange(65536) >> 8
    out0, out1 = n0 - ((n0 > 0) & (n0 < 128)), n1 - ((n1 > 0) & (n1 < 128))
    return np.concatenate([n0, out0, n0]), np.concatenate([n1, n1, out1])


_N0, _N1 = _both_ways()
_ODDS = (np.log(_N1 + 0.4) - np.log(_N0 + 0.4)).astype(np.float32)


def _steps(steps: tuple[int, ...], times: int = 1) -> np.ndarray:
    """How many of the steps the two counts reach together, by pair."""
    return (np.searchsorted(np.array(steps), _N0 + _N1, "right") * times).astype(np.uint8)


_START_LEVEL, _THREE_LEVEL = _steps((1, 2, 4, 8, 16, 64, 192), 3), _steps((1, 16))


def _gate(start: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Set of weights: how often the word's start and the last three bytes
    were seen (pairs)."""
    return _START_LEVEL.take(start) + _THREE_LEVEL.take(three)


def _half_up(x: np.ndarray) -> np.ndarray:
    return np.floor(x + 0.5)


def _byte_pairs(zero: np.ndarray, one: np.ndarray, whole=np.round) -> np.ndarray:
    """Pairs of counts, scaled where they exceed a byte."""
    by = np.maximum(1.0, np.maximum(zero, one) / 255.0)
    return whole(zero / by).astype(np.uint16) | whole(one / by).astype(np.uint16) << np.uint16(8)


def _refine_at(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bucket of log odds and the share of the upper one."""
    y = np.clip(x + 12, 0, 23.999) * ((BUCKETS - 1) / 24)
    low = y.astype(np.int64)
    return low, y - low


# Counts of slots, zeros and ones in turn, travel as compressed pieces.

def _pieces(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(counts), 2 * PIECE):
        piece = counts[lo:lo + 2 * PIECE]
        if piece.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lo // (2 * PIECE)], pa.int32()),
                 pa.array([pa.compress(piece, "zstd", asbytes=True)], pa.binary())], ["piece", "counts"])


def _add_pieces(table: pa.Table, kind: type = np.uint32, whole=np.round) -> pa.Table:
    total = np.zeros(2 * PIECE, np.int64)
    for blob in table.column("counts"):
        total += np.frombuffer(pa.decompress(blob.as_py(), total.size * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)
    pairs = _byte_pairs(total[0::2], total[1::2], whole)
    return pa.table({"piece": table.column("piece").slice(0, 1),
                     "counts": pa.array([pa.compress(pairs, "zstd", asbytes=True)], pa.binary())})


def _whole(pieces: pa.Table, slots: int) -> np.ndarray:
    """Pairs of all slots from those of the pieces."""
    pairs = np.zeros(-(-slots // PIECE) * PIECE, np.uint16)
    for piece, blob in zip(pieces.column("piece").to_pylist(), pieces.column("counts")):
        pairs[piece * PIECE:(piece + 1) * PIECE] = np.frombuffer(
            pa.decompress(blob.as_py(), 2 * PIECE, "zstd", asbytes=True), np.uint16)
    return pairs[:slots]


# ---- model ----------------------------------------------------------------

@dataclass
class Mixer:
    """Pairs of counts of the slots, weights of gates, adaptive map."""

    pairs: np.ndarray
    weights: np.ndarray  # bits x sets x contexts
    refine: np.ndarray   # nodes x buckets: probabilities
    starts: np.ndarray   # hashes of the known starts of words

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's probability, the blank behind it included."""
        out = np.zeros(len(words))
        for lo, hi in _blocks(words):
            data, ctx, word, known = spell(words[lo:hi], self.starts)
            total = np.zeros(len(data))
            for b in range(8):
                node, bit, slots = _bit(data, ctx, known, b)
                p = self.next(b, node, slots)
                total += np.log10(np.where(bit == 1, p, 1 - p))
            out[lo:hi] = np.bincount(word, total, hi - lo)
        return out

    def next(self, b: int, node: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Probability that bit b is 1."""
        pair = self.pairs.take(slots)
        x = np.einsum("kn,nk->n", _ODDS.take(pair), self.weights[b].take(_gate(pair[5], pair[3]), axis=0))
        low, up = _refine_at(x)
        fine = self.refine[node, low] * (1 - up) + self.refine[node, low + 1] * up
        return np.clip((1 / (1 + np.exp(-x)) + fine) / 2, 1e-7, 1 - 1e-7)


def _blocks(words: list[bytes], symbols: int = _BLOCK) -> Iterator[tuple[int, int]]:
    """Words in runs of about so many symbols, one word at least."""
    ends = np.cumsum([len(w) + 1 for w in words])
    lo = 0
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + symbols, "right")))
        yield lo, hi
        lo = hi


def _count_slots(batches: Iterator[pa.RecordBatch], starts) -> Iterator[pa.RecordBatch]:
    """(piece, counts): compressed pieces of the slots' counts."""
    flat = np.zeros(2 * -(-SLOTS // PIECE) * PIECE, np.int64)
    for batch in batches:
        words, times = batch.column("word").to_pylist(), batch.column("c").to_numpy()
        for lo, hi in _blocks(words):
            data, ctx, word, known = spell(words[lo:hi], starts.value)
            c = np.broadcast_to(times[lo:hi][word], ctx.shape).ravel()
            for b in range(8):
                _, bit, slots = _bit(data, ctx, known, b)
                slots *= 2
                slots += bit
                np.add.at(flat, slots.ravel(), c)
    flat[2 * SLOTS - 2:] = 0
    yield from _pieces(flat)


def _start() -> np.ndarray:
    """Weights before learning: the more often the word's start was seen, the
    more it counts."""
    trust = np.repeat(np.array([0.0, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 1.0]), 3)[:, None]
    one = np.hstack([(1 - trust) * np.array([0.0, 0.1, 0.2, 0.35, 0.35]), trust])
    return np.repeat(one[None], 8, axis=0)


def _learn(batches: Iterator[pa.RecordBatch], shared, ridge: float = 30.0) -> Iterator[pa.RecordBatch]:
    """One online pass over this task's words: after each block the weights of
    each gate take a Newton step, with the curvature of all blocks so far."""
    pairs, starts = shared.value
    weights, mass = _start(), np.zeros((8, SETS))
    curve = np.tile(ridge * np.eye(CONTEXTS), (8, SETS, 1, 1))
    hits, seen = np.zeros(256 * BUCKETS), np.zeros(256 * BUCKETS)
    for batch in batches:
        words, times = batch.column("word").to_pylist(), batch.column("c").to_numpy()
        for lo, hi in _blocks(words):
            data, ctx, word, known = spell(words[lo:hi], starts)
            c = times[lo:hi][word].astype(np.float32)
            for b in range(8):
                node, bit, slots = _bit(data, ctx, known, b)
                pair = pairs[slots] + ((bit.astype(np.intp) + 1) << 16)  # without the occurrence at hand
                gate = _gate(pair[5], pair[3])
                # The symbols of each gate side by side.
                order = np.argsort(gate, kind="stable")
                s, c_, hit = np.empty(pair.shape, np.float32), c[order], bit[order].astype(np.float32)
                for k in range(CONTEXTS):
                    _ODDS.take(pair[k].take(order), out=s[k], mode="clip")
                node, x = node[order], np.empty(len(order), np.float32)
                ends = np.cumsum(np.bincount(gate, minlength=SETS))
                spans = [(g, slice(ends[g - 1] if g else 0, ends[g]))
                         for g in np.flatnonzero(np.diff(ends, prepend=0)).tolist()]
                for g, at in spans:
                    x[at] = weights[b, g] @ s[:, at]
                x = np.clip(x, -12, 12)
                p = 1 / (1 + np.exp(-x))
                at = node * BUCKETS + np.round((x + 12) * ((BUCKETS - 1) / 24)).astype(np.int32)
                seen += np.bincount(at, c_, 256 * BUCKETS)
                hits += np.bincount(at, c_ * hit, 256 * BUCKETS)
                err, bend = c_ * (hit - p), c_ * p * (1 - p)
                slope = np.empty((len(spans), CONTEXTS, 1))
                for k, (g, at) in enumerate(spans):
                    t = s[:, at]
                    curve[b, g] += (t * bend[at]) @ t.T
                    slope[k, :, 0] = t @ err[at]
                    mass[b, g] += c_[at].sum(dtype=float)
                met = [g for g, _ in spans]
                weights[b, met] += np.linalg.solve(curve[b, met], slope)[:, :, 0]
    names = ["kind", "at", "a", "b"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(weights.size, np.int32)), pa.array(np.arange(weights.size, dtype=np.int32)),
         pa.array((weights * mass[:, :, None]).ravel()), pa.array(np.repeat(mass.ravel(), CONTEXTS))], names)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(seen), np.int32)), pa.array(np.arange(len(seen), dtype=np.int32)),
         pa.array(hits), pa.array(seen)], names)


def learn_mixer(words: DataFrame, frequent: int = FREQUENT, by: str = "c"):
    """Learn from a table (word binary, c long) of distinct words, each c times.
    The starts of the ``frequent`` ones with the highest ``by`` become contexts.
    Returns the model and a broadcast of its (pairs, starts)."""
    spark = words.sparkSession
    ship(spark)
    top = words.orderBy(F.desc(by), "word").limit(frequent).select("word").toArrow()["word"].to_pylist()
    starts = starts_of(sorted(top))
    shared_starts = spark.sparkContext.broadcast(starts)
    counts = (words.mapInArrow(lambda it: _count_slots(it, shared_starts), "piece int, counts binary")
              .groupBy("piece").applyInArrow(lambda t: _add_pieces(t, np.int64, _half_up), "piece int, counts binary").toArrow())
    pairs = _whole(counts, SLOTS)
    del counts
    shared_starts.destroy()
    shared = spark.sparkContext.broadcast((pairs, starts))
    rows = (words.mapInArrow(lambda it: _learn(it, shared), "kind int, at int, a double, b double")
            .groupBy("kind", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow())
    return assemble(pairs, starts, *(rows[c].to_numpy() for c in ("kind", "at", "a", "b"))), shared


def assemble(pairs: np.ndarray, starts: np.ndarray, kind: np.ndarray, at: np.ndarray, a: np.ndarray,
             b: np.ndarray) -> Mixer:
    """The model from its counts and the sums over the tasks' passes."""
    weights, w = _start(), (kind == 0) & (b > 0)
    weights.reshape(-1)[at[w]] = a[w] / b[w]
    # A bucket without evidence passes its log odds through.
    plain = 1 / (1 + np.exp(-(np.arange(BUCKETS) * (24 / (BUCKETS - 1)) - 12)))
    hits, seen = np.tile(plain * 2, 256), np.full(256 * BUCKETS, 2.0)
    r = kind == 1
    hits[at[r]] += a[r]
    seen[at[r]] += b[r]
    return Mixer(pairs, weights.astype(np.float32), (hits / seen).reshape(256, BUCKETS), starts)


# ---- documents ------------------------------------------------------------

def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of the texts end to end, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))  # both know ASCII only
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pc.not_equal(pc.binary_length(flat), 0)  # none in front of or behind white space
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(sizes)
    return flat.filter(real).cast(pa.binary()), kept[ends] - kept[ends - sizes]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mine = batch.column("learn").fill_null(False)
        learn = _words(batch.column("_text").filter(mine))[0].value_counts()
        rest = _words(batch.column("_text").filter(pc.invert(mine)))[0].unique()
        names = learn.field("values")
        rest = rest.filter(pc.invert(pc.is_in(rest, value_set=names)))
        # The end of a text is an empty word.
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([names, rest, pa.array([b""], pa.binary())]),
             pa.concat_arrays([learn.field("counts"), pa.array(np.zeros(len(rest), np.int64)),
                               pa.array([mine.true_count], pa.int64())])], ["word", "c"])


def _score_words(batches: Iterator[pa.RecordBatch], shared, weights, refine) -> Iterator[pa.RecordBatch]:
    pairs, starts = shared.value
    model = Mixer(pairs, weights, refine, starts)
    for batch in batches:
        words = batch.column("word").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(model.log10(words))],
                                         ["word", "c", "spelled"])


# ---- words in texts -------------------------------------------------------

@dataclass
class Code:
    """A binary code: for each symbol where its path begins, its length; the
    nodes and bits of all paths end to end."""

    begin: np.ndarray
    size: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(weights: np.ndarray) -> Code:
        """Huffman's code; of equal weights the first symbol is taken first."""
        n = len(weights)
        heap = [(int(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        above, side, new = np.zeros(2 * n, np.int32), np.zeros(2 * n, np.uint8), n
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            above[i] = above[j] = new
            side[j] = 1
            heapq.heappush(heap, (a + b, new))
            new += 1
        # All paths at once, from the leaves up: a level's steps stand one place further from the paths' ends.
        root, up, size = new - 1, np.arange(n), np.zeros(n, np.int64)
        while (on := up != root).any():
            size += on
            up = np.where(on, above[up], root)
        begin, up = np.cumsum(size) - size, np.arange(n)
        nodes, bits = np.empty(int(size.sum()), np.int32), np.empty(int(size.sum()), np.uint8)
        for back in range(1, int(size.max(initial=0)) + 1):
            on = np.flatnonzero(size >= back)
            at = begin[on] + size[on] - back
            nodes[at], bits[at] = above[up[on]] - n, side[up[on]]
            up[on] = above[up[on]]
        return Code(begin, size, nodes, bits)

    def spread(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, node, bit) of all bits of the symbols' paths."""
        size = self.size[symbols]
        word = np.repeat(np.arange(len(symbols)), size)
        at = np.arange(len(word)) + np.repeat(self.begin[symbols] - (np.cumsum(size) - size), size)
        return word, self.nodes[at], self.bits[at]


#: Contexts of a word: none, the word before, the one before that, both.
TEXT_CONTEXTS, TEXT_SETS = 4, 6 * 5 * 4


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(16))) * _U(0x7FEB352D)
    return x ^ (x >> _U(15))


def _befores(number: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hashes of the contexts in front of each word; places count from 0 in
    each text, and the text's start is a context of its own."""
    one, two = np.zeros(len(number), _U), np.zeros(len(number), _U)
    plain = number.astype(_U) + _U(1)
    one[1:], two[2:] = plain[:-1], plain[:-2]
    one[place < 1] = 0
    two[place < 2] = 0
    return np.stack([_mixed(one * _U(0x9E3779B1) + _U(1)), _mixed(two * _U(0x85EBCA6B) + _U(2)),
                     _mixed(_mixed(one * _U(0xC2B2AE35) + _U(3)) + two * _U(0x27D4EB2F))])


def _text_slot(before: np.ndarray, salt: np.ndarray, shift: np.uint32, first: int) -> np.ndarray:
    """Slots of all bits in one context."""
    x = before ^ salt
    x *= _U(0x2C1B3C6D)
    x >>= shift
    slots = x.astype(np.intp)  # what look-ups take without a copy
    slots += first
    return slots


#: Set of weights, by pairs: how often the word before, both, and the one before
#: that were seen here.
_ONE_LEVEL, _BOTH_LEVEL, _TWO_LEVEL = _steps((1, 4, 16, 64, 192), 20), _steps((1, 2, 8, 64), 4), _steps((1, 16, 192))


def _text_gate(pair: np.ndarray) -> np.ndarray:
    return _ONE_LEVEL.take(pair[1]) + _BOTH_LEVEL.take(pair[3]) + _TWO_LEVEL.take(pair[2])


def _text_start() -> np.ndarray:
    """Weights before learning: the longer context counts more, the more often
    it was seen."""
    out = np.empty((6, 5, 4, TEXT_CONTEXTS), np.float64)
    trust, pair = np.array([0.0, 0.3, 0.5, 0.6, 0.7, 0.8]), np.array([0.0, 0.3, 0.5, 0.7, 0.8])
    out[..., 3] = pair[None, :, None]
    out[..., 1] = (trust[:, None] * (1 - pair)[None, :])[:, :, None]
    out[..., 2] = 0.1 * (1 - trust)[:, None, None] * np.array([0.0, 0.5, 1.0, 1.0])
    out[..., 0] = 1 - out[..., 1:].sum(-1)
    return out.reshape(TEXT_SETS, TEXT_CONTEXTS)


@dataclass
class TextModel:
    """Pairs of counts of the slots of text contexts, weights and the adaptive
    map of the gates, and the code."""

    code: Code
    bits: int
    pairs: np.ndarray | None = None
    weights: np.ndarray | None = None  # sets x contexts
    refine: np.ndarray | None = None   # sets x buckets

    @property
    def end(self) -> int:
        return len(self.code.size) - 2

    @property
    def escape(self) -> int:
        return len(self.code.size) - 1

    @property
    def slots(self) -> int:
        return len(self.code.size) + (3 << self.bits)

    def parts(self, number: np.ndarray, place: np.ndarray, skip: int = 0):
        """(word, bit, slots of all contexts) of all bits of the words of texts
        but the first ``skip``, which are only contexts."""
        word, node, bit = self.code.spread(np.minimum(number[skip:], self.escape))
        before = _befores(number, place)[:, skip:]
        salt, shift, nodes = node.astype(_U) * _U(0x9E3779B1), _U(32 - self.bits), len(self.code.size)
        slots = [node, *(_text_slot(before[k].take(word), salt, shift, nodes + (k << self.bits)) for k in range(3))]
        return word, bit, slots

    def coded(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """log of the probability of each word's path in the code tree."""
        found = []
        for part, at, back in _cut(number, place):
            word, bit, slots = self.parts(part, at, back)
            pair = [self.pairs[s].astype(np.intp) for s in slots]
            gate = _text_gate(pair)
            weights = self.weights.take(gate, axis=0)
            x = _ODDS[pair[0]] * weights[:, 0]
            for k in range(1, TEXT_CONTEXTS):
                x += _ODDS[pair[k]] * weights[:, k]
            p = _text_refined(self.refine, x, gate.astype(np.intp))
            p -= bit == 0  # 1 - p of a bit that is 0
            np.abs(p, out=p)
            found.append(np.bincount(word, np.log(p, out=p), len(part) - back))
        return np.concatenate(found)

    def log10(self, number: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of texts but for the rare words that stand
        first in them, and which those are.  ``number``: the words of texts laid
        end to end, ``sizes`` words each, none empty."""
        n = len(number)
        begin = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(n) - begin[text]
        rare = number >= self.escape
        stood = _earlier(text, number)
        again = (stood > 0) & (rare | (number >= EVERYDAY)) & (number != self.end)

        def so_far(x: np.ndarray) -> np.ndarray:
            """How many in the text before each place."""
            total = np.concatenate([[0], np.cumsum(x)])
            return total[:-1] - total[begin][text]

        w = np.minimum((so_far(again) + 0.3) / (place + 30), 0.95) * (place > 0)
        escaped = so_far(rare)
        often = np.where(rare, escaped, stood)  # how often the symbol stood
        p = (1 - w) * np.exp(self.coded(number, place)) + w * often / np.maximum(place, 1)
        # Behind the escape: a word of this text again, or another one.
        first = rare & (stood == 0)
        repeats = so_far(rare & (stood > 0))
        share = (repeats + 0.3) / (escaped + 2) * (escaped > 0)
        p = np.where(rare, p * np.where(first, 1 - share, share * stood / np.maximum(escaped, 1)), p)
        return np.add.reduceat(np.log10(p), begin), first


def _text_refined(refine: np.ndarray, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
    y = x + np.float32(12)
    np.clip(y, 0, np.float32(23.999), out=y)
    y *= np.float32((BUCKETS - 1) / 24)
    low = y.astype(np.intp)
    y -= np.floor(y)
    low += gate * BUCKETS
    flat = refine.reshape(-1)
    fine = flat[low]
    low += 1
    up = flat[low]
    up -= fine
    up *= y
    fine += up
    p = np.negative(x)
    np.exp(p, out=p)
    p += 1
    np.reciprocal(p, out=p)
    p += fine
    p *= np.float32(0.5)
    return np.clip(p, np.float32(1e-6), np.float32(1 - 1e-6), out=p)


def _earlier(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each text's key stood in it before."""
    order = np.argsort(text << 32 | key, kind="stable")
    t, k = text[order], key[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])
    at, rank = np.arange(len(key)), np.empty(len(key), np.int64)
    rank[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return rank


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of texts laid end to end, and how many each has."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    return np.frombuffer(b"".join(column.to_pylist()), np.int32), sizes.astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], words: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers, sizes, places) of some texts at a time, about so many words or
    one text."""
    for batch in batches:
        number, sizes = _unpack(batch.column("number"))
        ends, lo = np.cumsum(sizes), 0
        while lo < len(sizes):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + words, "right")))
            n = sizes[lo:hi]
            yield number[done:ends[hi - 1]], n, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            lo = hi


def _cut(number: np.ndarray, place: np.ndarray, words: int = 1 << 15):
    """A run in pieces that overlap by the two words of the longest context:
    (numbers, places, new words' first)."""
    for lo in range(0, len(number), words):
        back = min(lo, 2)
        yield number[lo - back:lo + words], place[lo - back:lo + words], back


def _count_text(batches: Iterator[pa.RecordBatch], shared, bits: int) -> Iterator[pa.RecordBatch]:
    """(piece, counts): compressed pieces of the slots' counts."""
    model = TextModel(shared.value, bits)
    counts = np.zeros(2 * -(-model.slots // PIECE) * PIECE, np.uint32)
    one, often = np.uint32(1), np.zeros(len(model.code.size), np.int64)
    for number, _, place in _runs(batches):
        for part, at, back in _cut(number, place):
            _, bit, slots = model.parts(part, at, back)
            often += np.bincount(np.minimum(part[back:], model.escape), minlength=len(often))
            for s in slots[1:]:
                s *= 2
                s += bit
                np.add.at(counts, s, one)
    # The context of no word: as often as the symbol.
    symbol, node, bit = model.code.spread(np.arange(len(often)))
    np.add.at(counts, 2 * node + bit, often[symbol].astype(np.uint32))
    yield from _pieces(counts)


def _learn_text(batches: Iterator[pa.RecordBatch], shared, ridge: float = 30.0) -> Iterator[pa.RecordBatch]:
    """One online pass over this task's words, as ``_learn``."""
    code, bits, pairs = shared.value
    model = TextModel(code, bits)
    weights, mass = _text_start(), np.zeros(TEXT_SETS)
    curve = np.tile(ridge * np.eye(TEXT_CONTEXTS), (TEXT_SETS, 1, 1))
    hits, seen = np.zeros(TEXT_SETS * BUCKETS), np.zeros(TEXT_SETS * BUCKETS)
    for number, _, place in _runs(batches):
        for part, at, back in _cut(number, place):
            _, bit, slots = model.parts(part, at, back)
            left_out = (bit.astype(np.intp) + 1) << 16     # without the occurrence at hand
            pair = [pairs[s] + left_out for s in slots]
            gate = _text_gate(pair)
            order = np.argsort(gate, kind="stable")
            gate, bit = gate[order], bit[order].astype(np.float32)
            s, x = np.empty((TEXT_CONTEXTS, len(order)), np.float32), np.empty(len(order), np.float32)
            for k in range(TEXT_CONTEXTS):
                _ODDS.take(pair[k].take(order), out=s[k], mode="clip")
            ends = np.cumsum(np.bincount(gate, minlength=TEXT_SETS))
            spans = [(g, slice(ends[g - 1] if g else 0, ends[g])) for g in np.flatnonzero(np.diff(ends, prepend=0)).tolist()]
            for g, span in spans:
                x[span] = weights[g].astype(np.float32) @ s[:, span]
            x = np.clip(x, -12, 12)
            p = 1 / (1 + np.exp(-x))
            spot = gate * np.int32(BUCKETS) + np.round((x + np.float32(12)) * np.float32((BUCKETS - 1) / 24)).astype(np.int32)
            seen += np.bincount(spot, minlength=len(seen))
            hits += np.bincount(spot, bit, len(seen))
            err, bend = bit - p, p * (1 - p)
            slope = np.empty((len(spans), TEXT_CONTEXTS, 1))
            for k, (g, span) in enumerate(spans):
                t = s[:, span]
                curve[g] += (t * bend[span]) @ t.T
                slope[k, :, 0] = t @ err[span]
                mass[g] += span.stop - span.start
            met = [g for g, _ in spans]
            weights[met] += np.linalg.solve(curve[met], slope)[:, :, 0]
    names = ["kind", "at", "a", "b"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(weights.size, np.int32)), pa.array(np.arange(weights.size, dtype=np.int32)),
         pa.array((weights * mass[:, None]).ravel()), pa.array(np.repeat(mass, TEXT_CONTEXTS))], names)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(seen), np.int32)), pa.array(np.arange(len(seen), dtype=np.int32)),
         pa.array(hits), pa.array(seen)], names)


def text_bits(words: int) -> int:
    """Bits of the slot numbers for so many training words."""
    return int(min(max(int(words).bit_length() + 2, LEAST_BITS), MOST_BITS))


def learn_text(ranked: DataFrame, code: Code, words: int):
    """Learn the text contexts from the table ``ranked`` (number binary) of
    training texts with ``words`` words.  Returns the model and a broadcast of
    its (code, bits, pairs)."""
    spark = ranked.sparkSession
    ship(spark)
    bits = text_bits(words)
    texts, shared_code = ranked.select("number"), spark.sparkContext.broadcast(code)
    # A counting task sends its whole table: as few tasks as keep all cores at work.
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, min(4 * cores, max(words // TASK_WORDS, min(cores, words // (TASK_WORDS // 16)))))
    counts = (texts.coalesce(tasks).mapInArrow(lambda it: _count_text(it, shared_code, bits), "piece int, counts binary")
              .groupBy("piece").applyInArrow(lambda t: _add_pieces(t), "piece int, counts binary").toArrow())
    pairs = _whole(counts, TextModel(code, bits).slots)
    del counts
    shared_code.destroy()
    shared = spark.sparkContext.broadcast((code, bits, pairs))
    rows = (texts.mapInArrow(lambda it: _learn_text(it, shared), "kind int, at int, a double, b double")
            .groupBy("kind", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow())
    return assemble_text(code, bits, pairs, *(rows[c].to_numpy() for c in ("kind", "at", "a", "b"))), shared


def assemble_text(code: Code, bits: int, pairs: np.ndarray, kind: np.ndarray, at: np.ndarray,
                  a: np.ndarray, b: np.ndarray) -> TextModel:
    weights, w = _text_start(), (kind == 0) & (b > 0)
    weights.reshape(-1)[at[w]] = a[w] / b[w]
    plain = 1 / (1 + np.exp(-(np.arange(BUCKETS) * (24 / (BUCKETS - 1)) - 12)))
    hits, seen = np.tile(plain * 2, TEXT_SETS), np.full(TEXT_SETS * BUCKETS, 2.0)
    r = kind == 1
    hits[at[r]] += a[r]
    seen[at[r]] += b[r]
    return TextModel(code, bits, pairs, weights.astype(np.float32),
                     (hits / seen).astype(np.float32).reshape(TEXT_SETS, BUCKETS))


def _ranked(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Words of each text as numbers; its rare words, with how often.  Numbers:
    the rank of a frequent word, then the end, then hashes of rare words."""
    names = pa.array(shared.value, pa.binary())
    top = len(names)
    room = (1 << 31) - top - 2
    for batch in batches:
        words, sizes = _words(batch.column("_text"))
        met = words.dictionary_encode()
        code, distinct = met.indices.to_numpy(zero_copy_only=False), met.dictionary
        number = pc.index_in(distinct, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        new = np.flatnonzero(number < 0)
        is_rare = number < 0
        number[new] = top + 1 + np.fromiter((zlib.crc32(w) % room for w in distinct.take(pa.array(new)).to_pylist()),
                                            np.int64, len(new))
        text = np.repeat(np.arange(len(sizes)), sizes)
        laid = np.full(len(code) + len(sizes), top, np.int32)  # the end of a text is an empty word
        laid[np.arange(len(code)) + text] = number[code]
        rare_at = is_rare[code]
        key, often = np.unique(text[rare_at] << 32 | code[rare_at], return_counts=True)
        ends = np.concatenate([[0], np.cumsum(np.bincount(key >> 32, minlength=len(sizes)))]).astype(np.int32)
        rare = distinct.take(pa.array(key & 0xFFFFFFFF))
        length = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)])
        last, till = np.cumsum(sizes), np.cumsum(sizes + 1)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("_id", "_out", "learn")), pa.array(sizes + 1),
             pa.array(length[last] - length[last - sizes] + sizes + 1),
             pa.array([laid[b - n - 1:b].tobytes() for n, b in zip(sizes.tolist(), till.tolist())], pa.binary()),
             pa.ListArray.from_arrays(ends, rare), pa.ListArray.from_arrays(ends, pa.array(often, pa.int64()))],
            ["_id", "_out", "learn", "tokens", "bytes", "number", "rare", "often"])


def _score_texts(batches: Iterator[pa.RecordBatch], shared, weights, refine, counts, base) -> Iterator[pa.RecordBatch]:
    model = TextModel(*shared.value, weights, refine)
    counts, base = counts.value, base.value
    known = (counts > 0).astype(np.int64)
    # One more for rare words, which are added up elsewhere.
    known, base = np.append(known, 0), np.append(base, 0.0)
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [[], [], []]
        for number, sizes, _ in _runs([batch]):
            at, begin = np.minimum(number, model.escape), np.cumsum(sizes) - sizes
            for c, v in zip(cols, (np.add.reduceat(known[at], begin), np.add.reduceat(base[at], begin),
                                   model.log10(number, sizes)[0])):
                c.append(v)
        names = ["row", "_id", "_out", "tokens", "bytes"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), *(pa.array(np.concatenate(c), t) for c, t in
                                                  zip(cols, (pa.int64(), pa.float64(), pa.float64())))],
            [*names, "seen", "base", "mix"])


def score_texts(docs: DataFrame, *, learn: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                frequent: int = FREQUENT) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte) of every document.

    ``learn``: true for documents to learn from.  ``base_score``: log10 of the
    smoothed unigram probability of its words; ``score``: log10 of the model's
    probability of the text; ``bits_per_byte``: its total bits over the bytes
    of the words and the blank or end behind each."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(col(id_col).alias("_id"), held_out.alias("_out"), learn.alias("learn"),
                       col(text_col).alias("_text"))
    words = stored(rows.select("learn", "_text").mapInArrow(_count_words, "word binary, c long")
                   .groupBy("word").agg(F.sum("c").alias("c")), "words")[0]
    n, v, ends, once = words.agg(
        F.sum("c"), F.count_if(F.col("c") > 0), F.sum(F.when(F.col("word") == b"", F.col("c"))),
        F.count_if((F.col("c") == 1) & (F.col("word") != b""))).first()
    n, v, ends = n or 0, v or 0, ends or 0
    top = words.where(F.col("c") >= LEAST_COUNT).where(F.col("word") != b"").orderBy(F.desc("c"), "word").limit(frequent).toArrow()
    names, often = top["word"].to_pylist(), top["c"].to_numpy()
    rare_count = n - ends - int(often.sum())
    # Words that are rare: their counts, or their spelling if they are new.
    is_top = F.col("c") >= LEAST_COUNT
    if len(names) == frequent:           # the limit cuts among words of one count
        last = int(often[-1])
        is_top = (F.col("c") > last) | ((F.col("c") == last) & (F.col("word") <= names[-1]))
    rare_words = words.where((F.col("word") != b"") & ~is_top)
    base = F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))
    # As many new words are to be expected as stand just once now.
    new = (once + 1) / (rare_count + 2)
    # New words are spelled like the words there are, each taken once: those that
    # were met often say more of themselves than of new ones.
    speller, shared = learn_mixer(words.where("c > 0").select("word", F.lit(1).cast("long").alias("c"), F.col("c").alias("often")),
                          frequent, "often")
    weights, refine = speller.weights, speller.refine
    spelled = rare_words.where("c = 0").mapInArrow(lambda it: _score_words(it, shared, weights, refine), "word binary, c long, spelled double")
    known = rare_words.where("c > 0").select(
        "word", F.lit(1).cast("long").alias("known"), base.alias("b"),
        F.log10(F.col("c") / F.lit(float(max(rare_count, 1))) * F.lit(1 - new)).alias("s"))
    unknown = spelled.select("word", F.lit(0).cast("long").alias("known"), base.alias("b"),
                             (F.col("spelled") + float(np.log10(new))).alias("s"))
    names_shared = spark.sparkContext.broadcast(names)
    kind = rows.schema["_id"].dataType.simpleString()
    ranked = rows.mapInArrow(
        lambda it: _ranked(it, names_shared), f"_id {kind}, _out boolean, learn boolean, tokens long, bytes long, "
        "number binary, rare array<binary>, often array<long>")
    ranked = stored(ranked.withColumn("row", F.monotonically_increasing_id()), "documents")[0]
    code = Code.of(np.concatenate([often, [ends, rare_count]]) + 1)
    model, pairs = learn_text(ranked.where("learn"), code, n)
    counts = np.concatenate([often, [ends]])
    tops = [spark.sparkContext.broadcast(x) for x in (counts, np.log10((counts + 1) / float(n + v + 1)))]
    mixing, refining = model.weights, model.refine
    part = ranked.select("row", "_id", "_out", "tokens", "bytes", "number").mapInArrow(
        lambda it: _score_texts(it, pairs, mixing, refining, *tops),
        f"row long, _id {kind}, _out boolean, tokens long, bytes long, seen long, base double, mix double")
    rare = ranked.select("row", F.inline(F.arrays_zip("rare", "often"))).toDF("row", "word", "often")
    # Frequent words are gone, so no word is a hot key of this join; each stands once on the side that is hashed.
    more = (rare.join(known.unionByName(unknown).hint("shuffle_hash"), "word").groupBy("row")
            .agg(F.sum(F.col("known") * F.col("often")).alias("k"), F.sum(F.col("b") * F.col("often")).alias("b"),
                 F.sum("s").alias("s")))  # once a text: where the word first stands
    zero, score = F.lit(0), F.col("mix") + F.coalesce("s", F.lit(0.0))
    return (part.join(more, "row", "left").select(
        F.col("_id").alias(id_col), F.col("_out").alias("held_out"), F.col("tokens").alias("n_tokens"),
        (F.col("seen") + F.coalesce("k", zero)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        score.alias("score"), (score * (-1 / np.log10(2)) / F.col("bytes")).alias("bits_per_byte")))


