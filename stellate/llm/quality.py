"""Quality of documents by histogram gradient-boosted trees.

Each text is reduced to a few statistics (see ``FEATURES``).  The trees are fit
on the driver, on at most ``sample`` labelled rows (a documented bound: the
labelled rows with the smallest hash of their id), over binned statistics:
each level of a tree is found from one histogram of gradients a node.  A tree
is complete, so it is three flat arrays, and a batch of documents walks all
trees at once in numpy.  Scoring covers every document and its whole text.

Defined cases: a null text is an empty text; an empty text has statistics of 0
and is scored like any other; labels that are null or not 0 or 1 are left out;
of several labels of one id the larger one holds; without labels, or with one
class alone, the score is the smoothed share of label 1.  Of rows that share an
id the least text is learned from; all rows are scored.  A null id has no label; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, learnable, ship

#: Most labelled rows that the trees are fit on.
SAMPLE, THRESHOLD = 20_000, 0.3

FEATURES = ("log_bytes", "log_words", "log_lines", "lower", "upper", "digit", "space", "feed", "punctuation",
            "beyond_ascii", "top_mark", "entropy", "word_mean", "word_std", "word_max", "upper_words", "marked_words",
            "stopped_words", "distinct_words", "top_word", "distinct_pairs", "same_neighbours", "distinct_lines",
            "line_mean", "one_letter_words")

_CLASSES = np.zeros((256, 7))
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), (32,), (10,),
                             [b for b in range(33, 127) if not chr(b).isalnum()], range(128, 256))):
    _CLASSES[list(_bytes), _k] = 1
_MARKS = np.flatnonzero(_CLASSES[:, 5])
_IS_MARK = _CLASSES[:, 5] > 0


def statistics(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    if not data:
        return np.zeros(len(FEATURES))
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts @ _CLASSES / n
    p = counts[counts > 0] / n
    words, lines = data.split(), data.split(b"\n")
    head = [np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), *share,
            counts[_MARKS].max() / n, -(p * np.log2(p)).sum()]
    tail = [len(set(lines)) / len(lines), n / len(lines)]
    if not words:
        return np.array([*head, *[0.0] * 10, *tail, 0.0])
    m = len(words)
    size = np.fromiter(map(len, words), np.int64, m)
    last = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    seen = Counter(words)
    pairs = max(1, m - 1)
    return np.array([
        *head, size.mean(), size.std(), np.log1p(size.max()), sum(c for w, c in seen.items() if w.isupper()) / m,
        _IS_MARK[last].mean(), ((last == 46) | (last == 44)).mean(), len(seen) / m, max(seen.values()) / m,
        len(set(zip(words, words[1:]))) / pairs, sum(map(bytes.__eq__, words, words[1:])) / pairs, *tail,
        (size == 1).mean()])


# ---- trees ----------------------------------------------------------------

@dataclass
class Trees:
    """Complete trees of one depth as flat arrays: node k has children 2k + 1
    and 2k + 2; a value above the threshold goes to the latter."""

    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray       # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.ndim == 2 else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            raw += leaf[node - inner]
        return 1 / (1 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray, *, rounds: int = 120, depth: int = 4, rate: float = 0.15, bins: int = 64,
              l2: float = 1.0, min_hessian: float = 2.0) -> Trees:
    n, prior = len(y), (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(prior / (1 - prior)))
    empty = Trees(np.empty((0, 0), int), np.empty((0, 0)), np.empty((0, 1)), base)
    if n == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    width, slots = x.shape[1], x.shape[1] * bins
    offset = np.arange(width) * bins
    # A cut behind the last one of a statistic would split nothing.
    valid = np.concatenate([np.arange(bins) < len(c) for c in cuts])
    inner = (1 << depth) - 1
    feature, threshold = np.zeros((rounds, inner), int), np.full((rounds, inner), np.inf)
    leaf, raw = np.zeros((rounds, 1 << depth)), np.full(n, base)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, m = (1 << level) - 1, 1 << level
            at = ((node[:, None] - first) * slots + offset + code).ravel()
            gs, hs = (np.bincount(at, np.repeat(v, width), m * slots).reshape(m, width, bins) for v in (g, h))
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            ga, ha = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + l2) + (ga - gl)**2 / (ha - hl + l2) - ga**2 / (ha + l2)
            gain[(hl < min_hessian) | (ha - hl < min_hessian)] = 0
            gain = np.where(valid, gain.reshape(m, slots), 0)
            best = gain.argmax(1)
            for k in range(m):
                if gain[k, best[k]] > 1e-9:
                    j, b = divmod(int(best[k]), bins)
                    feature[r, first + k], threshold[r, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[r, node]] > threshold[r, node])
        node -= inner
        gsum, hsum = (np.bincount(node, v, 1 << depth) for v in (g, h))
        leaf[r] = -rate * gsum / (hsum + l2)
        raw += leaf[r, node]
    return Trees(feature, threshold, leaf, base)


# ---- documents ------------------------------------------------------------

def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py()).tolist() for t in batch.column("_text")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", folds: int = 5, fold: int = 0, sample: int = SAMPLE,
                seed: int = 10) -> Trees:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    ident = col(id_col)
    marked = (labels.filter(col(label_col).isin(0, 1) & learnable(ident, folds, fold))
              .groupBy(ident.alias("_label_id")).agg(F.max(col(label_col)).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.lit(seed), "_label_id"), "_label_id").limit(sample))
    rows = (docs.select(ident.alias("_id"), col(text_col).alias("_text"))
            .join(F.broadcast(marked), F.col("_id") == F.col("_label_id"))
            .groupBy("_id").agg(F.max("label").alias("label"), F.min("_text").alias("_text"))
            .select("label", "_text"))
    got = rows.mapInArrow(_statistics_of, "label int, x array<double>").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = got["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the fit doesn't depend on the order of rows
    return fit_trees(x[order], y[order])


def _scored(batches: Iterator[pa.RecordBatch], shared, text: int, keep: float | None) -> Iterator[pa.RecordBatch]:
    trees = shared.value
    for batch in batches:
        x = np.array([statistics(t.as_py()) for t in batch.column(text)]).reshape(-1, len(FEATURES))
        score = trees.score(x)
        if keep is not None:
            yield batch.filter(pa.array(score >= keep))
        else:
            arrays = [c for i, c in enumerate(batch.columns) if i != text]
            names = [c for i, c in enumerate(batch.schema.names) if i != text]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(score)], [*names, "score"])


def score_quality(docs: DataFrame, trees: Trees, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return (rows.mapInArrow(lambda it: _scored(it, shared, 1, None), f"_id {kind}, score double")
            .withColumnRenamed("_id", id_col))


def keep_quality(docs: DataFrame, trees: Trees, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score below the threshold."""
    ship(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _scored(it, shared, at, threshold), docs.schema)
