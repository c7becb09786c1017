"""Languages of texts: script ranges, word scores, and Viterbi over words.

Learned from labelled texts: how often each language has each hashed byte
trigram of its words, and which scripts its letters come from.  A word's script
narrows the languages that it can be in; its score in each of them is the log
probability of its trigrams.  Viterbi over the words of a text, with a penalty
for each change of language, labels spans of mixed-language text; the text's
language is the one with most letters.

The model has at most ``BUCKETS`` + 32 numbers a language, whatever the data.
All texts are read whole; the words of many texts are walked side by side.

Defined cases: a null text, a text without letters, and any text when nothing
was learned are ``und`` with score 0; words without letters take the language
of their neighbours; of languages with equally many letters the first in code
point order is taken.  A null id is an id like others, but is never learned from
by the query; rows that repeat are labelled each, an empty table gives no rows and
a model that knows nothing, and extra columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col, ship

BUCKETS, PENALTY, UNDEFINED = 1 << 15, 8.0, "und"
#: Least log probability of a word below that of its best language.
FLOOR = -20.0

# First code point of each range and its script.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"))
SCRIPTS = tuple(dict.fromkeys(s for _, s in SCRIPT_RANGES))
_FIRST = np.array([a for a, _ in SCRIPT_RANGES])
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])


def word_scripts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Script of the first letter of each word (-1: no letter), and letters."""
    letters = [[c for c in w if c.isalpha()] for w in words]
    first = np.array([ord(x[0]) if x else -1 for x in letters], np.int64)
    script = _SCRIPT_OF[np.searchsorted(_FIRST, first, "right") - 1]
    return np.where(first < 0, -1, script), np.fromiter(map(len, letters), np.int64, len(words))


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of ' word ', and how many each word has."""
    coded = [w.encode() for w in words]
    size = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"  " + b"  ".join(coded) + b"  ", np.uint8).astype(np.uint32)
    # Word k starts behind two blanks; its trigrams start at the second one.
    start = np.cumsum(size + 2) - size
    at = np.repeat(start - 1 - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    h = ((data[at] << 16 | data[at + 1] << 8 | data[at + 2]) * np.uint32(0x9E3779B1)) >> np.uint32(13)
    return h % np.uint32(BUCKETS), size


# ---- learning -------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n); scripts are counted in buckets below 0."""
    for batch in batches:
        words: dict[str, Counter] = defaultdict(Counter)
        for text, lang in zip(batch.column("_text"), batch.column("_lang").to_pylist()):
            words[lang].update(text.as_py().lower().split())
        for lang, seen in words.items():
            if not seen:
                continue
            names, times = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
            script, letters = word_scripts(names)
            has = np.flatnonzero(script >= 0)
            if not len(has):
                continue
            bucket, size = trigrams([names[i] for i in has])
            n = np.bincount(bucket, np.repeat(times[has], size), BUCKETS)
            s = np.bincount(script[has], (times * letters)[has], len(SCRIPTS))
            k, j = np.flatnonzero(n), np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(k) + len(j))), pa.array(np.concatenate([k, -1 - j]), pa.int32()),
                 pa.array(np.concatenate([n[k], s[j]]).astype(np.int64))], ["lang", "bucket", "n"])


@dataclass
class LanguageModel:
    languages: list[str]
    logp: np.ndarray     # buckets x languages
    scripts: np.ndarray  # scripts x languages: may a word be in this language

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words below that of the best language, and their letters."""
        script, letters = word_scripts(words)
        score = np.zeros((len(words), len(self.languages)), np.float32)
        has = np.flatnonzero(script >= 0)
        for lo in range(0, len(has), 20_000):
            some = has[lo:lo + 20_000]
            bucket, size = trigrams([words[i] for i in some])
            s = np.add.reduceat(self.logp[bucket], np.cumsum(size) - size)
            s = np.where(self.scripts[script[some]], s, -np.inf)
            score[some] = np.maximum(s - s.max(1, keepdims=True), FLOOR)
        return score, letters


def learn_languages(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                    where: Column | None = None, script_share: float = 0.001) -> LanguageModel:
    """Learn from all rows with a text and a language (those in ``where``)."""
    ship(docs.sparkSession)
    rows = docs.filter(where) if where is not None else docs
    rows = rows.select(col(text_col).alias("_text"), col(lang_col).alias("_lang")).dropna()
    got = (rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket")
           .agg(F.sum("n").alias("n")).toArrow())  # bounded: BUCKETS + scripts a language
    names, bucket, n = got["lang"].to_pylist(), got["bucket"].to_numpy(), got["n"].to_numpy()
    languages = sorted(set(names))
    index = np.array([languages.index(x) for x in names], np.int64) if len(languages) < 64 else \
        np.searchsorted(np.array(languages), np.array(names))
    counts, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPTS), len(languages)))
    at = bucket >= 0
    counts[bucket[at], index[at]] = n[at]
    scripts[-1 - bucket[~at], index[~at]] = n[~at]
    logp = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
    allowed = scripts > script_share * scripts.sum(0)
    allowed[~allowed.any(1)] = True  # a script that nobody uses narrows nothing
    return LanguageModel(languages, logp, allowed)


# ---- labelling ------------------------------------------------------------

class _Words(dict):
    """Numbers of words; new ones wait for their scores."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


def viterbi(score: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word of texts laid end to end (``sizes`` words
    each): word scores, less the penalty for each change of language.  Step t
    looks at word t of all texts that have one."""
    total, k = score.shape
    order = np.argsort(-sizes, kind="stable")
    start, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    best, label = np.zeros((len(sizes), k), np.float32), np.zeros(total, np.int16)
    came, changed = np.zeros(total, np.int16), np.zeros((total, k), bool)
    for t in range(longest):
        m = active[t]
        now, at = best[:m], start[:m] + t
        if t:
            top = now.argmax(1)
            level = now[np.arange(m), top][:, None] - penalty
            came[at], changed[at] = top, now < level
            now = np.maximum(now, level)
        best[:m] = now + score[at]
    state = best.argmax(1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at, s = start[:m] + t, state[:m]
        label[at] = s
        state[:m] = np.where(changed[at, s], came[at], s)
    return label


def _label(batches: Iterator[pa.RecordBatch], shared, penalty: float, max_words: int,
           max_step: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    model: LanguageModel = shared.value
    k = max(1, len(model.languages))
    known, scores, letters = _Words(), np.empty((0, k), np.float32), np.empty(0, np.int64)

    def flush(texts: list[np.ndarray]) -> tuple[list, list, list]:
        nonlocal known, scores, letters
        if known.new:
            s, n = model.word_scores(known.new)
            scores, letters = np.concatenate([scores, s]), np.concatenate([letters, n])
            known.new = []
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))  # none, if a batch ends with a flush
        words = np.concatenate(texts) if texts else np.empty(0, np.int64)
        label = viterbi(scores[words], sizes, penalty)
        doc, weight = np.repeat(np.arange(len(texts)), sizes), letters[words]
        share = np.bincount(doc * k + label, weight, len(texts) * k).reshape(-1, k)
        total, top = share.sum(1), share.argmax(1)
        names = [model.languages[t] if n else UNDEFINED for t, n in zip(top, total)]
        score = np.where(total > 0, share.max(1) / np.maximum(total, 1), 0.0)
        # A span starts where the label or the text changes.
        new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])])) \
            if len(words) else np.empty(0, np.int64)
        first = (np.cumsum(sizes) - sizes)[doc[new]]
        size = np.diff(np.append(new, len(words)))
        spans: list[list] = [[] for _ in texts]
        for d, lang, a, n in zip(doc[new].tolist(), label[new].tolist(), (new - first).tolist(), size.tolist()):
            spans[d].append({"lang": model.languages[lang] if total[d] else UNDEFINED, "first": a, "words": n})
        if len(known) > max_words:
            known, scores, letters = _Words(), np.empty((0, k), np.float32), np.empty(0, np.int64)
        return names, score.tolist(), spans

    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
    for batch in batches:
        texts, held, out = [], 0, ([], [], [])
        for text in batch.column("_text"):
            words = (text.as_py() or "").lower().split() if model.languages else []
            texts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            held += len(words)
            if held * k > max_step:
                for a, b in zip(out, flush(texts)):
                    a.extend(b)
                texts, held = [], 0
        for a, b in zip(out, flush(texts)):
            a.extend(b)
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(out[0], pa.string()),
                                          pa.array(out[1], pa.float64()), pa.array(out[2], kind)],
                                         ["_id", "lang_pred", "score", "spans"])


def label_languages(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text",
                    penalty: float = PENALTY, max_words: int = 500_000) -> DataFrame:
    """(id, lang_pred, score, spans) of every document.  ``score``: the share
    of the text's letters in that language; ``spans``: runs of words (split at
    white space) and their language."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda it: _label(it, shared, penalty, max_words),
        f"_id {kind}, lang_pred string, score double, spans array<struct<lang:string,first:bigint,words:bigint>>",
    ).withColumnRenamed("_id", id_col)
