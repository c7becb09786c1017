"""Token ids of whole texts with the ``tokenizers`` library, inside tasks.

The library is exact but slow on running text, and a byte-level BPE that
splits words at white space never merges across the boundary in front of a
word.  So each batch is cut into units (a separator and the word behind it) by
Arrow, repeated units are counted once, and only units that this worker has
not met go to the library.  The ids are the library's own: those of a text are
those of its units in order (the tests compare with encoding whole texts).
"""

from __future__ import annotations

import codecs
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units of a text with any white space.  A single blank belongs to the word
#: behind it; of a longer run, the last blank does.
_UNITS = re.compile(r" ?\S+|\s+(?!\S)|\s")
#: Stands for a line feed in front of a word; a text that holds it, or
#: controls that Python alone calls white space, is cut by ``_UNITS``.
_FEED = "\x00"
#: Marks cut from the end of a unit before it is looked up.
_MARKS = ".,;:!?*&$%#|)]}"
_CONTROL = "[\\x00\\x02\\x1c-\\x1f]"


def tokenizer_source(path: str) -> str:
    """The tokenizer file as text: read on the driver and shipped to tasks
    (its size is that of the vocabulary, whatever the data)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def load_tokenizer(source: str):
    """A tokenizer from its JSON text; special strings in a text are text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(source)
    tok.encode_special_tokens = True
    return tok


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes each byte: printable ones as they
    are, the others as letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: The letter of each byte, as a decoding table.
_LETTERS = "".join(_byte_letters()[b] for b in range(256))
#: Pieces that are Latin letters with or without marks behind them: most of
#: running text.  They are taken apart by Arrow, all others one by one.
_WORD = f"^{_FEED}?[A-Za-zÀ-ÖØ-öø-ÿ]+"
_PLAIN = f"{_WORD}[{re.escape(_MARKS)}]*$"


class UnitEncoder:
    """Ids of texts.  Remembers the ids of up to ``max_units`` units that came
    at least twice in a part of the data; all others only for that part."""

    def __init__(self, source: str, max_units: int = 500_000):
        self.tok, self.max_units = load_tokenizer(source), max_units
        # A byte-level vocabulary writes each byte of a token as one character.
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        # Slot 0 stands for pieces that are no unit by themselves.
        self.known, self.slot_of = pa.array([], pa.large_string()), np.empty(0, np.int32)
        self.keeping: list[tuple[pa.Array, np.ndarray]] = []
        self.bare: dict[str, int] = {}
        self.kept, self.slots, self.used = (1, 0), 1, 0
        self.ids = np.empty(1 << 16, np.int32)
        self.start, self.count = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _forget(self) -> None:
        """Drop the units of the last part of the data but those to keep, which
        move behind the units known so far."""
        self.bare = {}
        if not self.keeping:
            self.slots, self.used = self.kept
            return
        at = np.concatenate([slots for _, slots in self.keeping])
        ids, ends = self._flat(at)
        counts = np.diff(ends, prepend=0)
        self.slots, self.used = self.kept
        moved = self._append(ids, ends - counts, counts)
        self.kept = (self.slots, self.used)
        self.known = pa.concat_arrays([self.known, *(keys for keys, _ in self.keeping)])
        self.slot_of = np.concatenate([self.slot_of, np.where(at > 0, moved, 0)]).astype(np.int32)
        self.keeping = []

    def _append(self, ids: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Slots of new units."""
        n, m = self.slots, len(counts)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + m > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.count = np.concatenate([self.count, np.empty_like(self.count)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[n:n + m] = first + self.used
        self.count[n:n + m] = counts
        self.used += len(ids)
        self.slots += m
        return np.arange(n, n + m, dtype=np.int32)

    def _learn_words(self, words: list[str]) -> np.ndarray:
        """Slots of new units that are a blank and letters (given without the
        blank), by the model."""
        tokenize, feed, slots = self.tok.model.tokenize, _LETTERS[10], []
        for lo in range(0, len(words), 4096):
            part = (" " + "\n ".join(words[lo:lo + 4096])).encode()
            found = [[t.id for t in tokenize(w)] for w in codecs.charmap_decode(part, "strict", _LETTERS)[0].split(feed)]
            counts = np.fromiter(map(len, found), np.int32, len(found))
            slots.append(self._append(np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())),
                                      np.cumsum(counts, dtype=np.int32) - counts, counts))
        return np.concatenate(slots) if slots else np.empty(0, np.int32)

    def _learn(self, units: list[str]) -> np.ndarray:
        """Slots of new units.  A blank and letters go to the model itself, as
        nothing splits them.  Other units that begin with one separator are
        encoded many at a time and cut where the bytes of each end; a bare
        word is encoded behind a line feed, whose id is left out again."""
        slots, words, blank, other = np.empty(len(units), np.int32), [], [], []
        for i, u in enumerate(units):
            if u[0] == " " and u[1:].isalpha():
                words.append(i)
            else:
                (blank if u.isspace() else other).append(i)
        slots[words] = self._learn_words([units[i][1:] for i in words])
        for i in blank:
            ids = np.array(self.tok.encode(units[i], add_special_tokens=False).ids, np.int32)
            slots[i] = self._append(ids, np.zeros(1, np.int32), np.array([len(ids)], np.int32))[0]
        for lo in range(0, len(other), 4096):
            part = [units[i] for i in other[lo:lo + 4096]]
            bare = np.fromiter((u[0] not in " \n" for u in part), bool, len(part))
            text = [("\n" + u) if b else u for u, b in zip(part, bare)]
            sizes = np.fromiter((len(u.encode()) for u in text), np.int64, len(part))
            ids = np.array(self.tok.encode("".join(text), add_special_tokens=False).ids, np.int32)
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes)) + 1
            first = np.concatenate([[0], ends[:-1]])
            slots[other[lo:lo + 4096]] = self._append(ids, (first + bare).astype(np.int32),
                                                      (ends - first - bare).astype(np.int32))
        return slots

    def _find(self, keys: pa.Array) -> np.ndarray:
        """Slots of pieces that are known; -1 for the others."""
        slots = np.full(len(keys), -1, np.int32)
        if len(keys) and len(self.known):
            at = pc.fill_null(pc.index_in(keys, value_set=self.known), -1).to_numpy(zero_copy_only=False)
            has = at >= 0
            slots[has] = self.slot_of[at[has]]
        return slots

    def _find_bare(self, units: list[str]) -> np.ndarray:
        """Slots of units by themselves, as they stand; new ones are learned."""
        new = [u for u in dict.fromkeys(units) if u not in self.bare]
        self.bare.update(zip(new, self._learn(new).tolist()))
        return np.fromiter(map(self.bare.__getitem__, units), np.int32, len(units))

    def _keep(self, keys: pa.Array, slots: np.ndarray, which: np.ndarray) -> None:
        if which.any():
            self.keeping.append((keys.filter(pa.array(which)), slots[which]))

    def _add(self, pieces: pa.Array, keep: np.ndarray) -> np.ndarray:
        """Slots of new pieces (``_FEED`` in front: behind a line feed, else a
        blank); 0 if they are no unit by themselves."""
        plain = pc.match_substring_regex(pieces, _PLAIN)
        at = plain.to_numpy(zero_copy_only=False)
        slots = np.empty(len(pieces), np.int32)
        slots[at] = self._add_plain(pieces.filter(plain), keep[at])
        slots[~at] = self._add_other(pieces.filter(pc.invert(plain)), keep[~at])
        return slots

    def _add_plain(self, pieces: pa.Array, keep: np.ndarray) -> np.ndarray:
        """Slots of letters with or without marks behind them."""
        head = pc.ascii_rtrim(pieces, characters=_MARKS)
        joint = pc.not_equal(pc.binary_length(pieces), pc.binary_length(head)).to_numpy(zero_copy_only=False)
        head = head.dictionary_encode()
        heads, row = head.dictionary, head.indices.to_numpy(zero_copy_only=False)
        at = self._find(heads)
        fed = pc.starts_with(heads, _FEED).to_numpy(zero_copy_only=False)
        new, new_fed = (at < 0) & ~fed, (at < 0) & fed
        at[new] = self._learn_words(heads.filter(pa.array(new)).to_pylist())
        at[new_fed] = self._learn(["\n" + h[1:] for h in heads.filter(pa.array(new_fed)).to_pylist()])
        self._keep(heads, at, (new | new_fed) & (np.bincount(row[keep], minlength=len(heads)) > 0))
        slots = at[row]
        if joint.any():
            # Marks behind a letter are never merged with it.
            mark = pc.replace_substring_regex(pieces.filter(pa.array(joint)), _WORD, "").dictionary_encode()
            marks = self._find_bare(mark.dictionary.to_pylist())[mark.indices.to_numpy(zero_copy_only=False)]
            slots[joint] = self._add_pairs(slots[joint], marks)
            self._keep(pieces, slots, joint & keep)
        return slots

    def _add_pairs(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Slots of pieces that are two units each, by their slots."""
        ids, ends = self._flat(np.stack([one, two], axis=1).ravel())
        ends = ends[1::2]
        counts = np.diff(ends, prepend=0)
        return self._append(ids, ends - counts, counts)

    def _add_other(self, pieces: pa.Array, keep: np.ndarray) -> np.ndarray:
        """Slots of pieces of any form."""
        slots, heads, row, head_of, joint, marks = np.zeros(len(pieces), np.int32), {}, [], [], [], []
        for i, piece in enumerate(pieces.to_pylist()):
            body = piece[1:] if piece[:1] == _FEED else piece
            if not body or body[0].isspace() or body[-1].isspace():
                continue
            head = body.rstrip(_MARKS)
            if len(head) < len(body) and head and head[-1].isalnum():
                # Marks behind a letter or digit are never merged with it.
                joint.append(i)
                marks.append(body[len(head):])
                piece = piece[:len(piece) - len(marks[-1])]
            row.append(i)
            head_of.append(heads.setdefault(piece, len(heads)))
        found, row, head_of, joint = pa.array(heads, pa.large_string()), *(np.array(x, np.int64) for x in (row, head_of, joint))
        at = self._find(found)
        new = at < 0
        at[new] = self._learn([("\n" + p[1:]) if p[:1] == _FEED else " " + p for p in found.filter(pa.array(new)).to_pylist()])
        self._keep(found, at, new & (np.bincount(head_of[keep[row]], minlength=len(at)) > 0))
        slots[row] = at[head_of]
        whole = np.ones(len(pieces), bool)
        whole[row] = False
        if len(joint):
            slots[joint] = self._add_pairs(slots[joint], self._find_bare(marks))
            whole[joint] = True
        self._keep(pieces, slots, whole & keep)
        return slots

    def _slots(self, words: pa.Array, times: np.ndarray) -> np.ndarray:
        slots = self._find(words)
        new = np.flatnonzero(slots < 0)
        if len(new):
            # Marks double the units at most; room for both.
            room, keep = max(0, (self.max_units - len(self.known)) // 2), times[new] > 1
            slots[new] = self._add(words.take(pa.array(new)), keep & (np.cumsum(keep) <= room))
        return slots

    def _flat(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units in slots ``at`` in order, and where each ends."""
        n = self.count[at]
        ends = np.cumsum(n, dtype=np.int32)
        total = int(ends[-1]) if len(ends) else 0
        step = np.ones(total, np.int32)
        has = n > 0
        if total:
            # Positions run on by one inside a unit and jump between units.
            s, e = self.start[at][has], (self.start[at] + n)[has]
            step[0] = s[0]
            step[(ends - n)[has][1:]] = s[1:] - e[:-1] + 1
        return self.ids[np.cumsum(step, dtype=np.int32)], ends

    def encode(self, texts: pa.Array):
        """Yield ``(row, ids)`` for each text in order; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):  # about 12 MB of text at a time, or one text
            done = int(size[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, done + (12 << 20), "right")))
            for i, ids in self._encode(texts.slice(lo, hi - lo)):
                yield lo + i, ids
            lo = hi
            # The allocator holds on to what a part needed: hundreds of MB a worker.
            pa.default_memory_pool().release_unused()

    def _encode(self, texts: pa.Array):
        odd = pc.match_substring_regex(texts, _CONTROL).to_numpy(zero_copy_only=False)
        odd |= pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
        marked = pc.binary_join_element_wise(
            pa.scalar("", pa.large_string()), pc.replace_substring(texts, "\n", " " + _FEED),
            pa.scalar(_FEED, pa.large_string()))
        pieces = pc.split_pattern(marked, " ")
        bounds = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        where, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        del marked, pieces, coded
        self._forget()
        slot = self._slots(words, np.bincount(where, minlength=len(words)))[where]
        broken = np.flatnonzero(slot == 0)
        odd[np.searchsorted(bounds, broken, "right") - 1] = True
        lo = 0
        while lo < len(texts):
            # About a quarter of a million units at a time.
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + 250_000, "right")) - 1)
            flat, ends = self._flat(slot[bounds[lo]:bounds[hi]])
            edge = np.concatenate([[0], ends])[bounds[lo:hi + 1] - bounds[lo]]
            for i in range(lo, hi):
                yield i, self._any(texts[i].as_py()) if odd[i] else flat[edge[i - lo] + 1:edge[i - lo + 1]]
            lo = hi

    def _any(self, text: str) -> np.ndarray:
        """Ids of a text with any white space and any controls."""
        if not text:
            return np.empty(0, np.int32)
        return self._flat(self._find_bare(_UNITS.findall(text)))[0]


_encoders: dict[int, UnitEncoder] = {}


def encoder(source: str) -> UnitEncoder:
    """This worker's encoder; kept between tasks, so known units stay known."""
    key = hash(source)
    if key not in _encoders:
        # Arrow's own allocator holds on to what a batch needed at its widest.
        pa.set_memory_pool(pa.system_memory_pool())
        _encoders.clear()
        _encoders[key] = UnitEncoder(source)
    return _encoders[key]
