"""Cut texts where a tokenizer would cut anyway, and encode each distinct piece once a worker.

``cuts_before_space`` gives borders that no pre-token of the byte-level, word
or metaspace tokenizers can cross, so the tokens of a text are the tokens of
its pieces, in order.  Pieces are named by a 64-bit hash; a worker keeps the
tokens of those it has met, and forgets all of them beyond ``LIMIT`` pieces
(only speed depends on that).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from courtline.llm import textops as T

LIMIT = 800_000
#: Pieces a call of a library gets.
CALL = 4096

_PLAIN = np.zeros(256, dtype=bool)       # printable ASCII
_PLAIN[0x21:0x7F] = True
_CLOSING = np.zeros(256, dtype=bool)     # marks that end a word; the apostrophe may belong to it
_CLOSING[[ord(c) for c in '.,;:!?)"']] = True


def cuts_before_space(data: np.ndarray, offsets: np.ndarray, *, blanks: bytes = b" \n", marks: bool = False) -> np.ndarray:
    """Starts of pieces.  A piece starts at a text's start, and at a blank after
    a character that surely is no white space; with ``marks`` also at a closing
    mark after a letter (a-z, A-Z or a Latin-1 letter)."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets[:-1]] = True
    cut[n] = False
    if n < 2:
        return np.flatnonzero(cut)
    blank = np.zeros(256, dtype=bool)
    blank[list(blanks)] = True
    prev, here = data[:-1], data[1:]
    at = np.flatnonzero(blank[here] & (_PLAIN[prev] | (prev >= 0x80))) + 1
    high = at[data[at - 1] >= 0x80]
    cut[at] = True
    if len(high):  # white space outside ASCII: U+0085, U+00A0 end in C2 xx, the others start with E1, E2 or E3
        odd = (data[high - 2] == 0xC2) | np.isin(data[np.maximum(high - 3, 0)], (0xE1, 0xE2, 0xE3))
        cut[high[odd]] = False
        cut[offsets[:-1][offsets[:-1] < n]] = True
    if marks:
        latin = (prev >= 0x80) & (prev <= 0xBF) & (prev != 0x97) & (prev != 0xB7)
        latin[1:] &= data[:-2] == 0xC3
        latin[0] = False
        cut[np.flatnonzero(_CLOSING[here] & (T.IS_LETTER[prev] | latin)) + 1] = True
    return np.flatnonzero(cut)


def _grown(x: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.concatenate([x, more])


class ChunkCache:
    """Tokens by piece.  ``encode`` takes a list of pieces (bytes) and returns a list of id sequences."""

    def __init__(self, encode: Callable[[list[bytes]], list], ids: bool = True, kind: type = np.uint32):
        self.encode, self.with_ids, self.kind = encode, ids, kind
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.begins = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)
        self.used = 0

    def _add(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.sizes)
        for k in range(0, len(keys), CALL):                       # a library's encodings are large; only a call's are alive
            pieces = [data[s:e].tobytes() for s, e in zip(starts[k:k + CALL].tolist(), ends[k:k + CALL].tolist(), strict=True)]
            got = self.encode(pieces)
            sizes = np.fromiter(map(len, got) if self.with_ids else got, np.int32, len(got))
            self.sizes = _grown(self.sizes, sizes)
            if self.with_ids:
                flat = np.fromiter((x for ids in got for x in ids), self.pool.dtype, int(sizes.sum()))
                begin = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
                self.begins = _grown(self.begins, begin)
                if self.used + len(flat) > len(self.pool):
                    self.pool = np.concatenate([self.pool, np.zeros(max(len(flat), len(self.pool) // 2), self.pool.dtype)])
                self.pool[self.used:self.used + len(flat)] = flat
                self.used += len(flat)
        slots = np.arange(first, first + len(keys), dtype=np.int32)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of every piece: an index into ``sizes`` and ``begins``."""
        if not len(starts):
            return np.zeros(0, np.int32)
        uniq, first, back = np.unique(T.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > LIMIT:
            self.clear()
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            miss = ~known
            self._add(uniq[miss], data, starts[first[miss]], ends[first[miss]])
            at = np.searchsorted(self.keys, uniq)
        return self.slots[at][back]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        return self.pool[T.take_ranges(self.begins[slots], self.sizes[slots].astype(np.int64))]
