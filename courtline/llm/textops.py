"""Vectorised work on the UTF-8 bytes of a batch of texts.

A batch is one byte array plus offsets (Arrow's own layout), so no Python
string is made per text.  Spans (words, chunks) are arrays of start and end
positions in that byte array and never cross a text's border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of a span that are hashed in step with all other spans.
STEPPED = 256
_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)
_TAIL = np.array([0xFFFFFFFFFFFFFFFF >> (64 - 8 * k) if k else 0 for k in range(9)], dtype=np.uint64)

#: space, \t, \n, \v, \f, \r
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the texts' offsets in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together (one longer text makes a range of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; works in place."""
    h ^= h >> np.uint64(30)
    h *= _C2
    h ^= h >> np.uint64(27)
    h *= _C3
    h ^= h >> np.uint64(31)
    return h


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs where ``inside`` holds, cut at text borders."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    border[n] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of ``[^\\x20\\x09-\\x0D]+``."""
    return spans(~IS_SPACE[data], offsets)


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of each text's spans in ``starts``."""
    return np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every span's bytes: eight bytes a step for all spans, what is over STEPPED bytes at once for each."""
    size = ends - starts
    h = mix((size.astype(np.uint64) + np.uint64(seed)) * _C1)
    if not len(starts):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    at, left = starts, size
    block = eight[at] & _TAIL[np.minimum(left, 8)]
    h = mix((h ^ block) * _C1)
    rest = np.flatnonzero(left > 8)
    at, left = starts[rest] + 8, left[rest] - 8
    for _ in range(STEPPED // 8 - 1):
        if not len(rest):
            break
        block = eight[at] & _TAIL[np.minimum(left, 8)]
        h[rest] = mix((h[rest] ^ block) * _C1)
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    if len(rest):
        view = memoryview(np.ascontiguousarray(data))
        tails = np.array([xxhash.xxh3_64_intdigest(view[i:i + k]) for i, k in zip(at.tolist(), left.tolist(), strict=True)], np.uint64)
        h[rest] = mix((h[rest] ^ tails) * _C1)
    return h


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from a are those from b, for each pair; eight bytes a step for all."""
    out = np.ones(len(a), bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    rest = np.flatnonzero(size > 0)
    done = 0
    while len(rest):
        differ = (eight[a[rest] + done] ^ eight[b[rest] + done]) & _TAIL[np.minimum(size[rest] - done, 8)]
        out[rest[differ != 0]] = False
        done += 8
        rest = rest[(differ == 0) & (size[rest] > done)]
    return out


def combine(*hashes: np.ndarray) -> np.ndarray:
    """One hash of several equally long hash arrays; their order counts."""
    out = hashes[0] * _C1
    for h in hashes[1:]:
        out = mix(out ^ h) * _C1
    return mix(out)


def take_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    step = np.ones(total, np.int64)
    step[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    step[at] = starts[1:] - (starts[:-1] + lengths[:-1]) + 1
    return np.cumsum(step)
