"""Vectorised words and grams of a block of documents (numpy, inside tasks).

A block is some rows of an Arrow batch, at most ``BLOCK_BYTES`` of text unless
one text alone is longer, so memory follows the block, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 4 << 20
#: Words longer than this are hashed one by one.
LONG_WORD = 64

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values: True inside the ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: Letters, digits and every byte of a multi-byte code point.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but [\x20\x09-\x0D].
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = column.cast(pa.large_binary()).fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size
            else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive blocks."""
    data, off = text_buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


class Words:
    """Word spans of a block: starts, ends (byte positions), and for each
    document the range first[d]..first[d + 1] of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        w = is_word[data]
        edge = np.zeros(len(data) + 1, dtype=bool)  # a document starts or the block ends here
        edge[offsets] = True
        before = np.concatenate(([False], w[:-1])) if len(w) else w
        after = np.concatenate((w[1:], [False])) if len(w) else w
        self.starts = np.flatnonzero(w & (~before | edge[:-1]))
        self.ends = np.flatnonzero(w & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def doc_end(self) -> np.ndarray:
        """For each word, the index one past the last word of its document."""
        return np.repeat(self.first[1:], np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        size = self.ends - self.starts
        h = np.full(len(size), np.uint64(0xCBF29CE484222325 ^ seed), dtype=np.uint64)
        live = np.flatnonzero(size <= LONG_WORD)
        at = 0
        with np.errstate(over="ignore"):
            while len(live):
                h[live] = (h[live] ^ self.data[self.starts[live] + at]) * np.uint64(0x100000001B3)
                at += 1
                live = live[size[live] > at]
            out = mix(h ^ size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD):
            out[i] = xxhash.xxh64_intdigest(self.word(i), seed=seed)
        return out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries of h (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, np.uint64(0x9E3779B97F4A7C15))
    with np.errstate(over="ignore"):
        for t in range(k):
            g = (g ^ h[t:t + n]) * np.uint64(0xD6E8FEB86659FD93)
            g ^= g >> np.uint64(32)
        return mix(g)


def window_minima(g: np.ndarray, w: int, valid: np.ndarray) -> np.ndarray:
    """Positions of g that are the minimum of some window of w entries; valid
    marks the windows (by first entry) that count. Ties all count."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = g[:n].copy()
    for t in range(1, w):
        np.minimum(low, g[t:t + n], out=low)
    hit = np.zeros(len(g), dtype=bool)
    for t in range(w):
        hit[t:t + n] |= (g[t:t + n] == low) & valid[:n]
    return np.flatnonzero(hit)
