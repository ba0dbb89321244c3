"""Words of whole texts as 64-bit hashes, a batch of Arrow strings at a time.

Everything is array arithmetic over the UTF-8 bytes of the batch, so a text
costs a few nanoseconds a byte.  A word's hash is a multilinear sum of its
bytes with random 64-bit multipliers, mixed with its length; a window's hash
is a multilinear sum of its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_multipliers = np.zeros(0, U)


def multipliers(n: int, seed: int = 11) -> np.ndarray:
    """The first ``n`` of a fixed sequence of random odd 64-bit numbers."""
    global _multipliers
    if len(_multipliers) < n:
        size = max(256, 1 << (n - 1).bit_length())
        # drawn in blocks, so that a longer table starts with the shorter one
        blocks = [np.random.default_rng([seed, k]).integers(0, 1 << 64, 256, U) for k in range(size // 256)]
        _multipliers = np.concatenate(blocks) | U(1)
    return _multipliers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser over 64 bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


@dataclass
class Words:
    """Words of a batch: byte ``starts`` and ``ends`` in ``data``, the row
    ``doc`` of each, its ``hash``; ``bounds`` are the rows' byte offsets."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def first(self) -> np.ndarray:
        """Index of the first word of each row."""
        return np.searchsorted(self.starts, self.bounds[:-1])

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every k-word window inside a row."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        m = multipliers(256 * (salt + 2))[256 * (salt + 1):]
        total = np.zeros(n, U)
        for i in range(k):
            total += self.hash[i:i + n] * m[i]
        at = np.nonzero(self.doc[:n] == self.doc[k - 1:])[0]
        return at, mix(total[at] + U(k))


def words_of(data: np.ndarray, bounds: np.ndarray, fold: bool = False) -> Words:
    if fold:
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)
    solid = ~_IS_SPACE[data]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False
    starts = np.nonzero(solid & ~before)[0]
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner - 1] = False
    ends = np.nonzero(solid & ~after)[0] + 1
    doc = np.searchsorted(bounds, starts, side="right") - 1
    length = ends - starts
    total = np.zeros(len(starts), U)
    if len(starts):
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        letters = data[solid].astype(U) + U(1)
        total = segment_sums(letters * multipliers(int(length.max()))[place], np.cumsum(length) - length)
    return Words(data, bounds, starts, ends, doc, mix(total + length.astype(U)))


def line_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range [start, end); ranges ascend and don't overlap."""
    length = ends - starts
    full = length > 0
    out = np.zeros(len(starts), U)
    n = length[full]
    if len(n):
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        letters = data[np.repeat(starts[full], n) + place].astype(U) + U(1)
        out[full] = segment_sums(letters * multipliers(int(n.max()))[place], np.cumsum(n) - n)
    return mix(out + length.astype(U))


def slices(texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (or one row): the first row,
    the bytes and the rows' offsets in them.  A NULL is an empty text.  Hashing
    a run takes some 40 bytes of arrays for each of its bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop
