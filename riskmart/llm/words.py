"""Words of a whole batch of texts at once, as positions and 64-bit hashes in numpy arrays.

Texts are handled as the UTF-8 bytes that Arrow holds; no Python object is made per word. A batch is cut into chunks of
about `CHUNK` bytes, so memory does not depend on the batch; a longer text is a chunk of its own and always whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

SPACES = np.ones(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = False  # words are [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 0x20

BASE = 0x9E3779B97F4A7C15
_POWERS = [np.uint64(pow(BASE, j, 1 << 64)) for j in range(64)]


def power(j: int) -> np.uint64:
    """BASE to the j-th modulo 2**64."""
    return _POWERS[j] if j < len(_POWERS) else np.uint64(pow(BASE, j, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of the texts of one chunk: text t has words bounds[t] to bounds[t + 1]."""

    data: np.ndarray  # bytes of all texts, folded
    offsets: np.ndarray  # byte bounds of the texts
    starts: np.ndarray  # byte bounds of the words
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(word index where a window of k words of one text starts, its hash)."""
        counts = self.counts
        at = np.arange(len(self.starts))
        at = at[at + k <= np.repeat(self.bounds[1:], counts)] if len(at) else at
        return at, gram_hashes(self.hashes, k)[at] if len(at) else np.zeros(0, np.uint64)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k hashes, by start; the last k - 1 entries are no windows."""
    total = np.zeros(len(hashes), np.uint64)
    room = max(len(hashes) - k + 1, 0)
    for j in range(k):
        total[:room] += hashes[j:j + room] * power(j)
    return mix(total + np.uint64(k))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string array; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word. Its blocks of 8 bytes are mixed with their number before they are added, so that words made of
    the same parts in another order, which cancel out in a polynomial modulo 2**64, differ like any others."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    eights = np.ndarray((len(data),), "<u8", padded, strides=(1,))  # the 8 bytes from each place on, not copied
    sizes = ends - starts
    blocks = (sizes + 7) >> 3
    first = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    block = eights[np.repeat(starts, blocks) + 8 * number].astype(np.uint64)
    rest = np.minimum(np.repeat(sizes, blocks) - 8 * number, 8)
    block &= np.uint64(2**64 - 1) >> (64 - 8 * rest).astype(np.uint64)
    start = np.uint64((BASE * (2 * seed + 1)) % 2**64)
    block = mix(block ^ mix(number.astype(np.uint64) * np.uint64(BASE) + start))
    return mix(np.add.reduceat(block, first) + sizes.astype(np.uint64) + start)


def find(texts: pa.Array, inside: np.ndarray = SPACES, fold: np.ndarray = AS_IS, hashed: bool = True, seed: int = 0) -> Words:
    data, offsets = bytes_of(texts)
    if fold is not AS_IS:
        data = fold[data]
    is_word = inside[data]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, is_word[:-1]
    before[edges[:-1]] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, is_word[1:]
    after[edges[1:]] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    hashes = _hashes(data, starts, ends, seed) if hashed else np.zeros(0, np.uint64)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each have about CHUNK bytes, or are one longer text."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        total, begin = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > begin and total + size > CHUNK:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        yield batch.slice(begin)
