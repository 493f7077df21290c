"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Every separator used here is ASCII, so words can be cut on bytes. A word's
64-bit hash is a polynomial of its bytes modulo 2**64 with a mixed base, so it
comes from prefix sums without a loop over words. Large texts are hashed in
blocks; besides the text only a few numbers per word are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once, unless a single word is longer.
BLOCK = 1 << 18
#: Bytes of text that a step with many arrays works on at once; it takes some 20 to 60 times as much memory.
SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Bytes of a word between white space: all but 0x20 and 0x09 to 0x0D.
SPACED = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of a word of digits, lower-case letters and everything beyond ASCII.
ALNUM = _byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: A-Z to a-z, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1), or those of its inverse, modulo 2**64; n is rounded up to a power of two."""
    size = 1 << max(10, (n - 1).bit_length())
    if (size, inverse) not in _POWERS:
        base = pow(int(_BASE), -1, 1 << 64) if inverse else int(_BASE)
        out = np.ones(size, np.uint64)
        k = 1
        while k < size:
            out[k : 2 * k] = out[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        if size > 4 * BLOCK:
            return out
        _POWERS[(size, inverse)] = out
    return _POWERS[(size, inverse)]


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each codes[start:end]; equal runs give equal hashes wherever they stand."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(n)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(n, inverse=True)[starts])


def hashed_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end] of bytes, a block at a time; the runs are in order and apart."""
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low = starts[i]
        hashes[i:j] = run_hashes(_BYTE_CODE[data[low : ends[j - 1]]], starts[i:j] - low, ends[i:j] - low)
        i = j
    return hashes


@dataclass
class Words:
    """Words of a batch: byte spans in ``data``, hashes, and for document i the words first[i]:first[i+1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, i: int, j: int) -> bytes:
        """Bytes from word i to the end of word j - 1."""
        return self.data[self.starts[i] : self.ends[j - 1]].tobytes() if j > i else b""


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string array; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, members: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Words of every text: maximal runs of the bytes in ``members``."""
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = members[data]
    change = np.diff(inside)
    # A word also ends where its document does.
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    joined = edges[(inside[edges] == 1) & (inside[edges + 1] == 1)]
    starts = np.flatnonzero(change == 1)
    ends = np.flatnonzero(change == -1)
    if len(joined):
        starts = np.sort(np.concatenate([starts, joined]))
        ends = np.sort(np.concatenate([ends, joined]))
    hashes = hashed_runs(data, starts, ends)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def rolling(words: Words, n: int) -> np.ndarray:
    """Hash of the n words from every word of the batch on, also across documents."""
    total = len(words.hashes)
    if total < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(total - n + 1, np.uint64)
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    for k in range(n):
        out *= multiplier
        out += words.hashes[k : total - n + 1 + k]
    return mix(out)


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a document, and their positions among the batch's words."""
    hashes = rolling(words, n)
    last = np.repeat(words.first[1:], np.diff(words.first))[: len(hashes)]
    at = np.flatnonzero(np.arange(n, n + len(hashes)) <= last)
    return hashes[at], at


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text; one text is never cut."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    i = 0
    while i < len(batch):
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + most_bytes, "right")))
        yield batch.slice(i, j - i)
        i = j


def release() -> None:
    """Gives back what earlier tasks of a reused worker freed."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
