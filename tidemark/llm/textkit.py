"""Vectorised word splitting and hashing of Arrow string columns.

A word is a maximal run of bytes other than space and TAB..CR
(``[^\\x20\\x09-\\x0D]+``). Those separators are single bytes in UTF-8, so
splitting works on the raw bytes, without decoding. Helpers run inside Spark
tasks on bounded slices of a partition.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import hashlib
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE_BYTES = 2 << 20     # texts are worked on in slices of about this size
LONG_WORD = 64            # longer words are hashed one by one

_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_IS_PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_FOLD = _BYTE[_LOWER]
_MULT = np.uint64(0x9E3779B97F4A7C15)


def tidied(run: Callable) -> Callable:
    """``run``, giving freed memory back to the system when it is done. Workers live
    on between tasks, and several share an executor's memory."""
    @functools.wraps(run)
    def tidy(*args):
        try:
            return run(*args)
        finally:
            gc.collect(1)
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):     # another C library
                pass

    tidy.__signature__ = inspect.signature(run)    # Spark counts the arguments
    return tidy


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: ``buf[starts[i]:ends[i]]``; text d has the words
    ``first[d]:first[d + 1]``. ``offsets`` are the texts' byte ranges in buf."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def index_in_doc(self) -> np.ndarray:
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)

    def prefix_hashes(self, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each size: the words with that many bytes, and the hash of those bytes, A-Z folded."""
        lens = self.ends - self.starts
        h, live = np.zeros(len(lens), np.uint64), np.arange(len(lens))
        for j in range(max(sizes)):
            live = live[lens[live] > j]
            h[live] = h[live] * _MULT + _BYTE_FOLD[self.buf[self.starts[live] + j]]
            if j + 1 in sizes:
                yield live, mix(h[live] ^ np.uint64(j + 1 << 56))

    def hashes(self, fold_case: bool = False) -> np.ndarray:
        """64-bit hash of each word's bytes (A-Z folded to a-z on request)."""
        table = _BYTE_FOLD if fold_case else _BYTE
        lens = self.ends - self.starts
        h = np.zeros(len(lens), np.uint64)
        live, at, j = np.flatnonzero(lens <= LONG_WORD), None, 0
        while len(live):
            at = self.starts[live] + j
            h[live] = h[live] * _MULT + table[self.buf[at]]
            j += 1
            live = live[lens[live] > j]
        for i in np.flatnonzero(lens > LONG_WORD):
            word = self.buf[self.starts[i]:self.ends[i]].tobytes()
            word = word.lower() if fold_case else word
            h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return mix(h ^ lens.astype(np.uint64))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets into them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks != 1 else texts.chunk(0)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array) -> Words:
    """Words of each text; a null text has none."""
    buf, offsets = _buffers(texts)
    return _split(buf, offsets)


def _split(buf: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _IS_SEP) -> Words:
    n = len(buf)
    word = np.empty(n + 1, bool)
    word[:n] = ~gap[buf]
    word[n] = False
    start = word[:n].copy()
    start[1:] &= ~word[:n - 1] if n else start[1:]
    end = word[:n] & ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]      # a word never spans two texts
    start[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(buf, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(texts: pa.Array, size: int = SLICE_BYTES,
           letters: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first text, end text, Words) of runs of whole texts of about ``size`` bytes.
    With ``letters``, all ASCII but letters and digits separates words too."""
    gap = _IS_PUNCT if letters else _IS_SEP
    buf, offsets = _buffers(texts)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), n)
        lo, hi = offsets[at], offsets[to]
        yield at, to, _split(buf[lo:hi], offsets[at:to + 1] - lo, gap)
        at = to


def windows(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and where that window lies within
    one text. Hashes elsewhere are undefined."""
    n = len(h)
    out = np.zeros(n, np.uint64)
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * _MULT + h[j:n - k + 1 + j]
        out[:n - k + 1] = acc
    left = np.repeat(words.first[1:], words.counts) - np.arange(n)
    return mix(out), left >= k


def joined(words: Words, fold_case: bool = False) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space, and each word's start and end therein."""
    lens = words.ends - words.starts
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    total = int(ends[-1]) + 1 if len(ends) else 0
    out = np.empty(total, np.uint8)
    for lo in range(0, len(lens), 1 << 18):       # keeps the index array small
        s = slice(lo, lo + (1 << 18))
        a, b = int(starts[s][0]), int(ends[s][-1]) + 1
        at = np.arange(a, b) + np.repeat(words.starts[s] - starts[s], lens[s] + 1)
        out[a:b] = words.buf[np.minimum(at, len(words.buf) - 1)]
    out[ends] = 0x20
    if fold_case:
        out = _LOWER.astype(np.uint8)[out]
    return out.tobytes(), starts, ends
