"""Compact binary form of sorted integer sets, for shuffling many hashes.

Sorted values are stored as differences, byte plane by byte plane, compressed
with zstandard: n values drawn from 2^b cost about b - log2(n) + 1.5 bits each.
"""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Any unsigned 64-bit values, in their order, as byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values."""
    return pack(np.diff(values, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def bounds(sorted_values: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where to cut ascending values below 2^bits into `parts` equal ranges."""
    edges = np.array([(i << bits) // parts for i in range(parts)], dtype=np.uint64)
    return np.append(np.searchsorted(sorted_values, edges), len(sorted_values))
