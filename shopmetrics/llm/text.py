"""Words and word hashes of Arrow text columns, whole batches at a time in numpy.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. UTF-8 never uses those bytes inside
a longer character, so working on bytes gives the words of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Bytes of text that are handled at a time: bounds the temporaries of a Python worker.
CHUNK_BYTES = 1 << 21
BLOCK_BYTES = 1 << 19

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_GRAM = np.uint64(0xD1342543DE82EF95)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = 1 << (n - 1).bit_length()
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def byte_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and ``first``: row i has words first[i] to first[i + 1]."""
    inside = ~SPACE[buf]
    start, end = inside.copy(), inside.copy()
    if len(buf):
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        stops = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        start[begins] = inside[begins]
        end[stops] = inside[stops]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit hash for each word (ranges in order that don't overlap): a polynomial over its bytes, then mixed with its length.

    The running sums are taken over blocks of bytes, so temporaries don't grow with the text."""
    out = np.empty(len(starts), np.uint64)
    table, lo = (_LOWER if lower else _BYTE), 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
        part = buf[base : int(ends[hi - 1])]
        up, down = _power_table(max(len(part), BLOCK_BYTES))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(table[part] * up[: len(part)], out=sums[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of k consecutive words; a run that crosses a row's end must be left out by the caller."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, seed + 1, dtype=np.uint64)
    for j in range(k):
        h = h * _GRAM + words[j : j + n]
    return mix(h)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (by doubling)."""
    out, have = values, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges first[i] to last[i] - 1, and i of each."""
    n = np.maximum(last - first, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[owner], owner
