"""Words of letters and digits: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, on whole Arrow columns.

All of these separators are single bytes that UTF-8 never uses inside a longer character.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shopmetrics.llm import text as X

#: Each byte as it counts: separators are spaces, A-Z are a-z.
NORMAL = np.arange(256, dtype=np.uint8)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    NORMAL[_lo : _hi + 1] = 0x20
NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)

#: The same class for Spark's regular expressions, on lower-cased text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Spans over this many bytes are hashed one by one.
LONG = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc32_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each buf[starts[i]:ends[i]] as unsigned 32-bit: all spans a byte at a time, longest first."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, size = starts[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    long = int(np.searchsorted(-size, -LONG, side="left"))
    at, crc_short = at[long:], crc[long:]
    counts = np.searchsorted(-size[long:], -np.arange(int(size[long]) if long < len(size) else 0), side="left")
    for j, n in enumerate(counts):
        c = crc_short[:n]
        crc_short[:n] = _CRC[(c ^ buf[at[:n] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        crc[i] = zlib.crc32(buf[starts[order[i]] : ends[order[i]]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def word_chunks(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row from, row to, normal bytes, word starts, word ends, first word of each row) of a few megabytes at a time."""
    buf, offsets = X.byte_column(col)
    for lo, hi in X.chunks(offsets):
        part = NORMAL[buf[offsets[lo] : offsets[hi]]]
        yield lo, hi, part, *X.word_bounds(part, offsets[lo : hi + 1] - offsets[lo])


def joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with exactly one space between: (bytes, starts, ends), so that each run of words is one span."""
    size = ends - starts
    after = np.cumsum(size + 1)
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, dtype=np.uint8)
    begin = after - size - 1
    to, _ = X.ranges(begin, begin + size)
    of, _ = X.ranges(starts, ends)
    out[to] = buf[of]
    return out, begin, begin + size
