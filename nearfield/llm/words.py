"""Words of whole texts as NumPy arrays: boundaries, 64-bit hashes and hashes of word sequences.

A word is a maximal run of bytes other than space and \\x09-\\x0D, so boundaries can be found in the
UTF-8 bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD_REGEX = r"[^\x20\x09-\x0D]+"
_STEP = (np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15))
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
SLICE_BYTES = 2 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and its n + 1 offsets into them; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(offsets), dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about 2 MB of text, or one longer document."""
    _, offsets = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def find_words(
    data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and each document's first word (n + 1 values).

    ``outside`` tells of each byte value whether it separates words.
    """
    inside = ~outside[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over the whole word (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX[0]
    h ^= h >> np.uint64(33)
    h *= _MIX[1]
    h ^= h >> np.uint64(33)
    return h


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word's bytes; ``seed`` 0 or 1 picks one of two functions."""
    lengths = ends - starts
    out = np.full(len(starts), 0xCBF29CE484222325 + seed, dtype=np.uint64)
    active, at = np.arange(len(starts)), 0
    while len(active):
        out[active] = (out[active] ^ data[starts[active] + at]) * _STEP[seed]
        at += 1
        active = active[lengths[active] > at]
    return mix(out ^ lengths.astype(np.uint64))


def hash_windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that start at each of the first ``len - n + 1`` places."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, dtype=np.uint64)
    for at in range(n):
        out = mix(out * _STEP[1] + words[at : at + count])
    return out
