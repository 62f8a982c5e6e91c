"""CRC-32 of many byte strings at once, in matrices of strings of one length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

_POLYNOMIAL = 0xEDB88320
_LONG = 1024


def _table() -> np.ndarray:
    """What one byte does to the register, by the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


TABLE = _table()


def crc32_all(strings: pa.LargeBinaryArray, most_cells: int = 4 << 20) -> np.ndarray:
    """Unsigned CRC-32 of every string (no nulls).

    Strings of equal length form a matrix with a row per byte position; all their registers take one position
    after the other, and go back to where their strings stand. A matrix has up to ``most_cells`` cells.
    Strings of over 1,024 bytes, whose matrices would be a column or two wide, are fed to zlib one by one.
    """
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    out = np.zeros(len(strings), dtype=np.uint32)
    if not len(strings) or offsets[-1] == offsets[0]:
        return out
    data = np.frombuffer(strings.buffers()[2], dtype=np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(lengths[order]) != 0)).tolist() + [len(order)]
    for a, b in zip(cuts, cuts[1:]):
        length = int(lengths[order[a]])
        if length > _LONG:
            for at in order[a:b].tolist():
                out[at] = zlib.crc32(data[offsets[at] : offsets[at + 1]])
            continue
        width = max(1, most_cells // max(1, length))
        for c in range(a, b, width):
            bucket = order[c : min(c + width, b)]
            matrix = data[np.arange(length)[:, None] + offsets[bucket]]
            register = np.full(len(bucket), 0xFFFFFFFF, dtype=np.uint32)
            for position in matrix:
                register = TABLE[(register ^ position) & np.uint32(255)] ^ (register >> np.uint32(8))
            out[bucket] = ~register
    return out
