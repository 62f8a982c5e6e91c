"""Normalised words of whole texts: runs of digits, letters a-z (A-Z lower-cased) and non-ASCII bytes.

They are numbered exactly, by their bytes; no hash stands for a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from nearfield.llm.words import LOWER, find_words, text_bytes

TERM_REGEX = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OUTSIDE = np.ones(256, dtype=bool)
OUTSIDE[0x30:0x3A] = OUTSIDE[0x61:0x7B] = OUTSIDE[0x80:] = False


class Terms:
    """Words of a text column: places, each text's first word, and their numbers in ``distinct``."""

    def __init__(self, column: pa.Array):
        data, self.offsets = text_bytes(column)
        data = LOWER[data]
        self.starts, self.ends, self.first = find_words(data, self.offsets, OUTSIDE)
        places = np.append(0, np.cumsum(self.ends - self.starts))
        packed = np.ascontiguousarray(data[~OUTSIDE[data]])
        buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(packed)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), buffers).dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)
