"""Words of letters and digits: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased.

All delimiters are ASCII, so the bytes of UTF-8 are cut exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from weftline.llm._text import LOWER

#: Bytes of words: digits, letters, and everything outside ASCII.
INK = np.zeros(256, bool)
INK[ord("0") : ord("9") + 1] = True
INK[ord("a") : ord("z") + 1] = True
INK[0x80:] = True


class Words:
    """The words of a run of documents: lower-cased bytes, starts, ends and documents of the words, words a document."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.low = LOWER[buf]
        ink = np.zeros(len(buf) + 2, bool)
        ink[1:-1] = INK[self.low]
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        self.start = np.flatnonzero(ink[1:-1] & (~ink[:-2] | edge[:-1]))
        self.end = np.flatnonzero(ink[1:-1] & (~ink[2:] | edge[1:])) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=len(off) - 1)

    def left(self) -> np.ndarray:
        """For each word, how many words of its document begin there or later."""
        return np.cumsum(self.count)[self.doc] - np.arange(len(self.start))

    def texts(self) -> pa.Array:
        """The words as an Arrow array of strings."""
        size = self.end - self.start
        off = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=off[1:])
        at = np.repeat(self.start - off[:-1], size) + np.arange(off[-1])
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(self.low[at])))
