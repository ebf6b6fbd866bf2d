"""Words and word shingles of Arrow text as numpy arrays.

A word is a run of bytes other than ASCII punctuation, space and control
bytes, A-Z lower-cased: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing.
Hashes are 64-bit and equal on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
IS_WORD = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_CODES >= 0x80)
_RNG = np.random.default_rng(20250101)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed at once; longer texts are cut between words.
CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and the n+1 offsets of its rows."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """The words of a string column: byte ranges, hashes, and the word offsets of its rows."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        inside = IS_WORD[self.data]
        first = np.zeros(len(self.data) + 1, bool)
        first[self.offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:-1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.rows = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        """Sums of byte codes times powers; differences of running sums give every word at once."""
        out, done = np.empty(len(self.starts), np.uint64), 0
        while done < len(self.starts):
            at = self.starts[done]
            upto = max(done + 1, int(np.searchsorted(self.ends, at + CHUNK, "right")))
            n = int(self.ends[upto - 1] - at)
            up, down = (_UP, _DOWN) if n <= CHUNK else (_powers(_BASE, n + 1), _powers(_INVERSE, n + 1))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data[at:at + n]] * up[:n], out=sums[1:])
            s, e = self.starts[done:upto] - at, self.ends[done:upto] - at
            out[done:upto] = mix((sums[e] - sums[s]) * down[s])
            done = upto
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words by their first word, and which of them lie inside one row."""
        n = len(self.hashes)
        if n < k:
            return np.empty(0, np.uint64), np.empty(0, bool)
        h = self.hashes[:n - k + 1].copy()
        for j in range(1, k):
            h = h * _STEP + self.hashes[j:n - k + 1 + j]
        last = np.repeat(self.rows[1:], self.counts())[:n - k + 1]
        return mix(h + np.uint64(k)), np.arange(n - k + 1) + k <= last

    def text(self, first: int, last: int) -> str:
        """Words first .. last-1, lower-cased, one space between them."""
        low = LOWER[self.data[self.starts[first]:self.ends[last - 1]]].tobytes()
        at = int(self.starts[first])
        return b" ".join(low[s - at:e - at] for s, e in zip(self.starts[first:last], self.ends[first:last])).decode("utf-8", "replace")
