"""Words of many texts at a time, as 64-bit hashes.

Hashes stand for words: two of a million distinct words meet with a chance of
about 3e-8, and every use compares many words.
"""

from __future__ import annotations

import numpy as np

from shopstream.llm.common import mix64

#: Stands between texts; the byte is in no UTF-8 text.
_END = b" \xff "
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


#: Bytes whose running sums are held at a time; a longer word is taken whole.
BLOCK_BYTES = 1 << 18

#: Powers of the base and of its inverse modulo 2^64, for a block.
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, BLOCK_BYTES), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= BLOCK_BYTES:
            _POWERS[base] = known
    return known


def word_spans(data: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as an array, and start, end and hash of each run of bytes other than space and 0x09 to 0x0D."""
    data = data if isinstance(data, np.ndarray) else np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_IN_WORD[data], prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    return data, start, end, span_hashes(data, start, end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of bytes, given in order and apart from each other."""
    h = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):  # whole runs; their hashes do not depend on the place
        at = int(start[first])
        last = max(int(np.searchsorted(end, at + BLOCK_BYTES, side="right")), first + 1)
        part = data[at:end[last - 1]]
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[part] * _powers(len(part), _BASE)[:len(part)], out=run[1:])
        a, b = start[first:last] - at, end[first:last] - at
        h[first:last] = mix64((run[b] - run[a]) * _powers(len(part), _INVERSE)[a])
        first = last
    return h


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and the number of words of each text; A-Z are lower-cased."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data, start, _, h = word_spans(b"".join((t or b"").lower() + _END for t in texts))
    mark = data[start] == 0xFF
    return h[~mark], np.diff(np.flatnonzero(mark), prepend=-1) - 1
