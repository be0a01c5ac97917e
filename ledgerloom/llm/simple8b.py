"""Simple-8b: unsigned integers in 64-bit words, as many in a word as their widths allow.

The upper four bits of a word are its selector, the lower 60 bits hold a fixed count of values of
one width. A value that 60 bits cannot hold (or that equals the mark) is written as the mark, 60
one bits, and kept in full in a list of escapes. Blocks of a fixed number of values begin at a word
of their own, whose index is kept, so blocks can be decoded alone; the values are decoded selector
by selector, as numpy matrices.
"""

from __future__ import annotations

import struct

import numpy as np

# Values in a word and their width in bits, by selector; fixed values of the format.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_U = np.uint64
MARK = _U((1 << 60) - 1)
BLOCK = 1024
_HEADER = struct.Struct("<4sIQQQ")  # magic, values in a block, values, words, escapes
_MAGIC = b"LS8B"


_WIDTH_OF_16 = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.int8)


def _bits(values: np.ndarray) -> np.ndarray:
    if len(values) and values.max() < 1 << 16:
        return _WIDTH_OF_16[values]
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    high = np.frexp((values >> np.uint64(32)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.int8)


def _selectors(bits: np.ndarray, block: int) -> np.ndarray:
    """The selector of most values for a word that begins at each place. Places beyond the end
    of a block have no width, so the last word of a block may be part filled."""
    widest = np.zeros((-(-len(bits) // block), block), np.int8)
    widest.reshape(-1)[: len(bits)] = bits
    chosen = np.full(widest.shape, 15, np.int8)
    span = 1
    for s in range(14, -1, -1):
        more = int(COUNTS[s]) - span
        widest[:, :-more] = np.maximum(widest[:, :-more], widest[:, more:])
        span += more
        fits = widest <= WIDTHS[s]
        if not fits.any():
            break
        chosen[fits] = s
    return chosen.reshape(-1)[: len(bits)]


def pack(values: np.ndarray, block: int = BLOCK) -> bytes:
    values = np.asarray(values, np.uint64)
    n = len(values)
    escaped = values >= MARK
    stored = np.where(escaped, MARK, values)
    selector = _selectors(_bits(stored), block)
    place = np.arange(n, dtype=np.int64)
    step = np.zeros(-(-n // block) * block, np.int64)
    step[:n] = COUNTS[selector]
    step = np.minimum(step.reshape(-1, block), block - np.arange(block)).reshape(-1)[:n]
    np.minimum(step, n - place, out=step)
    # All blocks go from word to word in step.
    after, is_start = place + step, np.zeros(n, bool)
    at = np.arange(0, n, block)
    end = np.minimum(at + block, n)
    while len(at):
        is_start[at] = True
        at = after[at]
        within = at < end
        at, end = at[within], end[within]
    start = np.flatnonzero(is_start)
    chosen, count = selector[start], step[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        rows = np.flatnonzero(chosen == s)
        for lane in range(COUNTS[s] if len(rows) else 0):
            if lane:  # part-filled words end early
                rows = rows[count[rows] > lane]
            words[rows] |= stored[start[rows] + lane] << _U(lane * int(WIDTHS[s]))
    offsets = np.searchsorted(start, np.arange(0, n, block)).astype("<u4")
    escapes = values[escaped]
    head = _HEADER.pack(_MAGIC, block, n, len(words), len(escapes))
    parts = (offsets, words.astype("<u8"), escapes.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def unpack(page: bytes) -> np.ndarray:
    magic, block, n, n_words, n_escapes = _HEADER.unpack_from(page)
    if magic != _MAGIC:
        raise ValueError("not a page of packed ids")
    n_blocks = -(-n // block)
    at = _HEADER.size
    offsets = np.frombuffer(page, "<u4", n_blocks, at).astype(np.int64)
    words = np.frombuffer(page, "<u8", n_words, at + 4 * n_blocks)
    escapes = np.frombuffer(page, "<u8", n_escapes, at + 4 * n_blocks + 8 * n_words)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[chosen]
    if n_words:
        before = np.cumsum(count) - count
        first = before[offsets]
        last = np.append(offsets[1:], n_words) - 1
        size = np.minimum(block, n - np.arange(n_blocks) * block)
        count[last] = size - (before[last] - first)
    start = np.cumsum(count) - count
    out = np.zeros(n, np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero(chosen == s)
        mask = _U((1 << int(WIDTHS[s])) - 1)
        for lane in range(COUNTS[s] if len(rows) else 0):
            if lane:
                rows = rows[count[rows] > lane]
            out[start[rows] + lane] = (words[rows] >> _U(lane * int(WIDTHS[s]))) & mask
    out[out == MARK] = escapes
    return out
