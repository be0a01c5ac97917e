"""Words of texts as 64-bit hashes, found and hashed for many texts at once with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Its hash is a polynomial over randomly drawn byte values modulo 2**64, from one running sum
over all bytes, then mixed. Two given words collide with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PART_BYTES = 1 << 20  # bytes that are turned over at once; a longer text goes in parts
_U = np.uint64
_RADIX = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a one-to-one scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_RADIX, _INVERSE)):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            _powers[i] = np.multiply.accumulate(powers)
    return _powers


def _hash_part(data: np.ndarray, cuts: np.ndarray, values: np.ndarray):
    """Starts, ends and hashes of the words in `data`; no word crosses one of `cuts`."""
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def _split(data: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Parts of a long text that end at white space."""
    while last - first > PART_BYTES:
        end = first + PART_BYTES
        while end < last:
            gaps = np.flatnonzero(~_IS_WORD[data[end : min(end + PART_BYTES, last)]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + PART_BYTES, last)
        yield first, end
        first = end
    yield first, last


class Words:
    """Hashes of the words of all texts of a column, one after the other: those of text i are
    hashes[bounds[i]:bounds[i+1]], and if places are asked for, its words lie in `data` at starts
    and ends of the same index. Text i itself is data[offsets[i]:offsets[i+1]]."""

    def __init__(self, column: pa.Array, lower: bool = False, places: bool = False):
        texts = column.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        held = texts.buffers()[2]
        self.data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
        self.offsets = offsets
        values = _LOWER if lower else _VALUES
        hashes, starts, ends = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        n = len(texts)
        counts = np.zeros(n, np.int64)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PART_BYTES, "right")) - 1)
            for a, b in _split(self.data, int(offsets[i]), int(offsets[j])) if j == i + 1 else [
                (int(offsets[i]), int(offsets[j]))
            ]:
                if a == b:
                    continue
                cuts = offsets[i : j + 1] - a
                s, e, h = _hash_part(
                    self.data[a:b], cuts[(cuts >= 0) & (cuts <= b - a)], values
                )
                counts[i:j] += np.diff(np.searchsorted(s + a, offsets[i : j + 1]))
                hashes.append(h)
                if places:
                    starts.append(s + a)
                    ends.append(e + a)
            i = j
        self.hashes = np.concatenate(hashes)
        self.bounds = np.concatenate([[0], np.cumsum(counts)])
        if places:
            self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words, or one for all words if there are fewer."""
    n = len(words)
    width = min(n, size)
    if not n:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            out = mix(out * _RADIX + words[k : n - width + 1 + k])
    return out
