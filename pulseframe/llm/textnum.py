"""Words, windows and their 64-bit hashes, computed with numpy over many whole texts at once.

A slice of texts is joined into one byte buffer with a separator after each text. Word hashes come from prefix
sums of a polynomial over the bytes (modulo 2**64, odd base, so that a word's sum can be shifted back to power 0).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

_RANDOM = np.random.default_rng(20_240_601)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
WINDOW_FACTOR = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)

#: ASCII white space, the separator of words in most contracts.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, length: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept and grown by doubling."""
    have = _powers.get(name)
    if have is None or len(have) < length:
        size = 1 << max(20, (length - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        filled, step = 1, base
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * np.uint64(step)
            filled *= 2
            step = step * step % 2**64
        _powers[name] = have
    return have[:length]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null gives no bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``limit`` bytes, or of one longer text."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > limit:
            yield begin, k
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


class Words:
    """Words of several texts: ``start``/``end`` in ``data``, ``doc`` (index of the text), ``hash``.

    ``first[d]`` to ``first[d + 1]`` is the range of the words of text ``d``.
    """

    def __init__(self, texts: list[bytes], lower: bool, separator: np.ndarray = IS_SPACE):
        self.raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        self.data = LOWER[self.raw] if lower else self.raw
        self.text_start = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.text_start[1:])
        inside = ~separator[self.data]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * _power("up", BASE, len(self.data)), out=sums[1:])
        back = _power("down", BASE_INVERSE, len(self.data) + 1)[self.start]
        self.hash = mixed((sums[self.end] - sums[self.start]) * back)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``width`` words inside one text."""
        at = np.arange(max(0, len(self.hash) - width + 1))
        at = at[self.doc[at] == self.doc[at + width - 1]]
        total = np.zeros(len(at), dtype=np.uint64)
        for j in range(width):
            total += self.hash[at + j] * WINDOW_FACTOR[j]
        return at, mixed(total)

    def shingle_sets(self, width: int) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, without words none."""
        at, value = self.windows(width)
        begin = np.searchsorted(at, self.first)
        sets = []
        for d, words in enumerate(self.count):
            if words >= width:
                sets.append(distinct(value[begin[d] : begin[d + 1]]))
            elif words:
                own = self.hash[self.first[d] : self.first[d + 1]] * WINDOW_FACTOR[:words]
                sets.append(mixed(own.sum(keepdims=True, dtype=np.uint64) + np.uint64(int(words))))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
        return sets


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values
