"""Hashes of words and of windows of words over whole batches of texts, in numpy.

Texts are laid out in one byte buffer with a space after each. A word's hash is a
polynomial of its bytes modulo 2**64, taken from running sums; a window's hash is one of
its words' hashes. Equal sequences have equal hashes wherever they stand. Every result is
mixed, so its bits can be used as they are.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text hashed together; longer texts are hashed as long as they are.
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd base and of its inverse, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, CHUNK_BYTES + 1024)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, np.uint64(b), dtype="u8")
            out[0] = 1
            pair.append(np.multiply.accumulate(out))
        if size > 4 * CHUNK_BYTES:  # of one very long text: not kept
            return pair[0], pair[1]
        _powers[base] = (pair[0], pair[1])
    return _powers[base]


def _ranges(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of values[start:end] for each pair."""
    power, inverse = _powers_of(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype="u8")
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * inverse[start]


class Words:
    """The words of several texts: hashes, and the index at which each text begins.

    ``first[i]`` to ``first[i + 1]`` are the words of text i.
    """

    def __init__(self, texts: list[bytes], seed: int = 0):
        self._data = np.frombuffer(b" ".join([*texts, b""]), dtype="u1")
        space = _SPACE[self._data]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype("i1")))
        self.start, self.end = edges[0::2], edges[1::2]
        if len(self.start) and self.end[-1] > len(self._data):
            self.end[-1] = len(self._data)
        table = mix(np.arange(1, 257, dtype="u8") + np.uint64(seed * 1000003))
        hashes = _ranges(table[self._data], 0x9E3779B97F4A7C15 + 2 * seed, self.start, self.end)
        self.hash = mix(hashes ^ (self.end - self.start).astype("u8"))
        lengths = np.array([len(t) + 1 for t in texts], dtype="i8")
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def windows(self, length: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
        """Hashes of all runs of ``length`` words, also across texts; see ``within``."""
        n = max(0, len(self.hash) - length + 1)
        at = np.arange(n)
        return mix(_ranges(self.hash, base, at, at + length))

    def within(self, length: int) -> np.ndarray:
        """Which runs of ``length`` words lie in one text."""
        n = max(0, len(self.hash) - length + 1)
        return self.doc[:n] == self.doc[length - 1 : length - 1 + n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values; none if there are fewer."""
    if len(values) < width:
        return values[:0]
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    rest = width - reach
    n = len(values) - width + 1
    return np.minimum(least[:n], least[rest : rest + n])


def chunks(texts: list[bytes], most: int = CHUNK_BYTES):
    """(from, to) of runs of texts that are hashed together."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
