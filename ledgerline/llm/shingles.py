"""Hashes of words and of runs of words, computed for many texts at once over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2^64
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
#: A fixed random value for each byte; A-Z have those of a-z.
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers_of: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    held = _powers_of.get(int(base))
    if held is None or len(held) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[:1] = 1
        held = np.cumprod(out, dtype=np.uint64)
        if n <= 1 << 20:  # else only this batch needs them
            _powers_of[int(base)] = held
    return held[:n]


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each begins (with the end of the last). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]] if len(offsets) else flat, offsets - offsets[0]


class Words:
    """The words of a batch of texts: runs of anything but ASCII white space, with A-Z as a-z.

    start, end: byte positions in the batch; text: which text holds the word; first: for each text, its first word
    (with the number of words at the end); hash: 64 bits of each word.
    """

    def __init__(self, texts: pa.Array):
        flat, bounds = flat_bytes(texts)
        n = len(flat)
        space = _SPACE[flat]
        cut = np.zeros(n + 1, bool)  # a text ends before here
        cut[bounds] = True
        solid = ~space
        begins = solid.copy()
        begins[1:] &= space[:-1] | cut[1:n]
        ends = solid.copy()
        ends[:-1] &= space[1:] | cut[1:n]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(bounds, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, bounds)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[flat] * _powers(_BASE, n), out=self._sums[1:])
        self._inverse = _powers(_INVERSE, n + 1)
        self.hash = self.prefix(None)

    def prefix(self, most: int | None) -> np.ndarray:
        """A hash of the first `most` bytes of each word, or of the whole word."""
        end = self.end if most is None else np.minimum(self.end, self.start + most)
        return mixed((self._sums[end] - self._sums[self.start]) * self._inverse[self.start] + (end - self.start).astype(np.uint64))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words within a text, and the text of each. A text of fewer words is one run."""
        counts = np.diff(self.first)
        runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        text = np.repeat(np.arange(len(counts)), runs)
        where = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + self.first[:-1][text]
        out = np.zeros(len(text), np.uint64)
        for i in range(n):
            inside = where + i < self.first[1:][text]
            word = self.hash[np.minimum(where + i, max(len(self.hash) - 1, 0))] if len(self.hash) else out
            out = np.where(inside, mixed(out * _U(3) + word + _U(i + 1)), out)
        return out, text


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct runs of n words of each text, ascending."""
    hashes, text = Words(texts).shingles(n)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def batches(stream, most: int = 1 << 19):
    """The record batches of a stream in slices whose texts (the last column) have some `most` bytes; a longer text is alone."""
    for batch in stream:
        sizes = np.diff(flat_bytes(batch.column(batch.num_columns - 1))[1])
        begin, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
