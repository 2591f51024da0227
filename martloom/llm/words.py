"""Words of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than the space and the five control characters
tab to carriage return. All texts of a batch are laid end to end, so that one pass of
array arithmetic handles them, however long or short each of them is.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WITHOUT_MARKS = bytes.maketrans(
    string.punctuation.encode(), b" " * len(string.punctuation)
)
_RANDOM = np.random.default_rng(20_240_611)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits all depend on all input bits."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def text_slices(texts: Sequence[str | None], size: int = 4_000_000) -> Iterator[slice]:
    """Consecutive texts of together about ``size`` characters, so that the arrays made of
    them stay small; a longer text stands alone."""
    begin = filled = 0
    for at, text in enumerate(texts):
        filled += len(text or "") + 8
        if filled >= size:
            yield slice(begin, at + 1)
            begin, filled = at + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


@dataclass
class Words:
    """``data[start[i]:end[i]]`` is word i; text t has the words ``first[t]:first[t + 1]``."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def split_words(texts: Sequence[str | None], lower: bool, marks: bool = True) -> Words:
    """Words of every text; a missing text has none. ``lower`` maps A-Z to a-z.

    Without ``marks``, ASCII punctuation separates words like a space.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(encoded) + b"\n"
    if lower:
        data = data.lower()
    if not marks:
        data = data.translate(_WITHOUT_MARKS)
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate([[0], edges])
    start, end = edges[0::2], edges[1::2]
    lengths = np.fromiter((len(e) + 1 for e in encoded), dtype=np.int64, count=len(encoded))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    first = np.searchsorted(start, bounds)
    return Words(data, start, end, first, _word_hashes(data, start, end))


def _word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word: its bytes' random values, weighted by powers of an odd number.

    Summed block by block: a word's sum is the difference of two running sums, scaled
    by a power of the inverse so that it does not depend on the word's place.
    """
    out = np.empty(len(start), dtype=np.uint64)
    inverse = np.uint64(pow(int(_STEP), -1, 2**64))
    raw = np.frombuffer(data, dtype=np.uint8)
    block = 1 << 20
    done = 0
    while done < len(start):
        base = start[done]
        stop = max(done + 1, int(np.searchsorted(end, base + block, side="right")))
        part = _BYTE_VALUES[raw[base : end[stop - 1]]]
        powers = _powers(_STEP, len(part))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers, out=sums[1:])
        left, right = start[done:stop] - base, end[done:stop] - base
        out[done:stop] = (sums[right] - sums[left]) * _powers(inverse, len(part))[left]
        done = stop
    return mixed(out)


_known_powers: dict[int, np.ndarray] = {}


def _powers(of: np.uint64, count: int) -> np.ndarray:
    known = _known_powers.get(int(of))
    if known is None or len(known) < count:
        known = np.full(max(count, (1 << 20) + 1), of, dtype=np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if len(known) > (1 << 21):
            return known
        _known_powers[int(of)] = known
    return known[:count]


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words that start at each word, and whether they are one text's."""
    n = len(words)
    out = np.zeros(n, dtype=np.uint64)
    whole = np.zeros(n, dtype=bool)
    if n >= size:
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for j in range(size):
            total += words.hashes[j : n - size + 1 + j] * _WEIGHTS[j]
        out[: n - size + 1] = mixed(total)
        last = np.repeat(words.first[1:], words.counts())
        whole = np.arange(n) + size <= last
    return out, whole


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of every text, sorted, and where each text begins.

    A text with fewer words has its whole sequence as its only shingle; without words
    it has none.
    """
    hashes, whole = grams(words, size)
    counts = words.counts()
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    short = np.flatnonzero((counts > 0) & (counts < size))
    values = np.empty(first[-1], dtype=np.uint64)
    full = np.ones(first[-1], dtype=bool)
    full[first[short]] = False
    values[full] = hashes[whole]
    for text in short:
        part = words.hashes[words.first[text] : words.first[text + 1]]
        # The length takes part, so that a short text never equals a full shingle.
        total = (part * _WEIGHTS[: len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
        values[first[text]] = mixed(np.array([total]))[0]
    for begin, stop in zip(first[:-1], first[1:]):
        values[begin:stop].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[first[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[first]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part from 0 by the leading bits, so that sorted hashes have sorted parts."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def part_bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted ``hashes``."""
    return np.searchsorted(part_of(hashes, parts), np.arange(parts + 1))
