"""Words and word shingles of a text, as 64-bit numbers.

A word is a run of ``[^\\x20\\x09-\\x0D]``. On UTF-8 bytes that is what
``bytes.split()`` gives, so texts are handed to Python as binary columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

SHINGLE_WORDS = 5

# Words a worker remembers; it forgets all of them when full, which costs time only.
_REMEMBERED = 1_000_000
_LONGEST_REMEMBERED = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Remembered(dict):
    """Values of a function of short byte strings, as many as fit the bound."""

    def __init__(self, value, bound: int = _REMEMBERED, longest: int = _LONGEST_REMEMBERED):
        super().__init__()
        self._value, self._bound, self._longest = value, bound, longest

    def __missing__(self, key):
        value = self._value(key)
        if len(key) <= self._longest:
            if len(self) >= self._bound:
                self.clear()
            self[key] = value
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    # A hash costs less than to look it up, so no word is remembered.
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Values with every input bit spread over every output bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * _MIX[0]
        values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, by its first word."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            total = total * _STEP + hashes[i : i + count]
    return mixed(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values of a short array, without what ``np.unique`` costs per call."""
    ordered = values.copy()
    ordered.sort()
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingle_set(hashes: np.ndarray, length: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingles; a text shorter than one shingle is one itself."""
    if 0 < len(hashes) < length:
        return run_hashes(hashes, len(hashes))
    return distinct(run_hashes(hashes, length))


# Words that are hashed together; more of a longer text.
_HASHED_WORDS = 1 << 14


def hashed_texts(texts: Iterable[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Some texts at a time, the hashes of their words, one after another, and where each one's end."""
    some, words, ends = [], [], []
    for data in texts:
        some.append(data)
        words += data.split()
        ends.append(len(words))
        if len(words) >= _HASHED_WORDS:
            yield some, word_hashes(words), np.array(ends)
            some, words, ends = [], [], []
    if some:
        yield some, word_hashes(words), np.array(ends)


def shingle_sets(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """What ``shingle_set`` gives of the words of each text, for less than one call each."""
    for _, hashes, ends in hashed_texts(texts):
        runs = run_hashes(hashes, SHINGLE_WORDS)
        begin = 0
        for end in ends.tolist():
            if end - begin < SHINGLE_WORDS:
                yield shingle_set(hashes[begin:end])
            else:
                yield distinct(runs[begin : end - SHINGLE_WORDS + 1])
            begin = end
