"""Class-conditional Kneser-Ney models over the letters of words.

Two models, one of toxic and one of ordinary text, share what they fall back to.
A letter is predicted from up to ``ORDER - 1`` letters before it within its
word; each order interpolates with the next lower one by absolute discounting,
and below the orders that a class has itself both use the continuation counts of
the whole corpus. So an expression that neither class has counted weighs nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from math import log
from unicodedata import category

import numpy as np

from .words import Remembered

ORDER = 4
SHARED_ORDER = 2
DISCOUNT = 0.75
EDGE = " "

# Longer words, in bytes, are texts without spaces or words that something else joins.
LONGEST_WORD = 64
# Letters of a text without spaces that count as one word.
WORD_LETTERS = 5


def _joins(letter: str) -> bool:
    kind = category(letter)
    return kind[0] in "PSZ" or kind == "Cc"


_JOINS = Remembered(_joins)


def parts(word: bytes) -> list[bytes]:
    """A long word in parts, between punctuation, symbols or spaces of any kind."""
    if len(word) <= LONGEST_WORD:
        return [word]
    letters = word.decode("utf-8", "replace")
    found = "".join(" " if _JOINS[x] else x for x in letters).split()
    return [x.encode() for x in found] or [word]


def read_words(data: bytes | None) -> list[bytes]:
    """The words of a whole text, long ones in parts."""
    words = (data or b"").split()
    if max(map(len, words), default=0) <= LONGEST_WORD:
        return words
    return [part for word in words for part in parts(word)]


def lettered(word: bytes) -> str:
    """A word as the models see it: lower case, with an edge on both sides."""
    return EDGE + word.decode("utf-8", "replace").lower() + EDGE


def grams(word: bytes, order: int, least: int = 1) -> Iterable[str]:
    """Letter runs of a word that end at each letter: those of full order, and its beginnings."""
    letters = lettered(word)
    for end in range(2, len(letters) + 1):
        begin = max(0, end - order)
        if end - begin >= least:
            yield letters[begin:end]


class Level:
    """Counts of one order: per context the letters after it."""

    def __init__(self):
        self.after: dict[str, dict[str, int]] = defaultdict(dict)
        self.total: dict[str, int] = defaultdict(int)

    def add(self, gram: str, count: int) -> None:
        after = self.after[gram[:-1]]
        after[gram[-1]] = after.get(gram[-1], 0) + count
        self.total[gram[:-1]] += count


def levels(counts: dict[str, int], order: int, least: int) -> list[Level]:
    """Levels of context lengths ``least`` - 1 to ``order`` - 1, by Kneser-Ney.

    The highest has the counts themselves. A lower one counts in how many
    different letters before a run it was seen; runs at the edge of a word have
    nothing before them and keep their counts.
    """
    found = [Level() for _ in range(order)]
    kinds = counts
    for length in range(order, least - 1, -1):
        shorter: dict[str, int] = defaultdict(int)
        for gram, count in kinds.items():
            if len(gram) == length:
                found[length - 1].add(gram, count)
                # The run without its first letter: one more kind of continuation.
                shorter[gram[1:]] += 1
            elif gram[0] == EDGE:
                shorter[gram] += count
        kinds = shorter
    return found


class ClassModels:
    """The two models, compared letter by letter."""

    def __init__(
        self,
        shared: dict[str, int],
        toxic: dict[str, int],
        ordinary: dict[str, int],
        order: int = ORDER,
        shared_order: int = SHARED_ORDER,
        discount: float = DISCOUNT,
    ):
        self.order, self.shared_order, self.discount = order, shared_order, discount
        self.base = levels(shared, shared_order, 1)
        self.own = [levels(c, order, shared_order + 1) for c in (toxic, ordinary)]
        self._letters = len(self.base[0].after[""]) + 1
        self._gram_ratio = Remembered(self._ratio_of_gram)
        self.word_ratio = Remembered(self._ratio_of_word)

    def _step(self, level: Level, context: str, letter: str, lower: float) -> float:
        total = level.total.get(context)
        if not total:
            return lower
        after = level.after[context]
        count, kept = after.get(letter, 0), self.discount
        return (max(count - kept, 0.0) + kept * len(after) * lower) / total

    def _ratio_of_gram(self, gram: str) -> float:
        """Log-ratio of the last letter after the others."""
        letter, end = gram[-1], len(gram) - 1
        shared = 1.0 / self._letters
        for length in range(min(self.shared_order - 1, end) + 1):
            shared = self._step(self.base[length], gram[end - length : end], letter, shared)
        both = []
        for own in self.own:
            p = shared
            for length in range(self.shared_order, min(self.order - 1, end) + 1):
                p = self._step(own[length], gram[end - length : end], letter, p)
            both.append(p)
        return log(both[0]) - log(both[1])

    def _ratio_of_word(self, word: bytes) -> float:
        return sum(map(self._gram_ratio.__getitem__, grams(word, self.order)))

    def stretches(self, word: bytes) -> list[float]:
        """Log-ratios of the stretches of a long word that favour toxic text.

        One begins where the sum over letters is above zero, is as good as that
        sum gets, and ends where it is back at zero.
        """
        found, total, best = [], 0.0, 0.0
        for gram in grams(word, self.order):
            total += self._gram_ratio[gram]
            best = max(best, total)
            if total <= 0.0:
                found.append(best)
                total = best = 0.0
        return [*found, best]

    def log_ratios(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood of toxic less that of ordinary, of each word."""
        return np.fromiter(map(self.word_ratio.__getitem__, words), np.float64, len(words))
