"""Stretches of words that repeat themselves with a period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are the same), at least ``max(6, 4 * q)`` words long, that no neighbouring
word extends with that period. Every run contains a word sequence of ``q`` words
that is the longest Lyndon word at its place, under an order of the words or
under the reversed order. So the longest Lyndon words of both orders, one per
place, are the candidates; each is extended both ways by the longest common
prefix with what is one period on and the longest common suffix with what is one
period back. Both come from suffix trees, of the words and of their reversal.

Words that can't lie in a run are left out before trees are built: every three
words of a run occur three times in it, and every five words twice.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .suffix_tree import CommonPrefixes, SuffixTree
from .words import mixed, run_hashes, word_hashes

# A run has this many words, and this many periods, at least.
MIN_WORDS = 6
MIN_PERIODS = 4

# (words, times) that all such word sequences inside a run occur in it.
_GRAMS = ((5, 2), (3, 3))
_ROUNDS = 8

# Words looked through at once, and put into one tree; a longer text or stretch has its own.
_BATCH_WORDS = 1 << 16
_TREE_WORDS = 1 << 14

Run = tuple[int, int, int]
Prepare = Callable[[list[bytes], int | None], list[bytes]]

_MEASURES = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
_RUNS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _stretches(hashes: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Where runs can be: (begin, end) of word sequences that hold every run whole.

    ``part`` numbers the text of each word. Equal hashes of different words only
    make the stretches longer.
    """
    at = np.arange(len(hashes))
    for _ in range(_ROUNDS):
        before = len(at)
        for words, times in _GRAMS:
            grams = run_hashes(hashes[at], words)
            whole = np.flatnonzero(part[words - 1 :] == part[: len(grams)])
            keys = mixed(grams[whole] ^ mixed(part[whole].astype(np.uint64)))
            _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
            begins = whole[count[which] >= times]
            covered = np.zeros(len(at) + 1, np.int64)
            covered[begins] += 1
            np.subtract.at(covered, begins + words, 1)
            kept = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
            at, part = at[kept], part[kept]
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(part) != 0)) + 1
            edges = np.concatenate([[0], cut, [len(at)]]) if len(at) else np.zeros(1, np.int64)
            sizes = np.diff(edges)
            part = np.repeat(np.arange(len(sizes)), sizes)
            long = np.repeat(sizes >= MIN_WORDS, sizes)
            at, part = at[long], part[long]
        if len(at) == before:
            break  # more rounds would only shorten the stretches
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(part)) + 1
    return list(zip(at[np.r_[0, cut]].tolist(), (at[np.r_[cut - 1, len(at) - 1]] + 1).tolist()))


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one of smaller rank; the length where there is none."""
    size = len(rank)
    out, waiting = [size] * size, []
    for i, value in enumerate(rank):
        while waiting and rank[waiting[-1]] > value:
            out[waiting.pop()] = i
        waiting.append(i)
    return out


def runs_of_stretches(stretches: list[list]) -> tuple[np.ndarray, ...]:
    """``(stretch, start, length, period)`` of all runs of some sequences of words, as arrays.

    The sequences stand in one text with marks around them, each of which occurs
    once, so no run and no Lyndon word goes beyond its sequence.
    """
    marks = len(stretches) + 1
    numbers: dict = {}
    text, edges = [0], [1]
    for mark, words in enumerate(stretches, 1):
        text += [numbers.setdefault(word, marks + len(numbers)) for word in words]
        text.append(mark)
        edges.append(len(text))
    symbols, size = marks + len(numbers), len(text)

    tree = SuffixTree(text, symbols)
    depths, met = tree.tour()
    common_prefix = CommonPrefixes(depths, met)
    # Marks are least in both orders, as the end of a text is.
    turned = np.arange(symbols)
    turned[marks:] = turned[marks:][::-1]
    _, met_turned = tree.tour(turned)
    del tree, depths
    common_suffix = CommonPrefixes(*SuffixTree(text[::-1], symbols).tour())

    word = np.flatnonzero(np.asarray(text) >= marks)
    found = []
    for order in (met, met_turned):
        rank = np.empty(size, np.int64)
        rank[np.argsort(order)] = np.arange(size)
        after = np.asarray(_next_smaller(rank.tolist()), np.int64)[word]
        period = after - word
        right = common_prefix(word, after)
        # The text before a place is a suffix of the reversed text.
        left = common_suffix(size - word, size - after)
        length = left + period + right
        run = length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
        found.append(np.stack([(word - left)[run], length[run], period[run]]))
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    which = np.searchsorted(edges, start, side="right") - 1
    return which, start - np.asarray(edges)[which], length, period


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs ``(start, length, period)`` of texts given as words, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    part = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    joined = [word for words in texts for word in words]
    firsts = np.cumsum([0] + [len(words) for words in texts])
    held: list[tuple[int, int]] = []

    def search() -> None:
        found = runs_of_stretches([joined[begin:end] for begin, end in held])
        for which, start, length, period in zip(*(column.tolist() for column in found)):
            place = held[which][0] + start
            text = int(part[place])
            out[text].append((place - int(firsts[text]), length, period))

    rows = 0
    for begin, end in _stretches(word_hashes(joined), part):
        if held and rows + end - begin > _TREE_WORDS:
            search()
            held, rows = [], 0
        held.append((begin, end))
        rows += end - begin
    if held:
        search()
    for runs in out:
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods, exactly compared; of equal ones the first, then of least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _batches(texts: pa.Array, keys: pa.Array, prepare: Prepare | None) -> Iterator[list[list[bytes]]]:
    held, words = [], 0
    for text, key in zip(texts, keys):
        found = (text.as_py() or b"").split()
        held.append(found if prepare is None else prepare(found, key.as_py()))
        words += len(held[-1])
        if words >= _BATCH_WORDS:
            yield held
            held, words = [], 0
    if held:
        yield held


def _measures(words: list[bytes], runs: list[Run], with_texts: bool) -> dict:
    best = strongest(runs)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = b" ".join(without_repeats(words, runs))
    row = {
        "n_runs": len(runs),
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept).hexdigest(),
    }
    if best is not None:
        row.update(zip(("start", "length", "period"), best))
        row["exponent_milli"] = 1000 * best[1] // best[2]
    if with_texts:
        row["runs"] = [dict(zip(("start", "length", "period"), run)) for run in runs]
        row["collapsed"] = kept.decode("utf-8", "replace")
    return row


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prepare: Prepare | None = None,
    key: Column | None = None,
    with_texts: bool = True,
) -> DataFrame:
    """Runs of every row's whole text, as digests and, ``with_texts``, as lists and texts.

    ``doc_id, n_runs``, the run of most periods (``start, length, period,
    exponent_milli``; NULL without one), ``runs_sha256`` of the lines
    ``start,length,period``, ``collapsed_sha256`` of the words that are left,
    joined by one space, and with texts ``runs`` and ``collapsed`` themselves.
    ``prepare`` may change the words of a text before, given the row's ``key``.

    NULL texts have no words, a NULL id stays NULL, repeated rows stay repeated,
    other columns are not read. A text that holds a run as a whole takes about
    a kilobyte of its task's memory a word.
    """
    fields = f"{_MEASURES}, {_RUNS}" if with_texts else _MEASURES

    @F.arrow_udf(f"struct<{fields}>")
    def measured(texts: pa.Array, keys: pa.Array) -> pa.Array:
        rows = []
        for batch in _batches(texts, keys, prepare):
            rows += [_measures(words, runs, with_texts) for words, runs in zip(batch, runs_of_texts(batch))]
        return pa.array(rows, schema)

    whole = pa.int64()
    run = pa.struct([("start", whole), ("length", whole), ("period", whole)])
    schema = pa.struct(
        [(name, whole) for name in ("n_runs", "start", "length", "period", "exponent_milli")]
        + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
        + ([("runs", pa.list_(run)), ("collapsed", pa.string())] if with_texts else [])
    )
    key = F.lit(None).cast("bigint") if key is None else key
    return docs.select(
        F.col(id_col).alias("doc_id"),
        measured(F.col(text_col).cast("binary"), key).alias("found"),
    ).select("doc_id", "found.*")


def with_repeated_tail(words: list[bytes], key: int | None) -> list[bytes]:
    """Every tenth text made periodic from some word on; ``key`` is a checksum of its number."""
    if key is None or key % 10 or not words:
        return words
    spare = key // 10
    begin = spare % len(words)
    period = 1 + (len(words) - begin) // (3 + spare % 8)
    unit = words[begin : begin + period]
    tail = unit * ((len(words) - begin) // period + 1)
    return words[:begin] + tail[: len(words) - begin]


def checksum(number: int) -> int:
    """What Spark's ``crc32`` gives for a number's decimal digits."""
    return zlib.crc32(str(number).encode())
