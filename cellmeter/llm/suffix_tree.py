"""Suffix trees by Ukkonen's algorithm, and common extensions in constant time."""

from __future__ import annotations

import numpy as np

# Entries of a tour that one minimum stands for.
_BLOCK = 16


class SuffixTree:
    """The tree of all suffixes of ``text``, symbols from 0 to ``symbols - 1``.

    The last symbol of ``text`` occurs nowhere else, so every suffix ends in a
    leaf of its own.
    """

    def __init__(self, text: list[int], symbols: int):
        size = len(text)
        first, stop, link = [0], [0], [0]
        leaves: list[int] = []
        child: dict[int, int] = {}
        node = edge = along = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not along:
                    edge = i
                key = node * symbols + text[edge]
                below = child.get(key)
                if below is None:
                    leaves.append(len(first))
                    child[key] = len(first)
                    first.append(i)
                    stop.append(size)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = first[below]
                    span = stop[below] - begin
                    if along >= span:
                        edge += span
                        along -= span
                        node = below
                        continue
                    met = text[begin + along]
                    if met == symbol:
                        along += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    inner = len(first)
                    leaves.append(inner + 1)
                    first += (begin, i)
                    stop += (begin + along, size)
                    link += (0, 0)
                    first[below] = begin + along
                    child[key] = inner
                    child[inner * symbols + met] = below
                    child[inner * symbols + symbol] = inner + 1
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
                    edge = i - waiting + 1
        edges = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        self._above, self._symbol = np.divmod(edges, symbols)
        self._below = below
        self._length = np.asarray(stop, np.int64) - np.asarray(first, np.int64)
        self._suffix = np.full(len(first), -1, np.int64)
        # Leaves are made in the order of their suffixes.
        self._suffix[leaves] = np.arange(size)
        self._size = size

    def tour(self, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour: string depth of every visit, and at which visit each suffix's leaf is met.

        Children are visited by ``rank`` of their edge's first symbol, by default
        by the symbol itself.
        """
        key = self._symbol if rank is None else rank[self._symbol]
        order = np.lexsort((key, self._above))
        below = self._below[order].tolist()
        starts = np.searchsorted(self._above[order], np.arange(len(self._length) + 1)).tolist()
        length, suffix = self._length.tolist(), self._suffix.tolist()
        depths: list[int] = []
        met = [0] * self._size
        # Nodes on the way down: next child, end of children, depth.
        at, ends, deep = [starts[0]], [starts[1]], [0]
        while at:
            depth = deep[-1]
            depths.append(depth)
            next_child = at[-1]
            if next_child == ends[-1]:
                at.pop()
                ends.pop()
                deep.pop()
                continue
            at[-1] = next_child + 1
            node = below[next_child]
            if suffix[node] >= 0:
                met[suffix[node]] = len(depths)
                depths.append(depth + length[node])
            else:
                at.append(starts[node])
                ends.append(starts[node + 1])
                deep.append(depth + length[node])
        return np.asarray(depths, np.int32), np.asarray(met, np.int64)


class CommonPrefixes:
    """Longest common prefix of any two suffixes: the depth of their lowest common ancestor.

    That is the least depth of an Euler tour between their leaves. Minima of
    blocks are kept for every power of two of blocks, and running minima inside
    blocks from both sides, so a question takes constant time.
    """

    def __init__(self, depths: np.ndarray, met: np.ndarray):
        self._met = met
        blocks = len(depths) // _BLOCK + 1
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(depths)] = depths
        grid = padded.reshape(blocks, _BLOCK)
        self._depths = padded
        self._upto = np.minimum.accumulate(grid, axis=1).ravel()
        self._from = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self._table = [grid.min(axis=1)]
        while 2 ** len(self._table) <= blocks:
            last, half = self._table[-1], 2 ** (len(self._table) - 1)
            self._table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of different suffixes ``a`` and ``b``, pair by pair."""
        low, high = self._met[a], self._met[b]
        low, high = np.minimum(low, high), np.maximum(low, high)
        least = np.minimum(self._from[low], self._upto[high])
        left, right = low // _BLOCK, high // _BLOCK
        inside = np.flatnonzero(left == right)
        if len(inside):
            at, end = low[inside], high[inside]
            found = self._depths[at]
            for _ in range(_BLOCK - 1):
                at = np.minimum(at + 1, end)
                found = np.minimum(found, self._depths[at])
            least[inside] = found
        between = right - left - 1
        level = np.frexp(np.maximum(between, 1))[1] - 1
        for power, table in enumerate(self._table):
            chosen = np.flatnonzero((between > 0) & (level == power))
            if len(chosen):
                begin, end = left[chosen] + 1, right[chosen] - 2**power
                found = np.minimum(table[begin], table[end])
                least[chosen] = np.minimum(least[chosen], found)
        return least
