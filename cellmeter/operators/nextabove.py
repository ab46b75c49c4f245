"""Next larger value in an array, for many queries at once."""

from __future__ import annotations

import numpy as np


def first_above(
    values: np.ndarray, start: np.ndarray, limit: np.ndarray, longest: int | None = None
) -> np.ndarray:
    """Index of the first ``values[i] > limit`` with ``i >= start``, per query.

    ``len(values)`` where there is none. Works on maxima of runs of 1, 2, 4, …
    values and skips the longest runs that stay within the limit. Where every
    query ends less than ``longest`` values behind its start, longer runs are not made.
    """
    n = len(values)
    far = n if longest is None else min(n, longest)
    at = np.minimum(start, n)
    if n == 0 or len(at) == 0:
        return at
    runs = [values]
    while 2 ** len(runs) <= far:
        half = runs[-1]
        width = 2 ** (len(runs) - 1)
        runs.append(np.maximum(half[:-width], half[width:]))
    for level in range(len(runs) - 1, -1, -1):
        run = runs[level]
        fits = at < len(run)
        skip = fits & (run[np.where(fits, at, 0)] <= limit)
        at = at + skip * 2**level
    return at
