"""Singular values and vectors of a small triangular matrix, by way of a bidiagonal one.

The matrix is as wide as a vector is long, whatever the number of rows was.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_TINY = np.finfo(float).tiny

# Singular values closer than this, as a share of the larger, make a cluster.
_CLUSTER = 1e-4
_ROUNDS = 4


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``v, scale, head`` so that ``x - scale * v * (v @ x)`` is ``(head, 0, ...)``."""
    tail = np.linalg.norm(x[1:])
    v = np.zeros_like(x)
    v[0] = 1.0
    if tail == 0:
        return v, 0.0, float(x[0])
    head = -np.copysign(np.hypot(x[0], tail), x[0])
    v[1:] = x[1:] / (x[0] - head)
    return v, float((head - x[0]) / head), float(head)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``diagonal, above, right``: ``matrix = Q @ B @ right.T`` with ``Q`` and ``right`` orthogonal.

    Householder reflections from the left and the right in turn. ``B`` has the
    two diagonals and the singular values of ``matrix``; ``Q`` isn't kept.
    """
    a = np.array(matrix, float)
    size = a.shape[1]
    right = np.eye(size)
    for k in range(size):
        v, scale, head = _reflector(a[k:, k])
        a[k:, k:] -= scale * np.outer(v, v @ a[k:, k:])
        a[k, k] = head
        if k + 2 < size:
            v, scale, head = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= scale * np.outer(a[k:, k + 1 :] @ v, v)
            a[k, k + 1] = head
            right[:, k + 1 :] -= scale * np.outer(right[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _dqds(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values of an unreduced bidiagonal from its squared entries.

    Differential quotient-difference steps with shifts: each step is a Cholesky
    factorisation of the shifted product the other way round, without a
    subtraction but that of the shift, so small values keep their digits. The
    last entry gives way when what couples it is negligible against it.
    """
    q, e = list(q), list(e)
    out, total = [], 0.0
    shift = 0.0
    while q:
        n = len(q)
        if n == 1:
            out.append(total + q[0])
            break
        if e[-1] <= (_EPS**2) * (total + q[-1]):
            out.append(total + q.pop())
            e.pop()
            shift = 0.0
            continue
        split = next((i for i in range(n - 2, -1, -1) if e[i] <= _EPS**2 * (total + min(q[i], q[i + 1]))), None)
        if split is not None:
            out += [total + v for v in _dqds(q[split + 1 :], e[split + 1 :])]
            del q[split + 1 :], e[split:]
            shift = 0.0
            continue
        while True:
            d = q[0] - shift
            new_q, new_e, least = [], [], d
            for i in range(n - 1):
                value = d + e[i]
                if value <= 0:
                    least = -1.0
                    break
                new_q.append(value)
                ratio = q[i + 1] / value
                new_e.append(e[i] * ratio)
                d = d * ratio - shift
                least = min(least, d)
            if least >= 0 or shift == 0:
                break
            # A shift beyond the least value; a smaller one is tried, in the end none.
            shift = shift / 4 if shift > _EPS * (total + q[-1]) else 0.0
        new_q.append(d)
        q, e, total = new_q, new_e, total + shift
        # The least eigenvalue of the last two rows is close below the least of all.
        a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1], e[-1]
        half = (a + b + c) / 2
        under = max(half * half - a * b, 0.0)
        corner = a * b / (half + under**0.5) if half > 0 else 0.0
        shift = max(0.0, min(corner, least) * (1 - 1e-8) - 4 * _EPS * total)
    return out


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, in falling order."""
    largest = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if largest == 0:
        return np.zeros(len(diagonal))
    values = _dqds(list((diagonal / largest) ** 2), list((above / largest) ** 2))
    return np.sort(np.sqrt(np.maximum(values, 0.0)))[::-1] * largest


def negligible(values: np.ndarray) -> float:
    """Singular values up to this are zero as far as rounding lets one say."""
    return 8 * len(values) * _EPS * float(values.max(initial=0.0))


def _twisted(diagonal: np.ndarray, above: np.ndarray, shift: float):
    """The two factorisations of ``B.T @ B - shift`` from both ends, and where they meet best.

    Returns multipliers from above and below and the twist's place and pivot.
    """
    size = len(diagonal)
    main = diagonal**2
    main[1:] += above**2
    side = diagonal[:-1] * above
    floor = _TINY / _EPS + _EPS * _EPS * (abs(shift) + main.max())
    down, up = np.empty(size), np.empty(size)
    lower, upper = np.zeros(size), np.zeros(size)
    # From above: stationary; s is what the shift and the rows before have left.
    s = -shift
    for i in range(size - 1):
        pivot = diagonal[i] ** 2 + s
        if abs(pivot) < floor:
            pivot = -floor
        down[i] = s
        lower[i] = side[i] / pivot
        s = above[i] ** 2 * (s / pivot) - shift
    down[-1] = s
    # From below: progressive.
    p = diagonal[-1] ** 2 - shift
    up[-1] = p
    for i in range(size - 2, -1, -1):
        pivot = above[i] ** 2 + p
        if abs(pivot) < floor:
            pivot = -floor
        upper[i] = side[i] / pivot
        p = diagonal[i] ** 2 * (p / pivot) - shift
        up[i] = p
    pivots = down + up + shift
    return lower, upper, pivots


def _vector(lower: np.ndarray, upper: np.ndarray, at: int) -> np.ndarray:
    """What the twisted factorisation at a place gives: its equations but that one hold."""
    z = np.zeros(len(lower))
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(at, len(z) - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of an unreduced bidiagonal, as columns, by falling ``values``."""
    size = len(diagonal)
    out = np.zeros((size, size))
    largest = max(values[0], _TINY)
    main = diagonal**2
    main[1:] += above**2
    side = diagonal[:-1] * above
    product = np.diag(main) + np.diag(side, 1) + np.diag(side, -1)
    none = negligible(values)
    begin = 0
    while begin < size:
        end = begin + 1
        if values[begin] <= none:
            end = size
        while end < size and values[end - 1] - values[end] <= _CLUSTER * values[end - 1]:
            end += 1
        taken: list = []
        for k in range(begin, end if values[begin] > none else begin):
            lower, upper, pivots = _twisted(diagonal, above, values[k] ** 2)
            place = next(i for i in np.argsort(np.abs(pivots), kind="stable") if i not in taken)
            taken.append(place)
            out[:, k] = _vector(lower, upper, place)
        if values[begin] <= none:
            out[:, begin:] = np.linalg.qr(out[:, :begin], "complete")[0][:, begin:]
        elif end - begin > 1:
            # Vectors of a cluster: together orthogonal, then those of the product within them.
            inside = out[:, begin:end]
            middle = float(np.mean(values[begin:end] ** 2))
            spread = max(values[begin] ** 2 - values[end - 1] ** 2, 64 * _EPS * largest**2)
            rng = np.random.default_rng(size)
            inside = inside + _EPS * rng.standard_normal(inside.shape)
            for _ in range(_ROUNDS):
                inside, r = np.linalg.qr(inside)
                weak = np.abs(np.diagonal(r)) < 1e-6
                inside[:, weak] = rng.standard_normal((size, int(weak.sum())))
                inside, _ = np.linalg.qr(inside)
                inside = np.linalg.solve(product - (middle + 1.5 * spread) * np.eye(size), inside)
                inside /= np.linalg.norm(inside, axis=0)
            inside, _ = np.linalg.qr(inside)
            small, turn = np.linalg.eigh(inside.T @ product @ inside)
            out[:, begin:end] = inside @ turn[:, np.argsort(small)[::-1]]
        begin = end
    return out


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a square matrix, falling, and its right singular vectors as columns."""
    size = matrix.shape[1]
    scale = np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.zeros(size), np.eye(size)
    diagonal, above, right = bidiagonal(matrix / scale)
    largest = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    # A negligible entry splits the matrix. So does a zero on the diagonal, after
    # a tiny value has taken its place.
    diagonal = np.where(np.abs(diagonal) < _EPS * largest * 1e-3, _EPS * largest * 1e-3, diagonal)
    edges = [0, *(np.flatnonzero(np.abs(above) <= _EPS * 1e-3 * largest) + 1).tolist(), size]
    values, vectors = [], np.zeros((size, size))
    for begin, end in zip(edges, edges[1:]):
        d, a = diagonal[begin:end], above[begin : end - 1]
        found = singular_values(d, a)
        values.append(found)
        vectors[begin:end, begin:end] = _block_vectors(d, a, found)
    joined = np.concatenate(values)
    order = np.argsort(-joined, kind="stable")
    return joined[order] * scale, right @ vectors[:, order]
