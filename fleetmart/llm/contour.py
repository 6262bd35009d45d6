"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

An integral of the resolvent (z - A)^-1 around an interval projects onto the eigenvectors of the eigenvalues inside. A
quadrature turns it into a few complex solves with shifted copies of A; a Rayleigh-Ritz step in the projected subspace
gives eigenpairs. How many eigenvalues an interval holds is known beforehand from the inertia of A at its two ends, so
none can be missed unnoticed. The matrix has the size of a vector squared, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

#: A pivot of one row is taken while it is at least this part of the largest entry.
_SINGLE = (1 + 17**0.5) / 8
EPS = float(np.finfo(np.float64).eps)


def above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of a symmetric factorisation of a - shift, fully pivoted."""
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        n = len(m)
        diagonal = np.abs(np.diag(m))
        i = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diag(m)))
        r, c = divmod(int(off.argmax()), n)
        if diagonal[i] == 0 and off[r, c] == 0:
            break
        if diagonal[i] >= _SINGLE * off[r, c]:
            positive += bool(m[i, i] > 0)
            rest = np.delete(np.arange(n), i)
            m = m[np.ix_(rest, rest)] - np.outer(m[rest, i], m[i, rest]) / m[i, i]
        else:
            # Such a pivot of two rows has one positive and one negative eigenvalue.
            positive += 1
            pair = [min(r, c), max(r, c)]
            rest = np.delete(np.arange(n), pair)
            m = m[np.ix_(rest, rest)] - m[np.ix_(rest, pair)] @ np.linalg.solve(m[np.ix_(pair, pair)], m[np.ix_(pair, rest)])
    return positive


def located(a: np.ndarray, wanted: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """(lo, hi): bounds of the ``wanted`` largest eigenvalues, each found by counting, until neighbours are told apart.

    Neighbours closer than a small part of the spectrum's width stay together.
    """
    lo, hi = np.full(wanted, low), np.full(wanted, high)
    tiny = 1e-7 * (high - low)
    while True:
        width = hi - lo
        gap = lo[:-1] - hi[1:]
        near = gap < 4 * np.maximum(width[:-1], width[1:])
        vague = np.zeros(wanted, bool)
        vague[:-1] |= near
        vague[1:] |= near
        vague &= width > tiny
        if not vague.any():
            return lo, hi
        j = int(np.where(vague, width, -1).argmax())
        shift = (lo[j] + hi[j]) / 2
        n = above(a, shift)
        lo[:n] = np.maximum(lo[:n], shift)
        hi[n:] = np.minimum(hi[n:], shift)


def feast(a: np.ndarray, low: float, high: float, count: int, scale: float, nodes: int = 8, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Vectors of the ``count`` eigenvalues between two shifts; ``scale`` is the size of the matrix."""
    n = len(a)
    middle, radius = (low + high) / 2, (high - low) / 2
    x, weight = np.polynomial.legendre.leggauss(nodes)
    # The lower half of the circle gives the conjugate, so the real part stands for both.
    turns = radius * np.exp(1j * np.pi / 2 * (1 - x))
    inverses = [np.linalg.inv((middle + t) * np.eye(n) - a) for t in turns]
    y = np.random.default_rng(seed).standard_normal((n, min(n, count + max(4, count // 2))))
    for _ in range(rounds):
        projected = sum(w / 2 * (t * (r @ y)).real for w, t, r in zip(weight, turns, inverses))
        basis, _ = np.linalg.qr(projected)
        values, inner = np.linalg.eigh(basis.T @ a @ basis)
        y = basis @ inner
        inside = np.flatnonzero((values > low) & (values < high))
        wrong = np.linalg.norm(a @ y[:, inside] - y[:, inside] * values[inside], axis=0)
        if len(inside) == count and (wrong <= 32 * EPS * scale * np.sqrt(n)).all():
            return y[:, inside]
    if nodes < 64:
        return feast(a, low, high, count, scale, 2 * nodes, rounds, seed + 1)
    raise ArithmeticError(f"{len(inside)} of {count} eigenvalues between {low} and {high} found")


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``wanted`` largest eigenvalues of a positive semidefinite matrix, without those that are zero to rounding.

    Every cluster of eigenvalues has an interval of its own, that ends in the middle of the gaps beside it.
    """
    a = (a + a.T) / 2
    scale = float(np.abs(a).sum(1).max(initial=0.0))
    zero, high = len(a) * 16 * EPS * scale, scale * (1 + 1e-6)
    positive = above(a, zero) if scale > 0 else 0
    wanted = k = min(wanted, positive)
    if not wanted:
        return np.zeros(0), np.zeros((len(a), 0))
    while True:
        more = min(k + 1, positive)
        lo, hi = located(a, more, zero, high)
        apart = lo[:-1] > hi[1:] + 1e-8 * scale
        if more == k or apart[k - 1]:
            break
        # The last one wanted cannot be told from the next: that one belongs to its interval.
        k = more
    below = hi[k] if more > k else zero
    ends = [j for j in range(k) if j == k - 1 or apart[j]]
    vectors, first = [], 0
    for j in ends:
        under = lo[j] - (hi[j + 1] if j < k - 1 else below)
        margin = max(min(under, lo[first - 1] - hi[first] if first else under), 0.0) / 2
        bounds = lo[j] - margin, hi[first] + margin
        found = feast(a, *bounds, j - first + 1, scale)
        if above(a, bounds[0]) - above(a, bounds[1]) != found.shape[1]:
            raise ArithmeticError("the inertia counts other eigenvalues than were found")
        vectors.append(found)
        first = j + 1
    basis, _ = np.linalg.qr(np.concatenate(vectors, 1))
    values, inner = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], basis @ inner[:, order]
