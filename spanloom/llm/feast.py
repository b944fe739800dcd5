"""Leading eigenpairs of a symmetric matrix by FEAST contour integration.

The spectrum is cut into intervals at gaps, found by bisection on inertia counts. In each interval, quadrature of the resolvent over a circle (shifted complex
solves) projects a block of vectors onto the interval's eigenspace, Rayleigh-Ritz extracts the pairs, and the inertia count tells whether any is missing.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

NODES = 8  # quadrature nodes on the upper half circle
WIDTH = 8  # eigenvalues an interval is meant to hold at most
CLEAR = 0.05
ROUNDS = 60
#: Eigenvalues up to this share of the largest count as zero.
ZERO = 1e-10
_ALPHA = (1 + 17**0.5) / 8


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: the positive ones of D in the factors L D L' of matrix - shift (Bunch-Kaufman pivots, Sylvester's law)."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, found = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size = 1
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if most > 0 and abs(a[k, k]) < _ALPHA * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if abs(a[k, k]) * row.max() < _ALPHA * most**2:
                    if abs(a[r, r]) >= _ALPHA * row.max():
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        size = 2
        if size == 1:
            pivot = a[k, k]
            found += pivot > 0
            if pivot:
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / pivot, a[k, k + 1 :])
        else:
            found += 1  # such a block has an eigenvalue of each sign
            a[k + 2 :, k + 2 :] -= a[k + 2 :, k : k + 2] @ np.linalg.solve(a[k : k + 2, k : k + 2], a[k : k + 2, k + 2 :])
        k += size
    return found


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the top, that together hold the ``wanted`` largest positive eigenvalues at least.

    A cut lies in the middle of a gap: the farther the neighbours outside lie from the circle, the fewer rounds ``solve`` needs. Of the next ``WIDTH`` gaps the
    last one of ``CLEAR`` of its interval at least is taken, else the widest, else the first after them that is clear enough.
    """
    n, top = len(matrix), float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger (Gershgorin)
    near = top * 1e-13
    wanted = min(wanted, count_above(matrix, top * ZERO)) if top > 0 else 0

    @lru_cache(maxsize=None)
    def place(j: int) -> tuple[float, float]:
        """Bounds of the j-th largest eigenvalue, 1/1000 of it or ``near`` apart."""
        low, high = (near, place(j - 1)[1] if j > 1 else top)
        if count_above(matrix, low) < j:
            return 0.0, low
        while high - low > max(near, low / 1000):
            middle = (low * high) ** 0.5 if high > 2 * low else (low + high) / 2
            low, high = (middle, high) if count_above(matrix, middle) >= j else (low, middle)
        return low, high

    cuts, before, above = [], 0, top
    while before < wanted:
        best, first = (-1.0, 0, 0.0), place(before + 1)[1]
        for j in range(before + 1, n + 1):
            own = place(j)[0]
            gap = own - place(j + 1)[1] if j < n else first - own + own / 2 + near
            share = gap / (first - own + 2 * max(gap, near))
            if share >= min(best[0], CLEAR):
                best = (share, j, gap)
            if j >= before + WIDTH and best[0] >= CLEAR / 2:
                break
        _, j, gap = best
        gap = max(gap, near)
        cuts.append((place(j)[0] - gap / 2, first + min(above, gap) / 2, j - before))
        before, above = j, gap
    return cuts


def solve(matrix: np.ndarray, low: float, high: float, inside: int) -> np.ndarray:
    """Orthonormal columns that span the eigenspace of the ``inside`` eigenvalues between ``low`` and ``high``; raises ArithmeticError if any stays missing."""
    n = len(matrix)
    block = np.random.default_rng(inside).standard_normal((n, min(n, inside + max(WIDTH, inside // 2))))
    points, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius, size = (low + high) / 2, (high - low) / 2, np.abs(matrix).sum(axis=1).max()
    angles = np.exp(0.5j * np.pi * (1 - points))
    before = np.inf
    for _ in range(ROUNDS):
        projected = np.zeros_like(block)
        for angle, weight in zip(angles, weights):
            shifted = (centre + radius * angle) * np.eye(n) - matrix
            projected += weight / 2 * (radius * angle * np.linalg.solve(shifted, block.astype(complex))).real
        basis = np.linalg.qr(projected)[0]
        values, mix = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ mix
        errors = np.abs(matrix @ block - block * values).max(axis=0)
        own = (values > low) & (values <= high) & (errors <= 1e-12 * size)  # Ritz values that stand for no eigenvalue have large errors
        found = block[:, own]
        if found.shape[1] == inside:
            worst = errors[own].max()
            if worst <= 4 * np.finfo(float).eps * size or worst >= before / 2:
                return found
            before = worst
    raise ArithmeticError(f"{inside} eigenvalues between {low} and {high}, {found.shape[1]} found")


def combine(matrix: np.ndarray, spaces: list[np.ndarray], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues and their unit vectors (columns), by Rayleigh-Ritz over the eigenspaces of all intervals."""
    if not spaces:
        return np.zeros(0), np.zeros((len(matrix), 0))
    basis = np.linalg.qr(np.concatenate(spaces, axis=1))[0]
    values, mix = np.linalg.eigh(basis.T @ matrix @ basis)
    kept = min(wanted, int((values > ZERO * np.abs(matrix).sum(axis=1).max()).sum()))
    return values[::-1][:kept], (basis @ mix)[:, ::-1][:, :kept]
