"""Best-matching-unit kernels run inside Arrow-batched Python UDFs.

Rows arrive as a numpy block; the codebook (K x d) is broadcast.  The exact
squared distance is ``sum_f (z_f - w_f)^2`` accumulated feature by feature,
in feature order, so it is bit-identical to the same sum written in SQL.
Ties go to the lowest ``(x, y)``, i.e. the lowest row-major index.

For wide features (d > 8) the candidates are screened with the matrix form
``|z|^2 + |w|^2 - 2 z.w`` (one BLAS product); only units within a rounding
margin of the row's best are then evaluated exactly, so the answer is the
same as the exact scan at a fraction of its cost.
"""

from __future__ import annotations

import numpy as np

# rows per block so that the n x K distance matrix stays near 64 MB
_BLOCK_CELLS = 8_000_000
_SCREEN_MIN_D = 9


def squared_distances(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    n, d = z.shape
    out = np.zeros((n, w.shape[0]))
    for f in range(d):
        diff = z[:, f, None] - w[None, :, f]
        out += diff * diff
    return out


def _exact_pairs(z: np.ndarray, w: np.ndarray, rows: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Exact squared distance of ``z[rows[i]]`` to ``w[units[i]]``, in feature order."""
    out = np.zeros(rows.size)
    for f in range(z.shape[1]):
        diff = z[rows, f] - w[units, f]
        out += diff * diff
    return out


def _screened(z: np.ndarray, w: np.ndarray, second: bool):
    """Best (and second-best) units via the matrix form, then exact ties."""
    n, k = z.shape[0], w.shape[0]
    approx = (np.einsum("ij,ij->i", z, z)[:, None] + np.einsum("ij,ij->i", w, w)[None, :]
              - 2.0 * (z @ w.T))
    scale = np.einsum("ij,ij->i", z, z)[:, None] + np.einsum("ij,ij->i", w, w)[None, :]
    margin = 1e-9 * (1.0 + scale)                       # far above the product's rounding
    exact = np.full((n, k), np.inf)
    lo = approx.min(axis=1, keepdims=True)
    near = approx <= lo + 2 * margin
    if second:
        # the second-best set: everything within the margin of the 2nd smallest value
        part = np.partition(approx, 1, axis=1)[:, 1:2] if k > 1 else lo
        near |= approx <= part + 2 * margin
    r, u = np.nonzero(near)
    exact[r, u] = _exact_pairs(z, w, r, u)
    best = np.argmin(exact, axis=1)
    d1 = exact[np.arange(n), best]
    b2 = None
    if second and k > 1:
        exact[np.arange(n), best] = np.inf
        b2 = np.argmin(exact, axis=1)
    return best, d1, b2


def best_units(z: np.ndarray, w: np.ndarray, second: bool = False):
    """Index and distance of the best (and second-best) unit of every row.

    Rows with a NaN feature get index -1 and NaN distance.
    """
    n = z.shape[0]
    k = w.shape[0]
    b1 = np.full(n, -1, dtype=np.int64)
    d1 = np.full(n, np.nan)
    b2 = np.full(n, -1, dtype=np.int64)
    ok = ~np.isnan(z).any(axis=1)
    step = max(1, _BLOCK_CELLS // max(k, 1))
    idx = np.nonzero(ok)[0]
    for s in range(0, idx.size, step):
        rows = idx[s:s + step]
        if z.shape[1] >= _SCREEN_MIN_D:
            best, sq, sec = _screened(z[rows], w, second)
            b1[rows] = best
            d1[rows] = np.sqrt(sq)
            if sec is not None:
                b2[rows] = sec
            continue
        d2 = squared_distances(z[rows], w)
        best = np.argmin(d2, axis=1)
        b1[rows] = best
        d1[rows] = np.sqrt(d2[np.arange(rows.size), best])
        if second and k > 1:
            d2[np.arange(rows.size), best] = np.inf
            b2[rows] = np.argmin(d2, axis=1)
    return b1, d1, b2
