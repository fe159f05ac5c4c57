"""Map configuration (M5), neighbourhood kernels (M4) and decay schedules."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np

from ...errors import InvalidConfigError

NEIGHBORHOODS = ("gaussian", "mexican_hat", "bubble", "triangle")
INITIALIZATIONS = ("random", "random_samples", "pca", "grid")
DECAYS = ("asymptotic", "inverse", "linear", "exponential", "none")


@dataclass
class SOMConfig:
    x: int = 10
    y: int = 10
    input_len: int = 0            # 0: inferred from the data
    sigma: float = 1.0
    learning_rate: float = 0.5
    random_seed: int = 42
    neighborhood_function: str = "gaussian"
    initialization: str = "random"
    decay_function: str = "asymptotic"
    decay_learning_rate: bool = False

    def __post_init__(self):
        self.validate()

    def validate(self) -> None:
        if int(self.x) <= 0 or int(self.y) <= 0:
            raise InvalidConfigError(f"map size must be positive, got {self.x}x{self.y}")
        if self.input_len < 0:
            raise InvalidConfigError("input_len must be positive")
        if not self.sigma > 0:
            raise InvalidConfigError("sigma must be positive")
        if not 0 < self.learning_rate <= 1:
            raise InvalidConfigError("learning_rate must be in (0, 1]")
        if self.neighborhood_function not in NEIGHBORHOODS:
            raise InvalidConfigError(f"unknown neighborhood {self.neighborhood_function!r}")
        if self.initialization not in INITIALIZATIONS:
            raise InvalidConfigError(f"unknown initialization {self.initialization!r}")
        if self.decay_function not in DECAYS:
            raise InvalidConfigError(f"unknown decay {self.decay_function!r}")
        if not (3 <= self.x <= 30 and 3 <= self.y <= 30):
            warnings.warn(f"map {self.x}x{self.y} outside the advised 3..30 per side")

    @property
    def k(self) -> int:
        return self.x * self.y


def grid_coords(x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
    """Neuron coordinates in row-major order: index k = i * y + j."""
    gi, gj = np.meshgrid(np.arange(x), np.arange(y), indexing="ij")
    return gi.ravel().astype(float), gj.ravel().astype(float)


def neighborhood(kind: str, x: int, y: int, sigma: float) -> np.ndarray:
    """``H[k, b]``: influence of best-matching unit ``b`` on neuron ``k``."""
    gi, gj = grid_coords(x, y)
    dx = gi[:, None] - gi[None, :]
    dy = gj[:, None] - gj[None, :]
    d = 2.0 * sigma * sigma
    p = dx * dx + dy * dy
    if kind == "gaussian":
        return np.exp(-p / d)
    if kind == "mexican_hat":
        return np.exp(-p / d) * (1.0 - 2.0 * p / d)
    if kind == "bubble":
        return ((np.abs(dx) < sigma) & (np.abs(dy) < sigma)).astype(float)
    if kind == "triangle":
        return np.maximum(0.0, sigma - np.abs(dx)) * np.maximum(0.0, sigma - np.abs(dy))
    raise InvalidConfigError(f"unknown neighborhood {kind!r}")


def axis_terms(kind: str, x: int, y: int, sigma: float) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """The neighbourhood as a sum of (factor, x-by-x, y-by-y) products: for neurons
    (i, j) and (u, v), ``h = sum(factor * a[i, u] * b[j, v])``."""
    dx, dy = (np.subtract.outer(np.arange(n, dtype=float), np.arange(n, dtype=float)) for n in (x, y))
    if kind == "bubble":
        return [(1.0, (np.abs(dx) < sigma).astype(float), (np.abs(dy) < sigma).astype(float))]
    if kind == "triangle":
        return [(1.0, np.maximum(0.0, sigma - np.abs(dx)), np.maximum(0.0, sigma - np.abs(dy)))]
    d = 2.0 * sigma * sigma
    gx, gy = np.exp(-dx * dx / d), np.exp(-dy * dy / d)
    if kind == "gaussian":
        return [(1.0, gx, gy)]
    if kind == "mexican_hat":
        return [(1.0, gx, gy), (-2.0, gx * dx * dx / d, gy), (-2.0, gx, gy * dy * dy / d)]
    raise InvalidConfigError(f"unknown neighborhood {kind!r}")


def smooth(kind: str, x: int, y: int, sigma: float, values: np.ndarray) -> np.ndarray:
    """``neighborhood(...) @ values`` for ``values`` of one row per neuron, one axis after
    the other: matrices of x by x and y by y only, whatever the map's size."""
    grid = values.reshape(x, y, -1)
    out = np.zeros(grid.shape)
    for factor, a, b in axis_terms(kind, x, y, sigma):
        rows = (a @ grid.reshape(x, -1)).reshape(grid.shape)
        out += factor * (b @ rows)
    return out.reshape(values.shape)


def total_influence(kind: str, x: int, y: int, sigma: float, counts: np.ndarray) -> np.ndarray:
    """``abs(neighborhood(...)) @ counts``.  Only the mexican hat has negative parts; its
    size is no sum of products, so it is added up by distance along x."""
    if kind != "mexican_hat":
        return smooth(kind, x, y, sigma, counts)
    grid, out = counts.reshape(x, y), np.zeros((x, y))
    dy = np.subtract.outer(np.arange(y, dtype=float), np.arange(y, dtype=float))
    d = 2.0 * sigma * sigma
    for dx in range(x):
        p = dx * dx + dy * dy
        h = np.abs(np.exp(-p / d) * (1.0 - 2.0 * p / d))
        out[dx:] += grid[:x - dx] @ h
        if dx:
            out[:x - dx] += grid[dx:] @ h
    return out.ravel()


def decay(v0: float, epoch: int, epochs: int, kind: str) -> float:
    """Value of a radius / rate at ``epoch`` (0-based) of ``epochs``."""
    e, n = float(epoch), float(max(epochs, 1))
    if kind == "asymptotic":
        return v0 / (1.0 + e / (n / 2.0))
    if kind == "inverse":
        c = n / 100.0
        return v0 * c / (c + e)
    if kind == "linear":
        return v0 * (1.0 - e / n)
    if kind == "exponential":
        return v0 * math.exp(-e / (n / 4.0))
    return v0


def default_grid_size(n_rows: int, rule: str = "half_sqrt") -> tuple[int, float]:
    """Square map side and sigma from the row count.

    ``half_sqrt``: side ``min(15, max(5, int(sqrt(n) / 2)))``;
    ``five_sqrt``: about ``5 * sqrt(n)`` neurons, side within 3..30.
    ``sigma = max(1, side / 4)`` in both cases.
    """
    if rule == "half_sqrt":
        side = min(15, max(5, int(math.sqrt(n_rows) / 2)))
    elif rule == "five_sqrt":
        side = min(30, max(3, int(round(math.sqrt(5.0 * math.sqrt(max(n_rows, 1)))))))
    else:
        raise InvalidConfigError(f"unknown grid rule {rule!r}")
    return side, max(1.0, side / 4.0)
