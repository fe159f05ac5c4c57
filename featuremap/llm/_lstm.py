"""A bidirectional LSTM that labels every element of a sequence, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

TOKENS = 8192       # padded elements in a batch


def init(inputs: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p[f"wx{d}"] = r.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden))
        p[f"wh{d}"] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        p[f"b{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
    p["wo"] = r.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden)
    p["bo"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def batches(size: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes of sequences of like length, at most TOKENS padded elements (or one)."""
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and size[order[hi]] * (hi - lo + 1) <= TOKENS:
            hi += 1
        yield order[lo:hi]
        lo = hi


def _pad(x: np.ndarray, first: np.ndarray, size: np.ndarray, pick: np.ndarray):
    """Rows of the picked sequences as (time, sequence), with the mask, and the same reversed."""
    n = size[pick]
    t = np.arange(n.max())[:, None]
    mask = t < n
    forward = np.where(mask, first[pick] + t, 0)
    backward = np.where(mask, first[pick] + n - 1 - t, 0)
    return forward, backward, mask


def _run(x: np.ndarray, mask: np.ndarray, wx, wh, b, keep: bool):
    steps, width = mask.shape
    hidden = wh.shape[0]
    z = (x.reshape(-1, x.shape[-1]) @ wx + b).reshape(steps, width, -1)
    h, c = np.zeros((width, hidden), np.float32), np.zeros((width, hidden), np.float32)
    out, saved = np.empty((steps, width, hidden), np.float32), []
    for t in range(steps):
        g = z[t] + h @ wh
        i, f, o = (_sigmoid(g[:, k * hidden:(k + 1) * hidden]) for k in range(3))
        u = np.tanh(g[:, 3 * hidden:])
        new = f * c + i * u
        th = np.tanh(new)
        if keep:
            saved.append((h, c, i, f, o, u, th))
        m = mask[t][:, None]
        c = np.where(m, new, c)
        h = np.where(m, o * th, h)
        out[t] = h
    return out, saved


def predict(p: dict, x: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Score of each row of ``x``; sequence s has the rows first[s] .. first[s] + size[s]."""
    out = np.zeros(len(x), np.float32)
    hidden = p["whf"].shape[0]
    for pick in batches(size):
        forward, backward, mask = _pad(x, first, size, pick)
        for at, d, w in ((forward, "f", p["wo"][:hidden]), (backward, "b", p["wo"][hidden:])):
            h, _ = _run(x[at], mask, p["wx" + d], p["wh" + d], p["b" + d], False)
            out[at[mask]] += (h @ w)[mask]
    return out + p["bo"][0]


def _back(x, mask, saved, dh_out, wx, wh):
    steps, width = mask.shape
    hidden = wh.shape[0]
    dz = np.empty((steps, width, 4 * hidden), np.float32)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((width, hidden), np.float32), np.zeros((width, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, u, th = saved[t]
        m = mask[t][:, None]
        dh_t = np.where(m, dh + dh_out[t], 0)
        dc_t = np.where(m, dc, 0) + dh_t * o * (1 - th * th)
        g = np.concatenate([dc_t * u * i * (1 - i), dc_t * c * f * (1 - f),
                            dh_t * th * o * (1 - o), dc_t * i * (1 - u * u)], 1)
        dz[t] = g
        dwh += h.T @ g
        dh = np.where(m, g @ wh.T, dh)
        dc = np.where(m, dc_t * f, dc)
    flat = dz.reshape(-1, 4 * hidden)
    return x.reshape(-1, x.shape[-1]).T @ flat, dwh, flat.sum(0)


def train(x: np.ndarray, y: np.ndarray, first: np.ndarray, size: np.ndarray, hidden: int = 16,
          epochs: int = 8, rate: float = 0.01, seed: int = 0, corrupt=None) -> dict[str, np.ndarray]:
    """Adam on the cross-entropy of all elements; ``corrupt(x, rng)`` may hide inputs."""
    r = np.random.default_rng(seed)
    p = init(x.shape[1], hidden, seed)
    mean, var = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    groups = [g[i:i + 16] for g in batches(size) for i in range(0, len(g), 16)]
    for _ in range(epochs):
        for k in r.permutation(len(groups)):
            forward, backward, mask = _pad(x, first, size, groups[k])
            seen = corrupt(x, r) if corrupt else x
            runs = []
            for at, d, w in ((forward, "f", p["wo"][:hidden]), (backward, "b", p["wo"][hidden:])):
                h, saved = _run(seen[at], mask, p["wx" + d], p["wh" + d], p["b" + d], True)
                runs.append((at, d, w, h, saved))
            flat = np.zeros(len(x), np.float32)
            for at, _, w, h, _ in runs:
                flat[at[mask]] += (h @ w)[mask]
            score = flat + p["bo"][0]
            error = np.zeros(len(x), np.float32)
            error[forward[mask]] = (_sigmoid(score[forward[mask]]) - y[forward[mask]]) / mask.sum()
            grad = {"bo": np.array([error.sum()], np.float32), "wo": np.zeros_like(p["wo"])}
            for j, (at, d, w, h, saved) in enumerate(runs):
                e = np.where(mask, error[at], 0)
                grad["wo"][j * hidden:(j + 1) * hidden] = np.einsum("tb,tbh->h", e, h)
                grad["wx" + d], grad["wh" + d], grad["b" + d] = _back(
                    seen[at], mask, saved, e[:, :, None] * w, p["wx" + d], p["wh" + d])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for name, g in grad.items():
                g = g / max(1.0, norm)
                mean[name] = 0.9 * mean[name] + 0.1 * g
                var[name] = 0.999 * var[name] + 0.001 * g * g
                p[name] = p[name] - rate * (mean[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(var[name] / (1 - 0.999 ** step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in p.items()}
