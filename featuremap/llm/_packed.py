"""Integers packed for an exchange."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Integers as byte planes (of their differences if ascending), compressed."""
    values = values.astype("<u8", copy=False) if values.dtype.kind == "u" else values.astype("<i8").view("<u8")
    if ascending and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = np.ascontiguousarray(values.view("u1").reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    """What :func:`pack` got, as uint64."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def runs(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, start, end) of the parts that ascending uint64 keys fall into; a part is
    a range of hashes."""
    step = np.uint64(min((1 << 64) // parts + 1, (1 << 64) - 1))
    part = np.minimum(keys // step, np.uint64(parts - 1))
    start = np.flatnonzero(np.diff(part, prepend=~part[:1]))
    return list(zip(part[start].tolist(), start.tolist(), [*start[1:].tolist(), len(keys)], strict=False))
