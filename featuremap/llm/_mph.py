"""Minimal perfect hash over 128-bit keys, built level by level with numpy.

Each level maps the keys still open into a bit array of ``GAMMA`` bits a key;
a key alone on its bit is settled there, the others go on to the next level.
The slot of a key is the rank of its bit over all levels, so n keys get the
slots 0..n-1.  Foreign keys may land on any slot: callers compare a stored
fingerprint.  About 3.7 bits a key.
"""

from __future__ import annotations

import struct

import numpy as np

from featuremap.llm._words import mix

GAMMA = 2.0
_STEP = 0x9E3779B97F4A7C15


def _position(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mix(b + np.uint64((level + 1) * _STEP % 2 ** 64))
    return mix(a ^ seed) % np.uint64(size)


def build(a: np.ndarray, b: np.ndarray) -> bytes:
    """The function for distinct keys (a[i], b[i]), both uint64, as bytes."""
    out, level = [], 0
    while len(a):
        size = max(64, -(-int(GAMMA * len(a)) // 64) * 64)
        at = _position(a, b, level, size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        out.append(np.packbits(alone, bitorder="little").tobytes())
        open_ = ~alone[at]
        a, b, level = a[open_], b[open_], level + 1
        if level > 200:
            raise ValueError("keys are not distinct")
    return struct.pack("<I", len(out)) + b"".join(struct.pack("<Q", len(x)) + x for x in out)


class Mph:
    """Look up slots; -1 where no level has the bit set."""

    def __init__(self, data: bytes):
        (n,) = struct.unpack_from("<I", data)
        self.levels, at, rank = [], 4, 0
        for _ in range(n):
            (size,) = struct.unpack_from("<Q", data, at)
            bits = np.frombuffer(data, "<u8", size // 8, at + 8)
            count = np.bitwise_count(bits).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(count)])
            self.levels.append((bits, rank + before[:-1]))
            rank += int(before[-1])
            at += 8 + size
        self.size = rank

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        todo = np.arange(len(a))
        for level, (bits, before) in enumerate(self.levels):
            if not len(todo):
                break
            at = _position(a[todo], b[todo], level, len(bits) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            value = bits[word]
            here = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[here]] = before[word[here]] + below[here]
            todo = todo[~here]
        return out
