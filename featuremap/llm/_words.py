"""Word, line and n-gram hashing over whole Arrow string columns with numpy.

Texts are processed in slices of bounded size, so a task's memory follows the
slice (or one single longer text), never the partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from featuremap.session import ship_package

SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
_LONG_WORD = 4096           # bytes; longer words are hashed one by one
_C1 = np.uint64(0xFF51AFD7ED558CCD)
_C2 = np.uint64(0xC4CEB9FE1A85EC53)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _table(predicate) -> np.ndarray:
    return np.array([predicate(b) for b in range(256)], dtype=bool)


#: bytes of a word when everything but ASCII white space counts
NON_SPACE = _table(lambda b: b not in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))
#: bytes of a word of ASCII letters (lower-cased), digits and all non-ASCII characters
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(33))) * _C1
    h = (h ^ (h >> np.uint64(33))) * _C2
    return h ^ (h >> np.uint64(33))


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of at most ``limit`` text bytes (or one row)."""
    if batch.num_rows == 0:
        return
    size = np.concatenate([[0], np.cumsum(text_sizes(batch.column(text)) + 16)])
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(size, size[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        trim()
        lo = hi


def trim() -> None:
    """Give freed memory back: Spark keeps Python workers for the next tasks, and two
    or more share an executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # other C libraries
        ctypes.CDLL(None).malloc_trim(0)


@dataclass
class Words:
    """Words of several texts: text ``d`` owns words ``first[d]:first[d + 1]``."""

    data: np.ndarray        # lower-cased bytes of all texts
    start: np.ndarray       # first byte of each word
    end: np.ndarray         # byte after each word
    hash: np.ndarray        # uint64 hash of each word
    first: np.ndarray       # offsets into the words, one more than texts

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.n_words)

    def string(self, lo: int, hi: int) -> str:
        """Words ``lo:hi`` joined by one space (no word contains a space)."""
        return b" ".join(self.data[self.start[i]:self.end[i]].tobytes()
                         for i in range(lo, hi)).decode()

    def ngrams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; meaningless where the text ends earlier
        (see :meth:`whole`)."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64)
        h = self.hash[:n - k + 1].copy()
        for j in range(1, k):
            h *= _MUL
            h += self.hash[j:n - k + 1 + j]
        return mix(h)

    def whole(self, k: int) -> np.ndarray:
        """Which of :meth:`ngrams` lie inside one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, bool)
        doc = self.doc
        return doc[:n - k + 1] == doc[k - 1:]


def words(column: pa.Array, table: np.ndarray) -> Words:
    """Words of every text of a string column; A-Z lower-cased, null has none."""
    raw = column.cast(pa.binary()).to_pylist()
    raw = [b"" if x is None else x for x in raw]
    size = np.fromiter((len(x) + 1 for x in raw), np.int64, len(raw))
    buffer = b"\n".join([*raw, b"\0" * 8])          # a separator ends each text
    data = _LOWER[np.frombuffer(buffer, np.uint8)]
    inside = table[data]
    inside[-8:] = False
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    first = np.searchsorted(start, np.concatenate([[0], np.cumsum(size)]))
    return Words(data, start, end, _hash(data, start, end), first)


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time."""
    at = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))
    length = end - start
    h = length.astype(np.uint64) * _MUL + np.uint64(1)
    todo = np.flatnonzero(length <= _LONG_WORD)
    step = 0
    while len(todo):
        rest = length[todo] - step
        x = at[start[todo] + step]
        short = rest < 8
        shift = (np.where(short, 8 - rest, 0) * 8).astype(np.uint64)
        x = (x << shift) >> shift
        if step == 0 and len(todo) == len(h):
            h = mix(h ^ x)
        else:
            h[todo] = mix(h[todo] ^ x)
        step += 8
        todo = todo[rest > 8]
    for i in np.flatnonzero(length > _LONG_WORD):
        digest = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, "<u8")[0]
    return h


def ready(spark: SparkSession) -> None:
    """Ship the package, and let no Arrow batch of texts exceed ``BATCH_BYTES``: both
    sides of a Python worker hold a whole batch.  Results don't depend on it."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if size and int(size[1]) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
