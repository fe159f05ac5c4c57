"""Bloom filters over 64-bit hashes, united by Spark.

A key sets five bits of one 64-bit word, so a task sends at most one row per
key.  A filter only saves work: whatever passes it is looked at exactly later,
and a filter too small for its keys lets more pass.  So its size can be bound
(``MAX_BITS``) without bounding the keys, and it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm._words import mix

MAX_BITS = 1 << 28


def _places(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(keys)
    b = mix(a ^ np.uint64(0x5851F42D4C957F2D))
    mask = np.zeros(len(keys), np.uint64)
    for i in range(5):
        mask |= np.uint64(1) << ((b >> np.uint64(6 * i)) & np.uint64(63))
    return a & np.uint64(words - 1), mask


_PAGE = 4096        # words


def build(df: DataFrame, column: str, n: int) -> np.ndarray:
    """The filter over the longs of ``column``, about ``n`` of them."""
    return build_levels(df.select(F.col(column).alias("t"), F.lit(0).cast("long").alias("k")), [(0, n)])[0]


def build_levels(df: DataFrame, levels: list[tuple[int, int]], bits_per_key: int = 16) -> list[np.ndarray]:
    """A filter per (least k, about how many keys) over the keys ``t`` with at least
    that ``k``.  Pages of the filters are united by Spark and come to the driver
    packed, MAX_BITS / 8 bytes a level at most."""
    sizes = [(k, (1 << min(max(n * bits_per_key - 1, 1023).bit_length(), MAX_BITS.bit_length() - 1)) // 64)
             for k, n in levels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, k = batch.column("t").to_numpy().view("u8"), batch.column("k").to_numpy()
            for level, (least, words) in enumerate(sizes):
                at, mask = _places(t[k >= least], words)
                if not len(at):
                    continue
                order = np.argsort(at)
                at, mask = at[order], mask[order]
                first = np.flatnonzero(np.diff(at, prepend=at[:1] + np.uint64(1)))
                at, value = at[first].view("i8"), np.bitwise_or.reduceat(mask, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at // _PAGE * len(sizes) + level), pa.array(at % _PAGE), pa.array(value.view("i8"))],
                    names=["page", "at", "value"])

    def unite(table: pa.Table) -> pa.Table:
        page = np.zeros(_PAGE, np.uint64)
        np.bitwise_or.at(page, table.column("at").to_numpy(), table.column("value").to_numpy().view("u8"))
        return pa.table({"page": table.column("page")[:1], "words": [page.tobytes()]})

    rows = (df.select("t", "k").mapInArrow(run, "page long, at long, value long")
            .groupBy("page").applyInArrow(unite, "page long, words binary").toArrow())
    out = [np.zeros(words, np.uint64) for _, words in sizes]
    for page, words in zip(rows.column("page").to_pylist(), rows.column("words"), strict=True):
        table, lo = out[page % len(sizes)], page // len(sizes) * _PAGE
        part = np.frombuffer(words.as_buffer(), "<u8")
        table[lo:lo + _PAGE] = part[:len(table) - lo]
    return out


def test(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at, mask = _places(keys, len(table))
    return table[at] & mask == mask
