"""Sample-by-sample map training (M1): sequential updates in parallel workers.

Every row has a place in each epoch's order, a number in [0, 1) from a seeded md5 of
its key.  Rows are dealt to ``workers`` partitions once; in an epoch, each partition
visits its rows in that order and moves its own copy of the codebook after every row:

    w_k <- w_k + lr(t) * h(k, b; sigma(t)) * (z - w_k),    t = (epoch + place) / epochs

At each sync point (``syncs`` per epoch, equal parts of the order) the copies are
averaged, weighted by the rows they saw, in one aggregate of K rows.  With one worker
that is the sequential rule itself; more workers trade exactness for parallel passes,
and more sync points bring the copies closer together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...session import ship_package
from .config import SOMConfig, decay
from .model import share

PLACES = 1 << 32


def place(key: Column, seed: int, epoch: int) -> Column:
    """The row's place in the epoch's order, in [0, 1)."""
    digest = F.md5(F.concat(key, F.lit(f":{seed}:{epoch}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(PLACES))


def influence(kind: str, x: int, y: int, unit: int, sigma: float) -> np.ndarray:
    """How far a sample of ``unit`` moves every unit, in row-major order."""
    dx = np.arange(x, dtype=float) - unit // y
    dy = np.arange(y, dtype=float) - unit % y
    if kind == "bubble":
        return np.outer(np.abs(dx) < sigma, np.abs(dy) < sigma).ravel().astype(float)
    if kind == "triangle":
        return np.outer(np.maximum(0.0, sigma - np.abs(dx)), np.maximum(0.0, sigma - np.abs(dy))).ravel()
    d = 2.0 * sigma * sigma
    p = (dx * dx)[:, None] + (dy * dy)[None, :]
    h = np.exp(-p / d)
    return (h * (1.0 - 2.0 * p / d) if kind == "mexican_hat" else h).ravel()


def update(w: np.ndarray, z: np.ndarray, at: np.ndarray, epoch: int, epochs: int, cfg: SOMConfig) -> float:
    """Move ``w`` by every row of ``z`` in turn; the sum of the rows' distances."""
    total = 0.0
    for row, place_ in zip(z, at.tolist(), strict=True):
        t = epoch + place_
        diff = row - w
        sq = diff[:, 0] * diff[:, 0]
        for f in range(1, w.shape[1]):
            sq = sq + diff[:, f] * diff[:, f]
        best = int(sq.argmin())
        total += float(np.sqrt(sq[best]))
        lr = decay(cfg.learning_rate, t, epochs, cfg.decay_function)
        h = influence(cfg.neighborhood_function, cfg.x, cfg.y, best,
                      decay(cfg.sigma, t, epochs, cfg.decay_function))
        w += (lr * h)[:, None] * diff
    return total


def _visit(codebook, cfg: SOMConfig, epoch: int, epochs: int, zcols: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = codebook.value.copy()
        n, dist = 0, 0.0
        for batch in batches:
            z = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in zcols])
            dist += update(w, z, batch.column("place").to_numpy(), epoch, epochs, cfg)
            n += len(z)
        if n:
            k = len(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k)), pa.array(np.full(k, n)), pa.array(np.full(k, dist)),
                 *(pa.array(w[:, f] * n) for f in range(w.shape[1]))], names=["k", "n", "dist", *zcols])

    return run


def deal(scaled: DataFrame, key: Column, workers: int) -> DataFrame:
    """Rows (with their key) in the partitions that keep them for all epochs."""
    rows = scaled.withColumn("key", key)
    return rows.repartition(1) if workers == 1 else rows.repartition(workers, "key")


def train(dealt: DataFrame, zcols: list[str], w: np.ndarray, cfg: SOMConfig, epochs: int, syncs: int):
    """The trained codebook and, per epoch, (epoch, mean distance while learning, sigma, lr)."""
    spark = dealt.sparkSession
    ship_package(spark)
    schema = ", ".join(["k long", "n long", "dist double", *(f"{c} double" for c in zcols)])
    history = []
    for epoch in range(epochs):
        rows = dealt.withColumn("place", place(F.col("key"), cfg.random_seed, epoch))
        n, dist = 0, 0.0
        for part in range(syncs):
            mine = rows.filter((F.col("place") >= part / syncs) & (F.col("place") < (part + 1) / syncs))
            bc = share(spark, w)
            moved = (mine.sortWithinPartitions("place", "key", *zcols).select("place", *zcols)
                     .mapInArrow(_visit(bc, cfg, epoch, epochs, zcols), schema))
            sums = moved.groupBy("k").agg(F.sum("n").alias("n"), F.sum("dist").alias("dist"),
                                          *(F.sum(c).alias(c) for c in zcols)).collect()     # K rows
            if hasattr(bc, "unpersist"):
                bc.unpersist()
            if sums:
                w = w.copy()
                for r in sums:
                    w[r["k"]] = [r[c] / r["n"] for c in zcols]
                n, dist = n + sums[0]["n"], dist + sums[0]["dist"]
        history.append((epoch, dist / n if n else 0.0, decay(cfg.sigma, epoch, epochs, cfg.decay_function),
                        decay(cfg.learning_rate, epoch, epochs, cfg.decay_function)))
    return w, history
