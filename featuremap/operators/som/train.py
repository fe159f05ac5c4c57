"""Self-organizing map training.

``mode="batch"`` (the default): every epoch is one distributed pass:

    persisted scaled rows --(Arrow UDF, broadcast codebook)--> best unit per row
      --> groupBy(unit).agg(count, sum of each feature, sum of distances)

The aggregate is partial per partition (map-side), so the shuffle carries at
most K rows per partition whatever the skew, and K rows reach the driver,
where the neighbourhood smoothing of the batch rule runs, along x and then along y:

    w_k <- w_k + lr * sum_b h(k,b) (s_b - n_b w_k) / sum_b |h(k,b)| n_b

``mode="online"``: the rule that moves the codebook after every sample (``online.py``).
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...errors import DimensionMismatchError, InsufficientDataError, SOMError
from ...functions.columns import numeric_columns, q
from ...functions.partitions import spread_persisted
from ...session import ship_package
from ..base import Estimator
from . import online
from .config import SOMConfig, decay, smooth, total_influence
from .model import SOMModel, feature_columns, score_udf, share


class SOM(Estimator):
    """Estimator of a ``SOMModel``.

    ``features``: numeric columns (default: all numeric columns), or
    ``vector_col``: one array column.  ``handle_null``: ``error`` (default) or
    ``skip`` rows with a NULL/NaN feature.  ``epochs`` passes; a ``tol`` above 0
    ends training when the quantization error changes by less.  Random
    initialization picks ``x * y`` distinct feature vectors by a seeded hash, or,
    with ``init_key`` (a column that identifies rows), that many rows by the md5
    of key and seed.

    ``mode="online"`` visits single rows in a seeded order: by the md5 of
    ``init_key``, or of the feature values where there is none.  ``workers`` partitions
    learn side by side (default: the cluster's parallelism; 1 is the sequential rule)
    and are averaged ``syncs`` times an epoch.  The learning rate always decays there.
    """

    def __init__(self, x: int = 10, y: int = 10, features: list[str] | None = None,
                 vector_col: str | None = None, epochs: int = 20, tol: float = 0.0,
                 handle_null: str = "error", init_key: str | None = None, mode: str = "batch",
                 workers: int | None = None, syncs: int = 1, **config):
        self.config = SOMConfig(x=x, y=y, **config)
        self.features = features
        self.vector_col = vector_col
        self.epochs = int(epochs)
        self.tol = tol
        if handle_null not in ("error", "skip"):
            raise SOMError("handle_null must be 'error' or 'skip'")
        self.handle_null = handle_null
        self.init_key = init_key
        if mode not in ("batch", "online"):
            raise SOMError("mode must be 'batch' or 'online'")
        if syncs < 1 or (workers is not None and workers < 1):
            raise SOMError("workers and syncs must be at least 1")
        self.mode, self.workers, self.syncs = mode, workers, int(syncs)

    # ------------------------------------------------------------------ helpers
    def _dimension(self, df: DataFrame) -> tuple[list[str] | None, int]:
        if self.vector_col:
            vector = F.col(q(self.vector_col))
            size = F.when(vector.isNotNull(), F.size(vector))
            row = df.agg(F.min(size).alias("lo"), F.max(size).alias("hi")).first()
            if row["lo"] is None:
                raise InsufficientDataError("no rows to infer the vector length from")
            if row["lo"] != row["hi"]:
                raise DimensionMismatchError(
                    f"vectors of '{self.vector_col}' have {row['lo']} to {row['hi']} elements")
            return None, int(row["lo"])
        feats = self.features or numeric_columns(df)
        return list(feats), len(feats)

    def fit(self, df: DataFrame) -> SOMModel:
        cfg = self.config
        features, d = self._dimension(df)
        # 0 or 1 (the configuration default) mean "take it from the data"
        if cfg.input_len > 1 and cfg.input_len != d:
            raise DimensionMismatchError(f"expected {cfg.input_len} features, got {d}")
        cfg.input_len = d
        raw = feature_columns(df, features, self.vector_col, d)
        # the raw features are kept once (spilling to disk if needed) and spread
        # over all cores: the bounds job materializes them and every epoch
        # re-reads them through the Python kernel without recomputing the input
        rcols = [f"__r{i}" for i in range(d)]
        key = [F.col(q(self.init_key)).cast("string").alias("__key")] if self.init_key else []
        kept = df.select(*[c.alias(r) for c, r in zip(raw, rcols)], *key)
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        any_null = F.lit(False)
        for r in rcols:
            any_null = any_null | F.col(r).isNull()

        # one job: size, null rows, bounds (M6, M7)
        aggs = [F.count(F.lit(1)).alias("n"), F.count_if(any_null).alias("nulls")]
        # rows that will be dropped don't count for the bounds
        used = [F.when(~any_null, F.col(r)) for r in rcols]
        aggs += [F.min(r).alias(f"mn{i}") for i, r in enumerate(used)]
        aggs += [F.max(r).alias(f"mx{i}") for i, r in enumerate(used)]
        try:
            row = kept.agg(*aggs).first()
            n = row["n"] - (row["nulls"] if self.handle_null == "skip" else 0)
            if row["nulls"] and self.handle_null == "error":
                raise SOMError(f"{row['nulls']} rows have NULL/NaN features "
                               "(handle_null='skip' drops them)")
            if n < 3:
                raise InsufficientDataError(f"at least 3 rows are needed, got {n}")
        except Exception:
            kept.unpersist()
            raise
        kept = spread_persisted(kept)
        if n < 3 * cfg.k:
            warnings.warn(f"{n} rows for {cfg.k} neurons: fewer than 3 rows per neuron")
        mins = np.array([row[f"mn{i}"] for i in range(d)], dtype=float)
        maxs = np.array([row[f"mx{i}"] for i in range(d)], dtype=float)

        model = SOMModel(cfg, np.zeros((cfg.k, d)), mins, maxs, features, self.vector_col)
        zcols = [f"__z{i}" for i in range(d)]
        scaled = kept.select(*[((F.col(r) - F.lit(float(lo))) / F.lit(float(rg))).alias(z)
                               for r, lo, rg, z in zip(rcols, mins, model.ranges, zcols)],
                             *(["__key"] if self.init_key else []))
        if self.handle_null == "skip":
            scaled = scaled.dropna(subset=zcols)
        try:
            W = self._init(scaled, zcols, cfg)
            if self.mode == "online":
                W, history = self._online(scaled, zcols, W)
                return SOMModel(cfg, W, mins, maxs, features, self.vector_col, history)
            history = []
            prev = None
            for e in range(self.epochs):
                sigma = decay(cfg.sigma, e, self.epochs, cfg.decay_function)
                lr = (decay(cfg.learning_rate, e, self.epochs, cfg.decay_function)
                      if cfg.decay_learning_rate else cfg.learning_rate)
                counts, sums, dist = epoch_statistics(scaled, zcols, W)
                qe = dist / n
                history.append((e, qe, sigma, lr))
                W = batch_update(W, counts, sums, cfg, sigma, lr)
                if self.tol and prev is not None and abs(prev - qe) < self.tol:
                    break
                prev = qe
        finally:
            kept.unpersist()
        return SOMModel(cfg, W, mins, maxs, features, self.vector_col, history)

    def _online(self, scaled: DataFrame, zcols: list[str], W: np.ndarray):
        key = (F.coalesce("__key", F.lit("")) if self.init_key
               else F.concat_ws(",", *[F.col(z).cast("string") for z in zcols]))
        workers = self.workers or scaled.sparkSession.sparkContext.defaultParallelism
        dealt = online.deal(scaled.select(*zcols, *(["__key"] if self.init_key else [])), key, workers)
        dealt = dealt.select("key", *zcols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return online.train(dealt, zcols, W, self.config, self.epochs, self.syncs)
        finally:
            dealt.unpersist()

    # ------------------------------------------------------------------ init (M2, M3)
    def _init(self, scaled: DataFrame, zcols: list[str], cfg: SOMConfig) -> np.ndarray:
        K, d = cfg.k, len(zcols)
        if cfg.initialization == "grid":
            return grid_codebook(cfg.x, cfg.y, d)
        if cfg.initialization == "pca":
            return pca_codebook(scaled, zcols, cfg.x, cfg.y)
        # random / random_samples, a distributed top-K: distinct vectors (combined
        # map-side) in the order of a seeded hash, so copies of a row count once; or
        # rows in the order of the md5 of their key
        if self.init_key:
            order = F.md5(F.concat(F.col("__key"), F.lit(f":{cfg.random_seed}")))
            rows = scaled.orderBy(order, *zcols).limit(K).collect()
        else:
            rows = (scaled.select(*zcols).distinct()
                    .orderBy(F.xxhash64(*zcols, F.lit(cfg.random_seed)), *zcols).limit(K).collect())
        pick = np.array([[r[z] for z in zcols] for r in rows], dtype=float)
        return np.array([pick[i % len(pick)] for i in range(K)])


def grid_codebook(x: int, y: int, d: int) -> np.ndarray:
    """Deterministic init: feature f is ``(i+.5)/x`` for even f, ``(j+.5)/y`` for odd f."""
    W = np.zeros((x * y, d))
    for i in range(x):
        for j in range(y):
            for f in range(d):
                W[i * y + j, f] = (i + 0.5) / x if f % 2 == 0 else (j + 0.5) / y
    return W


#: squarings of the covariance; they settle eigenvalues that differ in the 13th digit
SQUARINGS = 50


def covariance(rows: DataFrame, zcols: list[str]) -> np.ndarray:
    """Sample covariance from one aggregate: every partition adds up its products first,
    so d * d / 2 numbers a partition are shuffled and come to the driver."""
    d = len(zcols)
    i, j = np.triu_indices(d + 1)           # index d stands for the constant 1

    def run(batches):
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            z = np.column_stack([*(batch.column(c).to_numpy(zero_copy_only=False) for c in zcols),
                                 np.ones(batch.num_rows)])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    total = np.zeros((d + 1, d + 1))
    for r in (rows.select(*zcols).mapInArrow(run, "i long, j long, s double")
              .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()):
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["s"]
    n, sums = total[d, d], total[:d, d]
    return (total[:d, :d] - np.outer(sums, sums) / n) / (n - 1)


def leading_direction(cov: np.ndarray) -> np.ndarray:
    """Unit vector of the largest eigenvalue by power iteration, squaring the matrix; its
    largest entry is positive.  Zeros for a matrix without one."""
    m, scale = cov, np.abs(cov).max()
    if not scale > 0:
        return np.zeros(len(cov))
    for _ in range(SQUARINGS):
        m = m / np.abs(m).max()
        m = m @ m
    v = m @ (1.0 / np.arange(1, len(cov) + 1))
    v = v / np.sqrt((v * v).sum())
    return -v if v[np.argmax(np.abs(v))] < 0 else v


def pca_codebook(scaled: DataFrame, zcols: list[str], x: int, y: int) -> np.ndarray:
    """Span the first two principal directions: ``w(i,j) = a_i pc1 + b_j pc2``,
    ``a, b`` evenly spaced in [-1, 1].  The second is that of the covariance without
    the part along the first; a part below rounding gives no direction."""
    cov = covariance(scaled, zcols)
    pc1 = leading_direction(cov)
    rest = cov - (pc1 @ cov @ pc1) * np.outer(pc1, pc1)
    pc2 = (leading_direction(rest) if np.abs(rest).max() > 1e-12 * np.abs(cov).max()
           else np.zeros(len(zcols)))
    a, b = np.linspace(-1, 1, x), np.linspace(-1, 1, y)
    return np.array([a[i] * pc1 + b[j] * pc2 for i in range(x) for j in range(y)])


def epoch_statistics(scaled: DataFrame, zcols: list[str], W: np.ndarray):
    """One pass: rows per best unit, feature sums per unit, total distance."""
    spark = scaled.sparkSession
    ship_package(spark)
    bc = share(spark, W)
    b = score_udf(bc, second=False)(*[F.col(z) for z in zcols])
    rows = (scaled.select(b.alias("b"), *zcols)
            .groupBy(F.col("b.k").alias("k"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("b.dist").alias("dist"),
                 *[F.sum(z).alias(z) for z in zcols])
            .collect())
    K, d = W.shape
    counts, sums, dist = np.zeros(K), np.zeros((K, d)), 0.0
    for r in rows:
        if r["k"] is None:
            continue
        counts[r["k"]] = r["n"]
        sums[r["k"]] = [r[z] for z in zcols]
        dist += r["dist"]
    if hasattr(bc, "unpersist"):
        bc.unpersist()
    return counts, sums, dist


def batch_update(W: np.ndarray, counts: np.ndarray, sums: np.ndarray, cfg: SOMConfig,
                 sigma: float, lr: float) -> np.ndarray:
    """The damped batch rule; neurons with no weighted hits keep their weights."""
    at = cfg.neighborhood_function, cfg.x, cfg.y, sigma
    den = total_influence(*at, counts)
    both = smooth(*at, np.column_stack([sums, counts]))
    num = both[:, :-1] - both[:, -1:] * W
    ok = den > 0
    out = W.copy()
    out[ok] += lr * num[ok] / den[ok, None]
    return out
