"""K-means over weighted rows, several numbers of clusters at once.

Seeding is k-means||: the first candidate is the row that comes first in a seeded md5
order of the key; in each of ``rounds`` rounds a row joins the candidates with
probability ``oversampling * max(ks) * weight * d2 / cost`` (its place in the round's
md5 order decides, so a run can be repeated).  Candidates are weighted by the rows next
to them and thinned out greedily, so the starts of all ``ks`` are beginnings of one
sequence.  Every pass over the rows (cost, weights, one Lloyd step of all ``ks``) is one
job that adds up inside each partition first: at most sum(ks) rows a partition are
shuffled, and sum(ks) rows reach the driver.

Rows with a null feature or a weight that is null or not above 0 have no part in the
fit; rows with a null feature get a null cluster.  Fewer distinct rows than clusters
give fewer clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InsufficientDataError, TransformerError
from ..functions.columns import q
from ..session import ship_package
from .base import Estimator, Model
from .som.kernel import squared_distances
from .som.model import feature_columns, score_udf, share
from .som.online import place

_BLOCK = 65_536             # rows whose distances are held at once


def _matrix(batch: pa.RecordBatch, zcols: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in zcols])


def _nearest(z: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index (ties: lowest) and squared distance of every row's center."""
    best, d2 = np.empty(len(z), np.int64), np.empty(len(z))
    for lo in range(0, len(z), _BLOCK):
        d = squared_distances(z[lo:lo + _BLOCK], centers)
        best[lo:lo + _BLOCK] = d.argmin(1)
        d2[lo:lo + _BLOCK] = d.min(1)
    return best, d2


def _sums(centers, zcols: list[str]):
    """Per center set and center: weight, cost, weighted sums of the rows next to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = centers.value
        total = [np.zeros((len(c), len(zcols) + 2)) for c in sets]
        for batch in batches:
            z, w = _matrix(batch, zcols), batch.column("w").to_numpy(zero_copy_only=False)
            for c, t in zip(sets, total, strict=True):
                best, d2 = _nearest(z, c)
                for f, values in enumerate((w, w * d2, *(w * z[:, i] for i in range(len(zcols))))):
                    t[:, f] += np.bincount(best, values, len(c))
        for i, t in enumerate(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(t), i)), pa.array(np.arange(len(t))), *(pa.array(t[:, f]) for f in range(t.shape[1]))],
                names=["part", "c", "w", "cost", *zcols])

    return run


def _sample(centers, zcols: list[str], rate: float):
    """Rows that join the candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, d2 = _nearest(_matrix(batch, zcols), centers.value)
            pick = (batch.column("place").to_numpy(zero_copy_only=False)
                    < rate * batch.column("w").to_numpy(zero_copy_only=False) * d2)
            yield batch.select(["key", *zcols]).filter(pa.array(pick))

    return run


class KMeans(Estimator):
    """``features`` (numeric columns) or ``vector_col`` (an array column of ``size``
    elements); ``key`` identifies rows; ``weight`` is a column, or every row counts once."""

    def __init__(self, features: list[str] | None = None, key: str = "id", ks=(5,), weight: str | None = None,
                 vector_col: str | None = None, size: int | None = None, seed: int = 42, rounds: int = 2,
                 oversampling: float = 2.0, iterations: int = 20):
        self.ks = sorted(set(ks))
        if not self.ks or self.ks[0] < 1 or rounds < 1 or oversampling <= 0 or iterations < 0:
            raise TransformerError("ks, rounds and oversampling must be positive")
        if not features and not (vector_col and size):
            raise TransformerError("features, or vector_col with size, are needed")
        self.features, self.vector_col, self.size = features, vector_col, size or len(features or [])
        self.key, self.weight, self.seed, self.rounds = key, weight, seed, rounds
        self.oversampling, self.iterations = oversampling, iterations

    def fit(self, df: DataFrame) -> "KMeansModel":
        spark = df.sparkSession
        ship_package(spark)
        zcols = [f"z{i}" for i in range(self.size)]
        z = feature_columns(df, self.features, self.vector_col, self.size)
        weight = F.col(q(self.weight)).cast("double") if self.weight else F.lit(1.0)
        rows = (df.select(F.coalesce(F.col(q(self.key)).cast("string"), F.lit("")).alias("key"), weight.alias("w"),
                          *[c.alias(n) for c, n in zip(z, zcols, strict=True)])
                .where(F.col("w") > 0).dropna(subset=zcols).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            seeds = self._seeds(rows, zcols)
            return self._lloyd(rows, zcols, seeds)
        finally:
            rows.unpersist()

    def _pass(self, rows: DataFrame, zcols: list[str], sets: list[np.ndarray]) -> list[np.ndarray]:
        """Sums of every center set in one job."""
        bc = share(rows.sparkSession, sets)
        schema = ", ".join(["part long", "c long", "w double", "cost double", *(f"{c} double" for c in zcols)])
        names = ["w", "cost", *zcols]
        found = (rows.select("w", *zcols).mapInArrow(_sums(bc, zcols), schema).groupBy("part", "c")
                 .agg(*[F.sum(n).alias(n) for n in names]).collect())
        if hasattr(bc, "unpersist"):
            bc.unpersist()
        out = [np.zeros((len(c), len(names))) for c in sets]
        for r in found:
            out[r["part"]][r["c"]] = [r[n] for n in names]
        return out

    def _seeds(self, rows: DataFrame, zcols: list[str]) -> np.ndarray:
        order = lambda e: place(F.col("key"), self.seed, e)
        first = rows.orderBy(order(-1), "key", *zcols).limit(1).collect()
        if not first:
            raise InsufficientDataError("k-means needs at least one row with all features")
        found = np.array([[r[c] for c in zcols] for r in first])
        for e in range(self.rounds):
            cost = self._pass(rows, zcols, [found])[0][:, 1].sum()
            if cost <= 0:
                break
            bc = share(rows.sparkSession, found)
            schema = ", ".join(["key string", *(f"{c} double" for c in zcols)])
            # about oversampling * max(ks) rows: the probabilities add up to that at most
            more = (rows.withColumn("place", order(e)).select("key", "w", "place", *zcols)
                    .mapInArrow(_sample(bc, zcols, self.oversampling * self.ks[-1] / cost), schema).collect())
            if more:
                more = sorted(more, key=lambda r: (r["key"], *[r[c] for c in zcols]))
                found = np.vstack([found, [[r[c] for c in zcols] for r in more]])
        weight = self._pass(rows, zcols, [found])[0][:, 0]
        picked = [int(weight.argmax())]
        near = squared_distances(found, found[picked])[:, 0]
        while len(picked) < self.ks[-1]:
            gain = weight * near
            best = int(gain.argmax())
            if not gain[best] > 0:
                break
            picked.append(best)
            near = np.minimum(near, squared_distances(found, found[[best]])[:, 0])
        return found[picked]

    def _lloyd(self, rows: DataFrame, zcols: list[str], seeds: np.ndarray) -> "KMeansModel":
        centers = {k: seeds[:k].copy() for k in self.ks}
        for _ in range(self.iterations):
            sums = self._pass(rows, zcols, list(centers.values()))
            moved = {}
            for (k, c), s in zip(centers.items(), sums, strict=True):
                new = c.copy()
                some = s[:, 0] > 0
                new[some] = s[some, 2:] / s[some, :1]
                moved[k] = new
            same = all(np.array_equal(moved[k], centers[k]) for k in centers)
            centers = moved
            if same:
                break
        sums = self._pass(rows, zcols, list(centers.values()))
        inertia = {k: float(s[:, 1].sum()) for k, s in zip(centers, sums, strict=True)}
        return KMeansModel(centers, inertia, self.features, self.vector_col)


class KMeansModel(Model):
    """``centers`` and ``inertia`` (weighted squared distance) by number of clusters."""

    def __init__(self, centers: dict[int, np.ndarray], inertia: dict[int, float],
                 features: list[str] | None, vector_col: str | None):
        self.centers, self.inertia, self.features, self.vector_col = centers, inertia, features, vector_col
        self.params = {f"k={k}": {"inertia": v} for k, v in inertia.items()}

    def _cluster(self, df: DataFrame, k: int) -> Column:
        ship_package(df.sparkSession)
        c = self.centers[k]
        z = feature_columns(df, self.features, self.vector_col, c.shape[1])
        return score_udf(share(df.sparkSession, c), second=False)(*z)

    def transform(self, df: DataFrame, k: int | None = None, out: str = "segment") -> DataFrame:
        """Append the nearest cluster of every row, for the smallest fitted k by default."""
        k = min(self.centers) if k is None else k
        if k not in self.centers:
            raise TransformerError(f"k={k} was not fitted")
        return (df.withColumn("__near", self._cluster(df, k))
                .withColumn(out, F.col("__near.k").cast("int")).drop("__near"))

    def elbow(self, df: DataFrame) -> DataFrame:
        """(k, inertia), a row for each fitted k."""
        return df.sparkSession.createDataFrame(sorted(self.inertia.items()), "k int, inertia double")
