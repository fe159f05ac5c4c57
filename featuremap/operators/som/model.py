"""Fitted map (M7-M14, M19, M20, M23, M29, M31): scaling bounds + codebook.

Scoring appends ``neuron_x, neuron_y`` (and optionally the distance and the
second-best unit) to the input rows.  Only the feature columns cross into
Python, as Arrow batches; the codebook (at most a few thousand neurons) is
shipped once per executor as a broadcast variable.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...errors import DimensionMismatchError, SOMError
from ...functions.columns import q
from ...session import ship_package
from ..base import Model
from .config import SOMConfig
from .kernel import best_units


def feature_columns(df: DataFrame, features: list[str] | None, vector_col: str | None,
                    d: int) -> list[Column]:
    """Feature expressions as doubles, NaN -> NULL."""
    if vector_col:
        v = F.col(q(vector_col))
        wrong = F.raise_error(F.concat(F.lit(f"'{vector_col}' needs {d} elements, got "),
                                       F.size(v).cast("string"))).cast("double")
        cols = [F.when(v.isNull() | (F.size(v) == d), F.get(v, F.lit(i)).cast("double")).otherwise(wrong)
                for i in range(d)]
    else:
        cols = [F.col(q(c)).cast("double") for c in features]
    return [F.nanvl(c, F.lit(None).cast("double")) for c in cols]


def share(spark: SparkSession, value):
    """Broadcast variable when a SparkContext is reachable, else the value itself."""
    try:
        return spark.sparkContext.broadcast(value)
    except Exception:  # pragma: no cover - e.g. Spark Connect
        class _Local:
            def __init__(self, v):
                self.value = v
        return _Local(value)


_SCORE = T.StructType([
    T.StructField("k", T.IntegerType()),
    T.StructField("dist", T.DoubleType()),
    T.StructField("k2", T.IntegerType()),
])


def score_udf(codebook_bc, second: bool):
    """Arrow UDF: scaled feature columns -> struct(k, dist, k2).

    Arrow-native where the running Spark offers ``arrow_udf`` (no pandas
    conversion of the batches), else an Arrow-batched pandas UDF.
    """
    if hasattr(F, "arrow_udf"):
        return _arrow_score_udf(codebook_bc, second)

    def score(*cols: pd.Series) -> pd.DataFrame:
        z = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols])
        b1, d1, b2 = best_units(z, codebook_bc.value, second=second)
        return pd.DataFrame({
            "k": pd.arrays.IntegerArray(b1.astype(np.int32), b1 < 0),
            "dist": d1,
            "k2": pd.arrays.IntegerArray(b2.astype(np.int32), b2 < 0),
        })

    # not deterministic for the planner: a filter on the result must not be pushed
    # below the projection, where it would run the kernel a second time
    return F.pandas_udf(score, _SCORE).asNondeterministic()


def _arrow_score_udf(codebook_bc, second: bool):
    import pyarrow as pa
    import pyarrow.compute as pc

    def score(*cols):
        z = np.column_stack([pc.fill_null(c.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
                             for c in cols])
        b1, d1, b2 = best_units(z, codebook_bc.value, second=second)
        return pa.StructArray.from_arrays(
            [pa.array(b1.astype(np.int32), mask=b1 < 0), pa.array(d1, from_pandas=True),
             pa.array(b2.astype(np.int32), mask=b2 < 0)],
            names=["k", "dist", "k2"])

    return F.arrow_udf(score, _SCORE).asNondeterministic()


class SOMModel(Model):
    def __init__(self, config: SOMConfig, codebook: np.ndarray, mins: np.ndarray,
                 maxs: np.ndarray, features: list[str] | None, vector_col: str | None,
                 history: list[tuple] | None = None):
        self.config = config
        self.codebook = np.asarray(codebook, dtype=float)      # (K, d), row-major k = x*Y + y
        self.mins = np.asarray(mins, dtype=float)
        self.maxs = np.asarray(maxs, dtype=float)
        self.features = features
        self.vector_col = vector_col
        self.history = history or []
        self.d = self.codebook.shape[1]
        names = self.feature_names
        self.params = {n: {"min": float(a), "max": float(b)}
                       for n, a, b in zip(names, self.mins, self.maxs)}

    # ---------------------------------------------------------------- scaling (M7)
    @property
    def feature_names(self) -> list[str]:
        if self.vector_col:
            return [f"{self.vector_col}[{i}]" for i in range(self.d)]
        return list(self.features)

    @property
    def ranges(self) -> np.ndarray:
        r = self.maxs - self.mins
        return np.where(r == 0, 1.0, r)

    def scaled_columns(self, df: DataFrame) -> list[Column]:
        """Features scaled with the training bounds; no clipping of new data."""
        if not self.vector_col:
            missing = [c for c in self.features if c not in df.columns]
            if missing:
                raise DimensionMismatchError(f"feature columns missing: {missing}")
        raw = feature_columns(df, self.features, self.vector_col, self.d)
        return [(c - F.lit(float(lo))) / F.lit(float(r))
                for c, lo, r in zip(raw, self.mins, self.ranges)]

    # ---------------------------------------------------------------- scoring
    def _bmu(self, df: DataFrame, second: bool) -> Column:
        spark = df.sparkSession
        ship_package(spark)
        bc = share(spark, self.codebook)
        return score_udf(bc, second)(*self.scaled_columns(df))

    def transform(self, df: DataFrame, distance: bool = False, second: bool = False,
                  prefix: str = "neuron") -> DataFrame:
        """Append ``{prefix}_x, {prefix}_y`` [, ``distance``] [, second-best unit]."""
        Y = self.config.y
        tmp = "__bmu"
        out = df.withColumn(tmp, self._bmu(df, second))
        k = F.col(f"{tmp}.k")
        new = {f"{prefix}_x": (k / F.lit(Y)).cast("int"), f"{prefix}_y": (k % F.lit(Y)).cast("int")}
        if distance:
            new["distance"] = F.col(f"{tmp}.dist")
        if second:
            k2 = F.col(f"{tmp}.k2")
            new[f"{prefix}2_x"] = (k2 / F.lit(Y)).cast("int")
            new[f"{prefix}2_y"] = (k2 % F.lit(Y)).cast("int")
        return out.withColumns(new).drop(tmp)

    def predict(self, df: DataFrame) -> DataFrame:
        """``neuron_x, neuron_y, distance`` for every row."""
        return self.transform(df, distance=True)

    def score(self, df: DataFrame) -> DataFrame:
        """Everything the quality queries need: BMU, distance, second BMU."""
        return self.transform(df, distance=True, second=True)

    def node_data(self, df: DataFrame, x: int, y: int) -> DataFrame:
        """Rows whose best unit is ``(x, y)``."""
        s = self.transform(df)
        return s.where((F.col("neuron_x") == x) & (F.col("neuron_y") == y))

    # ---------------------------------------------------------------- codebook
    def codebook_df(self, spark: SparkSession, original_units: bool = False) -> DataFrame:
        """``neuron_x, neuron_y, weights array<double>``; K rows."""
        W = self.codebook * self.ranges + self.mins if original_units else self.codebook
        Y = self.config.y
        rows = [(int(k // Y), int(k % Y), [float(v) for v in W[k]]) for k in range(W.shape[0])]
        return spark.createDataFrame(rows, T.StructType([
            T.StructField("neuron_x", T.IntegerType()),
            T.StructField("neuron_y", T.IntegerType()),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]))

    def component_planes(self, spark: SparkSession, original_units: bool = False) -> DataFrame:
        """Long form ``neuron_x, neuron_y, feature, value``."""
        names = F.array(*[F.lit(n) for n in self.feature_names])
        return (self.codebook_df(spark, original_units)
                .select("neuron_x", "neuron_y", F.posexplode("weights").alias("i", "value"))
                .select("neuron_x", "neuron_y", F.element_at(names, F.col("i") + 1).alias("feature"),
                        "value"))

    def quantize(self, df: DataFrame) -> DataFrame:
        """Append ``quantized``: the codebook vector of each row's best unit.

        The codebook has ``x * y`` rows, a fixed bound, so it is broadcast.
        """
        cb = self.codebook_df(df.sparkSession).withColumnRenamed("weights", "quantized")
        return self.transform(df).join(F.broadcast(cb), ["neuron_x", "neuron_y"], "left")

    def distance_map(self, spark: SparkSession) -> DataFrame:
        """U-matrix over the 8-neighbourhood (M19): ``u_sum``, ``u_mean``
        (mean over existing neighbours) and ``u_scaled`` (sum / max sum)."""
        from .quality import umatrix
        return umatrix(self.codebook_df(spark))

    def history_df(self, spark: SparkSession) -> DataFrame:
        """``epoch, qe, sigma, learning_rate`` per training pass."""
        return spark.createDataFrame(
            [(int(e), float(q), float(s), float(lr)) for e, q, s, lr in self.history],
            "epoch int, qe double, sigma double, learning_rate double")

    # ---------------------------------------------------------------- persistence
    def save(self, path: str) -> None:
        """Parquet: ``{path}/codebook`` (K rows) and ``{path}/meta`` (one row)."""
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise SOMError("no active SparkSession")
        self.codebook_df(spark).write.mode("overwrite").parquet(f"{path}/codebook")
        meta = {"config": self.config.__dict__, "mins": self.mins.tolist(),
                "maxs": self.maxs.tolist(), "features": self.features,
                "vector_col": self.vector_col, "history": self.history}
        spark.createDataFrame([(json.dumps(meta),)], "meta string") \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SOMModel":
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        cfg = SOMConfig(**meta["config"])
        rows = spark.read.parquet(f"{path}/codebook").collect()   # K rows
        d = len(rows[0]["weights"])
        W = np.zeros((cfg.k, d))
        for r in rows:
            W[r["neuron_x"] * cfg.y + r["neuron_y"]] = r["weights"]
        return SOMModel(cfg, W, np.array(meta["mins"]), np.array(meta["maxs"]),
                        meta["features"], meta["vector_col"],
                        [tuple(h) for h in meta["history"]])
