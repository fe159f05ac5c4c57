"""Estimator / Model contract for every fitted stage.

``Estimator.fit(df)`` runs the distributed aggregate(s) and returns a ``Model``
holding only small parameters (a few numbers per column, or a mapping
DataFrame).  ``Model.transform(df)`` is lazy: a projection with literals or a
join.  Any ``pyspark.ml`` stage can be used wherever a stage is accepted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformerError


class Model:
    """A fitted, lazy transformation."""

    #: per-column parameters, e.g. ``{"a": {"min": 0.0, "max": 1.0}}``
    params: dict[str, dict[str, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def get_params(self, spark: SparkSession) -> DataFrame:
        """Fitted parameters as a long table ``(column, parameter, value)``."""
        rows = [(c, k, None if v is None else float(v))
                for c, ps in self.params.items() for k, v in ps.items()
                if v is None or isinstance(v, (int, float))]
        schema = T.StructType([
            T.StructField("column", T.StringType()),
            T.StructField("parameter", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ])
        return spark.createDataFrame(rows, schema)


class Estimator:
    """Something that learns a ``Model`` from a DataFrame."""

    def fit(self, df: DataFrame) -> Model:  # pragma: no cover
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class FunctionStage(Model):
    """Wrap a plain ``DataFrame -> DataFrame`` function as a stage."""

    def __init__(self, fn, name: str | None = None):
        self.fn = fn
        self.name = name or getattr(fn, "__name__", "function")
        self.params = {}

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fn(df)

    def fit(self, df: DataFrame) -> "FunctionStage":
        return self


class IdentityStage(FunctionStage):
    """Returns its input unchanged."""

    def __init__(self):
        super().__init__(lambda df: df, "identity")


def require_rows(n: int, what: str) -> None:
    """Empty input cannot be fitted (decision D11)."""
    if n == 0:
        raise TransformerError(f"{what}: cannot fit on empty input")


def literal(v: float | None):
    return F.lit(v).cast("double")
