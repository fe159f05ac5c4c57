"""Numeric normalizers N1-N4, N7, N8 and X15.

Fit = one aggregate job over all selected columns (never one per column);
apply = one projection with the fitted numbers as literals, so a chain of
scalers collapses into a single ``Project`` inside whole-stage codegen.
Columns not selected pass through untouched and column order is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TransformerError
from ..functions.columns import as_double, numeric_columns, q, resolve_columns
from ..functions.quantiles import exact_quantiles
from .base import Estimator, Model, literal, require_rows

_ALL = "__all__"


def _stacked(df: DataFrame, cols: list[str]) -> DataFrame:
    """All selected columns as one column ``__all__`` (whole-table mode, N8)."""
    return df.select(F.explode(F.array(*[as_double(df, c) for c in cols])).alias(_ALL))


class _Scaler(Estimator):
    """Shared column selection, empty-input check and whole-table mode."""

    def __init__(self, columns=None, whole_table: bool = False, strict: bool = False):
        self.columns = columns
        self.whole_table = whole_table
        self.strict = strict

    def _columns(self, df: DataFrame) -> list[str]:
        return resolve_columns(df, self.columns, numeric_columns, self.strict)

    def fit(self, df: DataFrame) -> Model:
        cols = self._columns(df)
        if self.whole_table and cols:
            stats = self._stats(_stacked(df, cols), [_ALL])
            params = {c: dict(stats[_ALL]) for c in cols}
        else:
            params = self._stats(df, cols)
        return self._model(params)

    # subclasses: one job returning {column: {name: value}}
    def _stats(self, df: DataFrame, cols: list[str]) -> dict:
        raise NotImplementedError

    def _model(self, params: dict) -> Model:
        raise NotImplementedError


class _ColumnwiseModel(Model):
    def __init__(self, params: dict):
        self.params = params

    def expr(self, c: Column, p: dict) -> Column:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.params if c in df.columns]
        return df.withColumns({c: self.expr(F.col(q(c)).cast("double"), self.params[c])
                               for c in present})


def _agg_row(df: DataFrame, aggs: list[Column], what: str):
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs).first()
    require_rows(row["__n"], what)
    return row


# ---------------------------------------------------------------- N1 / X15
class MinMaxScaler(_Scaler):
    """``(x - min) / (max - min [+ epsilon])``; a constant column becomes 0.0."""

    def __init__(self, columns=None, epsilon: float = 0.0, **kw):
        super().__init__(columns, **kw)
        self.epsilon = epsilon

    def _stats(self, df, cols):
        aggs = []
        for i, c in enumerate(cols):
            x = as_double(df, c)
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
        row = _agg_row(df, aggs, "MinMaxScaler")
        return {c: {"min": row[f"mn{i}"], "max": row[f"mx{i}"]} for i, c in enumerate(cols)}

    def _model(self, params):
        return MinMaxModel(params, self.epsilon)


class MinMaxModel(_ColumnwiseModel):
    def __init__(self, params, epsilon: float = 0.0):
        super().__init__(params)
        self.epsilon = epsilon

    def expr(self, c, p):
        lo, hi = p["min"], p["max"]
        if lo is None:
            return literal(None)
        if self.epsilon:
            return (c - literal(lo)) / literal(hi - lo + self.epsilon)
        if hi == lo:
            return F.lit(0.0)
        return (c - literal(lo)) / literal(hi - lo)


# ---------------------------------------------------------------- N2
class ZScoreScaler(_Scaler):
    """``(x - mean) / std`` with the sample std; std 0 -> 0.0, one row -> NULL."""

    def _stats(self, df, cols):
        aggs = []
        for i, c in enumerate(cols):
            x = as_double(df, c)
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
        row = _agg_row(df, aggs, "ZScoreScaler")
        return {c: {"mean": row[f"m{i}"], "std": row[f"s{i}"]} for i, c in enumerate(cols)}

    def _model(self, params):
        return ZScoreModel(params)


class ZScoreModel(_ColumnwiseModel):
    def expr(self, c, p):
        m, s = p["mean"], p["std"]
        if m is None or s is None or (isinstance(s, float) and math.isnan(s)):
            return literal(None)
        if s == 0:
            return F.lit(0.0)
        return (c - literal(m)) / literal(s)


# ---------------------------------------------------------------- N3 / N3b
class RobustScaler(_Scaler):
    """``(x - median) / (q_hi - q_lo)``; zero spread -> 0.0.

    Quantiles are exact (linear interpolation) unless ``exact=False``.
    """

    def __init__(self, columns=None, quantile_range=(25.0, 75.0), exact: bool = True,
                 accuracy: int = 10_000, **kw):
        super().__init__(columns, **kw)
        lo, hi = quantile_range
        if not 0 <= lo < hi <= 100:
            raise TransformerError(f"invalid quantile_range {quantile_range}")
        self.quantile_range = (float(lo), float(hi))
        self.exact = exact
        self.accuracy = accuracy

    def _stats(self, df, cols):
        p_lo, p_hi = self.quantile_range[0] / 100.0, self.quantile_range[1] / 100.0
        seen: dict = {}
        qs = exact_quantiles(df, cols, [0.5, p_lo, p_hi], exact=self.exact,
                             accuracy=self.accuracy, stats=seen)
        require_rows(seen["rows"], "RobustScaler")
        self.n_rows = seen["rows"]
        return {c: {"median": qs[(c, 0.5)], "q1": qs[(c, p_lo)], "q3": qs[(c, p_hi)]}
                for c in cols}

    def _model(self, params):
        return RobustModel(params)


class RobustModel(_ColumnwiseModel):
    def expr(self, c, p):
        med, q1, q3 = p["median"], p["q1"], p["q3"]
        if med is None:
            return literal(None)
        iqr = q3 - q1
        if iqr == 0:
            return F.lit(0.0)
        return (c - literal(med)) / literal(iqr)


# ---------------------------------------------------------------- N4 / N4b
_LOG_BASES = {"natural": F.ln, "10": F.log10, "base2": F.log2, "2": F.log2}


class LogTransformer(_Scaler):
    """``log(x + shift)``, ``shift = |min| + 1`` when ``min <= 0`` else 0.

    ``base`` is ``"natural"``, ``"10"`` or ``"base2"``.  Values that are still
    non-positive after the shift give ``-inf`` (zero) or NaN (negative), as
    the numpy logarithm does.
    """

    def __init__(self, columns=None, base: str = "natural", **kw):
        super().__init__(columns, **kw)
        if base not in _LOG_BASES:
            raise TransformerError(f"unknown log base {base!r}")
        self.base = base

    def _stats(self, df, cols):
        aggs = [F.min(as_double(df, c)).alias(f"mn{i}") for i, c in enumerate(cols)]
        row = _agg_row(df, aggs, "LogTransformer")
        out = {}
        for i, c in enumerate(cols):
            mn = row[f"mn{i}"]
            shift = None if mn is None else (abs(mn) + 1.0 if mn <= 0 else 0.0)
            out[c] = {"min": mn, "shift": shift}
        return out

    def _model(self, params):
        return LogModel(params, self.base)


class LogModel(_ColumnwiseModel):
    def __init__(self, params, base="natural"):
        super().__init__(params)
        self.base = base

    def expr(self, c, p):
        if p["shift"] is None:
            return literal(None)
        v = c + literal(p["shift"]) if p["shift"] else c
        return (F.when(v > 0, _LOG_BASES[self.base](v))
                .when(v == 0, F.lit(float("-inf")))
                .when(v < 0, F.lit(float("nan"))))
