"""Power transforms N5 (Yeo-Johnson) and N6 (Box-Cox), standardized.

The exponent lambda of every column maximises the profile log-likelihood

    yeo-johnson: -n/2 ln var_pop(psi(x, l)) + (l - 1) sum sign(x) ln(1 + |x|)
    box-cox:     -n/2 ln var_pop(psi(x, l)) + (l - 1) sum ln x

(up to a constant: it is evaluated relative to the middle candidate),

found by a distributed grid search: plain aggregates evaluate ``candidates``
values of lambda of every column, the range widens while the best one lies on
its edge, and ``rounds`` rounds narrow it.  Variances are taken in the log
domain, so data far from 0 keeps its digits.  The output is then standardized
with the mean and population std of the transformed column (one more
aggregate).  A constant column becomes 0.0; NULLs are ignored and kept.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TransformerError
from ..functions.columns import as_double, numeric_columns, q, resolve_columns
from .base import Estimator, Model, literal, require_rows


def yeo_johnson(x: Column, lam) -> Column:
    """psi(x, lambda); ``lam`` is a number or a column."""
    one = F.lit(1.0)
    if isinstance(lam, Column):
        pos = F.when(lam == 0, F.ln(x + one)).otherwise((F.pow(x + one, lam) - one) / lam)
        two = F.lit(2.0) - lam
        neg = F.when(lam == 2, -F.ln(one - x)).otherwise(-(F.pow(one - x, two) - one) / two)
        return F.when(x >= 0, pos).otherwise(neg)
    if lam == 0.0:
        pos = F.ln(x + one)
    else:
        pos = (F.pow(x + one, F.lit(lam)) - one) / F.lit(lam)
    if lam == 2.0:
        neg = -F.ln(one - x)
    else:
        neg = -(F.pow(one - x, F.lit(2.0 - lam)) - one) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def box_cox(x: Column, lam) -> Column:
    if isinstance(lam, Column):
        return F.when(lam == 0, F.ln(x)).otherwise((F.pow(x, lam) - F.lit(1.0)) / lam)
    if lam == 0.0:
        return F.ln(x)
    return (F.pow(x, F.lit(lam)) - F.lit(1.0)) / F.lit(lam)


def _log(v) -> float | None:
    """ln of a positive finite variance, else None."""
    return math.log(v) if v is not None and 0 < v < math.inf else None


def _vertex(lams: list[float], f: list[float], g: int, step: float) -> float:
    if g == 0 or g == len(lams) - 1 or -math.inf in (f[g - 1], f[g + 1]):
        return lams[g]
    curv = 2.0 * (f[g - 1] - 2.0 * f[g] + f[g + 1])
    if not curv < 0:
        return lams[g]
    return lams[g] + step * (f[g - 1] - f[g + 1]) / curv


def grid(lo: float, hi: float, candidates: int) -> tuple[list[float], float]:
    step = (hi - lo) / (candidates - 1)
    return [lo + i * step for i in range(candidates)], step


AGGREGATES = 50         # variances in one job: wider aggregates leave generated code


class PowerTransformer(Estimator):
    """``lambda_range`` is where the search starts: while the best candidate lies on
    an edge, the range moves on beyond it and doubles, until the likelihood falls on
    both sides or has no finite value further out."""

    def __init__(self, columns=None, method: str = "yeo-johnson", standardize: bool = True,
                 lambda_range=(-4.0, 4.0), candidates: int = 25, rounds: int = 5):
        if method not in ("yeo-johnson", "box-cox"):
            raise TransformerError(f"unknown power method {method!r}")
        self.columns, self.method, self.standardize = columns, method, standardize
        self.lambda_range, self.candidates, self.rounds = lambda_range, candidates, rounds

    def _log_variances(self, xs: DataFrame, want: list[tuple[str, float]], side: dict) -> dict:
        """``ln var_pop(psi(x, lambda))`` for (column, lambda) pairs: plain aggregates
        over the prepared columns, ``AGGREGATES`` a job."""
        out = {}
        for at in range(0, len(want), AGGREGATES):
            part = want[at:at + AGGREGATES]
            row = xs.agg(*[F.var_pop(side[c].shape(lam)).alias(f"v{i}")
                           for i, (c, lam) in enumerate(part)]).first()
            for i, (c, lam) in enumerate(part):
                v = _log(row[f"v{i}"])
                out[c, lam] = -math.inf if v is None else side[c].log_variance(v, lam)
        return {k: (None if v == -math.inf else v) for k, v in out.items()}

    def fit(self, df: DataFrame) -> "PowerModel":
        cols = resolve_columns(df, self.columns, numeric_columns)
        names = {c: f"__x{i}" for i, c in enumerate(cols)}
        xs = df.select(*[as_double(df, c).alias(names[c]) for c in cols],
                       F.lit(1).alias("__one")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit(xs, cols, names)
        finally:
            xs.unpersist()

    def _fit(self, xs: DataFrame, cols: list[str], names: dict) -> "PowerModel":
        # one pass: size, range, the lambda-free part of the likelihood, and the mean log
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, c in enumerate(cols):
            x = F.col(names[c])
            extra = (F.signum(x) * F.log1p(F.abs(x)) if self.method == "yeo-johnson" else F.ln(x))
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                     F.sum(extra).alias(f"s{i}")]
        row = xs.agg(*aggs).first()
        require_rows(row["__n"], "PowerTransformer")
        params: dict[str, dict] = {}
        side: dict[str, _Side] = {}
        for i, c in enumerate(cols):
            n, mn, mx = row[f"n{i}"], row[f"mn{i}"], row[f"mx{i}"]
            if self.method == "box-cox" and mn is not None and mn <= 0:
                raise TransformerError(f"box-cox needs strictly positive data; '{c}' has min {mn}")
            if n == 0 or mn == mx:
                params[c] = {"lambda": None, "mean": None, "std": None}
            else:
                params[c] = {"n": float(n), "s": row[f"s{i}"]}
                side[c] = _Side(self.method, F.col(names[c]), mn, mx, row[f"s{i}"] / n)
        ranges = {c: tuple(map(float, self.lambda_range)) for c in side}
        left = dict.fromkeys(side, self.rounds)
        while any(left.values()):
            todo = [c for c in side if left[c]]
            cands = {c: grid(*ranges[c], self.candidates) for c in todo}
            var = self._log_variances(xs, [(c, lam) for c in todo for lam in cands[c][0]], side)
            for c in todo:
                lams, step = cands[c]
                n, s = params[c]["n"], params[c]["s"]
                # relative to the middle candidate: the large common part cancels
                # exactly, so neighbouring candidates compare at full precision
                mid = lams[len(lams) // 2]
                base = var[c, mid]
                if base is None:
                    base, mid = 0.0, 1.0
                f = [-math.inf if var[c, lam] is None else -n / 2.0 * (var[c, lam] - base) + (lam - mid) * s
                     for lam in lams]
                g = max(range(len(lams)), key=lambda j: (f[j], -j))
                if f[g] == -math.inf:
                    raise TransformerError(f"no finite likelihood for '{c}'")
                width = ranges[c][1] - ranges[c][0]
                if left[c] == self.rounds and g in (0, len(lams) - 1) and abs(lams[g]) < 1e12:
                    lo = lams[g] - step if g else lams[g] + step - 2 * width
                    ranges[c] = (lo, lo + 2 * width)
                    continue
                params[c]["lambda"] = _vertex(lams, f, g, step)
                ranges[c] = (lams[g] - step, lams[g] + step)
                left[c] -= 1
        # the last grid is refined by the vertex of the parabola through the best
        # candidate and its neighbours, so lambda varies smoothly with the likelihood
        for c, part in side.items():
            params[c] = {"lambda": params[c]["lambda"], "side": part.sign, "center": part.center}
        if side:
            # standardization statistics at the chosen lambda
            aggs = []
            for i, c in enumerate(side):
                t = side[c].shape(params[c]["lambda"])
                aggs += [F.avg(t).alias(f"m{i}"), F.stddev_pop(t).alias(f"d{i}")]
            srow = xs.agg(*aggs).first()
            for i, c in enumerate(side):
                params[c] |= {"mean": srow[f"m{i}"], "std": srow[f"d{i}"]}
        return PowerModel(params, self.method, self.standardize)


class _Side:
    """How psi is evaluated for one column.

    Data on one side of 0 (for Box-Cox always) gives psi = a + b * E with
    E = expm1(p * (u - mean u)), u = ln(1 + |x|) or ln x and p the exponent of that
    side.  E keeps its digits where psi loses all of them (x far from 0), and
    ln var psi = ln var E + 2 p mean(u) - 2 ln |p|.  Data on both sides uses psi
    itself, with expm1 in place of a power minus one.
    """

    def __init__(self, method: str, x: Column, low: float, high: float, mean: float, sign=None):
        self.method, self.x = method, x
        self.sign = sign if sign is not None else (
            1 if method == "box-cox" or low >= 0 else -1 if high <= 0 else 0)
        self.center = abs(mean) if method == "yeo-johnson" else mean
        if self.sign == 0:
            self.center = 0.0

    def _exponent(self, lam: float) -> float:
        return lam if self.sign >= 0 else 2.0 - lam

    def shape(self, lam: float) -> Column:
        """An increasing affine image of psi(x, lam) (psi itself on both sides of 0)."""
        if self.sign == 0:
            return F.when(self.x >= 0, _expm1(F.log1p(self.x), lam)).otherwise(
                -_expm1(F.log1p(-self.x), 2.0 - lam))
        u = F.ln(self.x) if self.method == "box-cox" else F.log1p(F.abs(self.x))
        return F.lit(float(self.sign)) * _expm1(u - F.lit(self.center), self._exponent(lam))

    def log_variance(self, v: float, lam: float) -> float:
        return v if self.sign == 0 else v + 2.0 * self._exponent(lam) * self.center


def _expm1(u: Column, p: float) -> Column:
    """(exp(p u) - 1) / p, and u for p = 0."""
    return u if p == 0.0 else F.expm1(F.lit(p) * u) / F.lit(p)


class PowerModel(Model):
    def __init__(self, params, method, standardize):
        self.params, self.method, self.standardize = params, method, standardize

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, p in self.params.items():
            if c not in df.columns:
                continue
            x = F.col(q(c)).cast("double")
            if p["lambda"] is None:
                exprs[c] = F.when(x.isNotNull(), F.lit(0.0))
                continue
            psi = yeo_johnson(x, p["lambda"]) if self.method == "yeo-johnson" else box_cox(x, p["lambda"])
            if not self.standardize:
                exprs[c] = psi
                continue
            side = _Side(self.method, x, 0, 0, 0, sign=p["side"])
            side.center = p["center"]
            # new data on the other side of 0 than all of the fitted data
            other = (x < 0) if p["side"] > 0 and self.method == "yeo-johnson" else (x > 0) if p["side"] < 0 else None
            t = side.shape(p["lambda"])
            if other is not None:
                e = side._exponent(p["lambda"])
                affine = (psi - F.lit(float(p["side"])) * _constant(e, p["center"])) * F.lit(math.exp(-max(min(e * p["center"], 700), -700)))
                t = F.when(other, affine).otherwise(t)
            t = F.lit(0.0) if not p["std"] else (t - literal(p["mean"])) / literal(p["std"])
            exprs[c] = F.when(x.isNotNull(), t)
        return df.withColumns(exprs)


def _constant(p: float, center: float) -> Column:
    """psi where u is the center."""
    return F.lit(center if p == 0.0 else math.expm1(max(min(p * center, 700), -700)) / p)
