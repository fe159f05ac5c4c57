"""Column preparation: id-like column drop (X3), median / mode imputation
(X5, X6), clipping (X7), CASE bands (X8), coordinate labels (X9), share of
total (X13), constant lookups (X14) and the automatic preparation (X16)."""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_double, non_numeric_columns, numeric_columns, q, resolve_columns
from ..functions.quantiles import exact_quantiles
from ..functions.statistics import code_quantiles, filled_quantiles, gather, weighted_quantiles
from .base import Estimator, Model, require_rows
from .encode import LabelEncoder, LabelModel
from .scale import RobustModel, RobustScaler

# Exact (case-insensitive) names dropped by the default id rule.
ID_LIKE_NAMES = ("name", "ticket", "cabin")


def is_id_like(name: str) -> bool:
    """Default rule: the name contains ``id`` or is one of ID_LIKE_NAMES."""
    low = name.lower()
    return "id" in low or low in ID_LIKE_NAMES


def drop_id_columns(df: DataFrame, rule: Callable[[str], bool] = is_id_like) -> DataFrame:
    return df.drop(*[c for c in df.columns if rule(c)])


def select_by_type(df: DataFrame, kind: str) -> DataFrame:
    """``numeric`` / ``categorical`` (non-numeric) column subset."""
    cols = numeric_columns(df) if kind == "numeric" else non_numeric_columns(df)
    return df.select(*map(q, cols))


# ---------------------------------------------------------------- X5
class MedianImputer(Estimator):
    """Fill NULL/NaN of numeric columns with the exact median of the column."""

    def __init__(self, columns=None, exact: bool = True):
        self.columns, self.exact = columns, exact

    def fit(self, df: DataFrame) -> "FillModel":
        cols = resolve_columns(df, self.columns, numeric_columns)
        qs = exact_quantiles(df, cols, [0.5], exact=self.exact)
        return FillModel({c: qs[(c, 0.5)] for c in cols}, nan_too=True)


# ---------------------------------------------------------------- X6
def column_modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent non-null value per column, ties to the smallest value: a
    string, or for columns of other types a typed literal column.

    One shuffle over ``(column, value)`` with map-side counting, then a second
    aggregate picking ``min(struct(-count, value))`` per column: no single
    task ever holds all distinct values of a column.
    """
    if not cols:
        return {}
    # values that are no scalars are counted as JSON text and read back from it
    nested = {c: df.schema[c].dataType for c in cols
              if isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))}
    text = lambda c: F.to_json(F.col(q(c))) if c in nested else F.col(q(c)).cast("string")
    items = [F.struct(F.lit(c).alias("col"), text(c).alias("value")) for c in cols]
    best = (df.select(F.inline(F.array(*items)))
            .where(F.col("value").isNotNull())
            .groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("col").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b"))
            .collect())
    out: dict[str, str | None] = {c: None for c in cols}
    for r in best:
        c, value = r["col"], r["b"]["value"]
        out[c] = F.from_json(F.lit(value), nested[c]) if c in nested else value
    return out


class ModeImputer(Estimator):
    """Fill NULL of (non-numeric) columns with the column's mode."""

    def __init__(self, columns=None):
        self.columns = columns

    def fit(self, df: DataFrame) -> "FillModel":
        cols = resolve_columns(df, self.columns, non_numeric_columns)
        return FillModel(column_modes(df, cols), nan_too=False)


class FillModel(Model):
    def __init__(self, values: dict, nan_too: bool):
        self.values, self.nan_too = values, nan_too
        self.params = {c: {"fill": None if isinstance(v, Column) else v} for c, v in values.items()}

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, v in self.values.items():
            if c not in df.columns or v is None:
                continue
            dt = df.schema[c].dataType
            if isinstance(v, Column):
                exprs[c] = F.coalesce(F.col(q(c)), v)
            elif isinstance(dt, (T.FloatType, T.DoubleType)) and self.nan_too:
                exprs[c] = F.coalesce(as_double(df, c), F.lit(v)).cast(dt)
            elif isinstance(v, float) and not v.is_integer():
                # a fractional median widens an integer column
                exprs[c] = F.coalesce(F.col(q(c)).cast("double"), F.lit(v))
            elif isinstance(v, float):
                # values that are there keep their own type and digits
                exprs[c] = F.coalesce(F.col(q(c)), F.lit(int(v)).cast(dt))
            else:
                exprs[c] = F.coalesce(F.col(q(c)), F.lit(v).cast(dt))
        return df.withColumns(exprs)


# ---------------------------------------------------------------- X7 / X8 / X9
def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to ``[lo, hi]``; NULL stays NULL (``greatest``/``least`` skip NULLs)."""
    c = F.col(c) if isinstance(c, str) else c
    v = c
    if lo is not None:
        v = F.greatest(F.lit(lo), v)
    if hi is not None:
        v = F.least(F.lit(hi), v)
    return F.when(c.isNull(), F.lit(None)).otherwise(v)


def bands(c: Column | str, edges: Sequence[tuple[float, str]], default: str) -> Column:
    """CASE bucketing: first ``(limit, label)`` with ``c < limit`` wins."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for lim, label in edges:
        out = (F.when(c < F.lit(lim), F.lit(label)) if out is None
               else out.when(c < F.lit(lim), F.lit(label)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def coord_label(x: Column | str, y: Column | str, sep: str = "-") -> Column:
    """``"x-y"`` label of a grid coordinate."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.concat_ws(sep, x.cast("string"), y.cast("string"))


# ---------------------------------------------------------------- X13 / X14
def with_share(df: DataFrame, count_col: str = "count", out: str = "percent",
               scale: float = 100.0) -> DataFrame:
    """Share of the total of ``count_col``: a one-row aggregate, joined by broadcast,
    so no task gathers the rows."""
    total = df.agg(F.sum(q(count_col)).alias("__total")).withColumn("__one", F.lit(1))
    return (df.withColumn("__one", F.lit(1)).join(F.broadcast(total), "__one")
            .withColumn(out, F.col(q(count_col)) * F.lit(scale) / F.col("__total"))
            .drop("__one", "__total"))


def attach_lookup(df: DataFrame, lookup: DataFrame, key: str,
                  defaults: dict[str, Column] | None = None) -> DataFrame:
    """Left join to a constant lookup table; missing keys get defaults.

    No broadcast hint: the lookup's size is not known here, so the planner
    (and AQE at run time) picks a broadcast only when the table is small.
    """
    out = df.join(lookup, key, "left")
    for c, d in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), d))
    return out


# ---------------------------------------------------------------- X16
class AutoPrep(Estimator):
    """Automatic preparation: drop id-like columns -> median / mode imputation ->
    label codes for non-numeric columns -> robust scaling of every column.

    Three passes over the rows: the numeric columns' sketches, the categorical columns'
    value counts, and the order statistics that medians and quartiles need.  Modes,
    label codes and the quartiles of codes come from the stored counts.  Columns of
    nested types go through the four fits one after another instead.
    """

    def __init__(self, rule: Callable[[str], bool] = is_id_like):
        self.rule = rule

    def fit(self, df: DataFrame) -> "AutoPrepModel":
        kept = [c for c in df.columns if not self.rule(c)]
        # every fit below is a job over the same rows: materialize the input
        # once (spilling to disk if needed) instead of recomputing its lineage
        base = df.select(*map(q, kept)).persist(StorageLevel.MEMORY_AND_DISK)
        nested = any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in base.schema.fields)
        try:
            return (self._staged if nested else self._fused)(base, kept)
        finally:
            base.unpersist()

    def _fused(self, base: DataFrame, kept: list[str]) -> "AutoPrepModel":
        num = numeric_columns(base)
        cat = [c for c in kept if c not in num]
        stats = gather(base, num, cat)
        require_rows(stats.rows, "AutoPrep")
        probs = [0.5, 0.25, 0.75]
        floats = {c for c in num if isinstance(base.schema[c].dataType, T.FloatType)}
        medians, quantiles = filled_quantiles(
            base, stats, probs, lambda c, v: struct.unpack("f", struct.pack("f", v))[0] if c in floats else v)
        params = {c: dict(zip(("median", "q1", "q3"), (quantiles[c, p] for p in probs), strict=True)) for c in num}
        med = FillModel(medians, nan_too=True) if num else None
        mode = label = None
        if cat:
            modes = dict.fromkeys(cat)
            missing = dict.fromkeys(cat, stats.rows)
            for r in stats.counts.groupBy("col").agg(      # a row a column
                    F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b"), F.sum("n").alias("n")).collect():
                modes[r["col"]], missing[r["col"]] = r["b"]["value"], stats.rows - r["n"]
            mode = FillModel(modes, nan_too=False)
            label = LabelEncoder(cat, handle_unknown="warn").fit_values(stats.counts.select("col", "value"), cat)
            params.update(self._code_params(stats.counts, label, modes, missing, probs))
        model = AutoPrepModel(kept, med, mode, label, RobustModel({c: params[c] for c in kept}))
        model.n_rows = stats.rows
        return model

    @staticmethod
    def _code_params(counts, label, modes, missing, probs) -> dict[str, dict]:
        """Quartiles of each column's label codes, its nulls filled with the mode.  Columns
        whose codes came to the driver (a bounded number of them) are read in one job."""
        out = {}
        small = {c: m.small for c, m in label.maps.items() if m.small is not None}
        weights: dict[str, dict[int, int]] = {c: {} for c in small}
        for r in counts.where(F.col("col").isin(list(small))).collect():
            weights[r["col"]][small[r["col"]][r["value"]]] = r["n"]
        for c, m in label.maps.items():
            if modes[c] is None:            # no value at all: every row gets the unknown code
                found = dict.fromkeys(probs, -1.0)
            elif c in small:
                weights[c][small[c][modes[c]]] += missing[c]
                found = weighted_quantiles(sorted(weights[c].items()), probs)
            else:
                n = F.col("n") + F.when(F.col("value") == modes[c], missing[c]).otherwise(0)
                mine = counts.where(F.col("col") == c).select("value", n.alias("n"))
                found = code_quantiles(m.lookup(mine, "code", F.col("value"), "c"), probs)
            out[c] = dict(zip(("median", "q1", "q3"), (float(found[p]) for p in probs), strict=True))
        return out

    def _staged(self, base: DataFrame, kept: list[str]) -> "AutoPrepModel":
        num = numeric_columns(base)
        cat = [c for c in kept if c not in num]
        med = MedianImputer(num).fit(base) if num else None
        mode = ModeImputer(cat).fit(base)
        filled = mode.transform(med.transform(base) if med else base)
        label = LabelEncoder(cat, handle_unknown="warn").fit(filled)
        scaler = RobustScaler(kept)
        # empty input is rejected here (one count in the first pass)
        robust = scaler.fit(label.transform(filled, report=False))
        model = AutoPrepModel(kept, med, mode, label, robust)
        model.n_rows = scaler.n_rows
        return model


class AutoPrepModel(Model):
    def __init__(self, features, med, mode, label, robust):
        self.features, self.med, self.mode, self.label, self.robust = (
            features, med, mode, label, robust)
        self.params = dict(robust.params)
        self.n_rows: int | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in (self.med, self.mode, self.label, self.robust):
            if isinstance(m, LabelModel):
                out = m.transform(out, report=False)     # -1 for new values, no extra pass
            elif m is not None:
                out = m.transform(out)
        return out

    def features_only(self, df: DataFrame) -> DataFrame:
        return self.transform(df.select(*map(q, self.features)))
