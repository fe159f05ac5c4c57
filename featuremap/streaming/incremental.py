"""Fits kept up to date by a stream.

:class:`IncrementalFit` is a ``foreachBatch`` function.  Its state is mergeable: per
numeric column (values, nulls, mean, sum of squared deviations, min, max), and for
categorical columns a table of (column, value, rows).  Every micro-batch merges its own
part into the state of the batch before it, so the models after k batches are those of
a fit on all rows so far.

The state lives in two slots below ``path`` (shared storage), used in turn.  A batch
only overwrites the slot of the batch before the last one, so a batch that is tried
again finds the state it started from, and gives the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PipelineError, TransformerError
from ..functions.columns import as_double, q
from ..operators.encode import LabelEncoder, LabelModel
from ..operators.prep import FillModel
from ..operators.scale import LogModel, MinMaxModel, ZScoreModel

_MOMENTS = "batch long, rows long, column string, n long, mean double, m2 double, lo double, hi double"
_COUNTS = "col string, value string, n long"


def _merge(a, b):
    """Moments (n, mean, m2, lo, hi) of both parts together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, d = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n, min(a[3], b[3]), max(a[4], b[4]))


class IncrementalFit:
    """``stream.writeStream.foreachBatch(fit.update)``; then ``fit.minmax(spark)`` and the
    other models, at any time."""

    def __init__(self, path: str, numeric: list[str] = (), categorical: list[str] = ()):
        if not numeric and not categorical:
            raise TransformerError("name numeric or categorical columns")
        self.path, self.numeric, self.categorical = path.rstrip("/"), list(numeric), list(categorical)

    def _slot(self, batch: int, what: str) -> str:
        return f"{self.path}/{what}-{batch % 2}"

    # ------------------------------------------------------------------ update
    def update(self, df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        rows, before = 0, {}
        if batch > 0:
            kept = self._read(spark, batch - 1)
            if not kept:
                raise PipelineError(f"no state of batch {batch - 1} below {self.path}")
            rows, before = kept
        df = df.persist()
        try:
            if self.categorical:
                self._write_counts(df, batch)
            aggs = [F.count(F.lit(1)).alias("rows")]
            for i, c in enumerate(self.numeric):
                x = as_double(df, c)
                aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}"),
                         F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
            r = df.agg(*aggs).first()
        finally:
            df.unpersist()
        state = []
        for i, c in enumerate(self.numeric):
            n = r[f"n{i}"]
            part = (n, r[f"a{i}"], r[f"v{i}"] * n if n else None, r[f"l{i}"], r[f"h{i}"])
            state.append((batch, rows + r["rows"], c, *_merge(before.get(c, (0,) * 5), part)))
        # written last: a slot counts once its moments are there
        (spark.createDataFrame(state or [(batch, rows + r["rows"], None, 0, None, None, None, None)], _MOMENTS)
         .coalesce(1).write.mode("overwrite").parquet(self._slot(batch, "moments")))

    def _write_counts(self, df: DataFrame, batch: int) -> None:
        items = [F.struct(F.lit(c).alias("col"), F.col(q(c)).cast("string").alias("value"),
                          F.lit(1).cast("long").alias("n")) for c in self.categorical]
        found = df.select(F.inline(F.array(*items))).where(F.col("value").isNotNull())
        if batch > 0:
            found = found.union(df.sparkSession.read.schema(_COUNTS).parquet(self._slot(batch - 1, "counts")))
        (found.groupBy("col", "value").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(self._slot(batch, "counts")))

    # ------------------------------------------------------------------ state
    def _read(self, spark: SparkSession, batch: int):
        try:
            found = spark.read.schema(_MOMENTS).parquet(self._slot(batch, "moments")).where(
                F.col("batch") == batch).collect()          # a row a column
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        if not found:
            return None
        return found[0]["rows"], {r["column"]: (r["n"], r["mean"], r["m2"], r["lo"], r["hi"])
                                  for r in found if r["column"] is not None}

    def last_batch(self, spark: SparkSession) -> int:
        """The number of the last batch whose state is complete."""
        seen = []
        for slot in (0, 1):
            try:
                r = spark.read.schema(_MOMENTS).parquet(self._slot(slot, "moments")).agg(F.max("batch")).first()
                seen += [r[0]] if r[0] is not None else []
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        if not seen:
            raise PipelineError(f"no state below {self.path}")
        return max(seen)

    def moments(self, spark: SparkSession) -> dict[str, dict]:
        """n, mean, std (sample), min, max by numeric column."""
        _, state = self._read(spark, self.last_batch(spark))
        return {c: {"n": n, "mean": mean, "min": lo, "max": hi,
                    "std": math.sqrt(m2 / (n - 1)) if n > 1 else None}
                for c, (n, mean, m2, lo, hi) in state.items()}

    def counts(self, spark: SparkSession) -> DataFrame:
        """(col, value, n) of the categorical columns."""
        return spark.read.schema(_COUNTS).parquet(self._slot(self.last_batch(spark), "counts"))

    # ------------------------------------------------------------------ models
    def minmax(self, spark: SparkSession, epsilon: float = 0.0) -> MinMaxModel:
        return MinMaxModel({c: {"min": m["min"], "max": m["max"]} for c, m in self._seen(spark)}, epsilon)

    def zscore(self, spark: SparkSession) -> ZScoreModel:
        return ZScoreModel({c: {"mean": m["mean"], "std": m["std"]} for c, m in self._seen(spark)})

    def log(self, spark: SparkSession, base: str = "natural") -> LogModel:
        shift = lambda lo: None if lo is None else abs(lo) + 1.0 if lo <= 0 else 0.0
        return LogModel({c: {"min": m["min"], "shift": shift(m["min"])} for c, m in self._seen(spark)}, base)

    def labels(self, spark: SparkSession, handle_unknown: str = "error") -> LabelModel:
        return LabelEncoder(self.categorical, handle_unknown=handle_unknown).fit_values(
            self.counts(spark).select("col", "value"), self.categorical)

    def modes(self, spark: SparkSession) -> FillModel:
        best = (self.counts(spark).groupBy("col")
                .agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b")).collect())
        return FillModel({r["col"]: r["b"]["value"] for r in best}, nan_too=False)

    def _seen(self, spark: SparkSession):
        return self.moments(spark).items()

    def run_available(self, stream: DataFrame, checkpoint: str) -> None:
        """Take in everything available now and stop."""
        query = (stream.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:   # pragma: no cover
            raise query.exception()

    def table(self, spark: SparkSession) -> DataFrame:
        """The numeric state as rows (column, n, mean, std, min, max)."""
        fields = [T.StructField("column", T.StringType()), T.StructField("n", T.LongType()),
                  *(T.StructField(k, T.DoubleType()) for k in ("mean", "std", "min", "max"))]
        return spark.createDataFrame([(c, m["n"], m["mean"], m["std"], m["min"], m["max"])
                                      for c, m in self._seen(spark)], T.StructType(fields))
