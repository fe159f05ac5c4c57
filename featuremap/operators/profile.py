"""Profiling (I1-I3): schema and size, a deterministic head, describe()."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_double, numeric_columns
from ..functions.quantiles import exact_quantiles


def inspect(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name, data_type, ordinal, n_rows, n_columns``.

    The row count is the only job; the rest is schema metadata.
    """
    n = df.count()
    rows = [(f.name, f.dataType.simpleString(), i + 1, n, len(df.columns))
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_columns", T.IntegerType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def head(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a defined order (all columns when none given)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def describe(df: DataFrame, columns: list[str] | None = None, decimals: int | None = None,
             exact: bool = True) -> DataFrame:
    """pandas-style describe: count, mean, std (sample), min, 25%, 50%, 75%, max.

    One aggregate for the moments plus the bracketing quantile passes; one
    output row per numeric column.
    """
    cols = columns or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = as_double(df, c)
        aggs += [F.count(x).alias(f"d_n{i}"), F.avg(x).alias(f"d_m{i}"),
                 F.stddev_samp(x).alias(f"d_s{i}"), F.min(x).alias(f"d_lo{i}"),
                 F.max(x).alias(f"d_hi{i}")]
    seen: dict = {}
    # the moments ride along in the first quantile pass: one scan for both
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75], exact=exact, stats=seen, extra=aggs)
    row = seen.get("extra")

    def r(v):
        return None if v is None else (round(v, decimals) if decimals is not None else float(v))

    rows = [(c, int(row[f"d_n{i}"]), r(row[f"d_m{i}"]), r(row[f"d_s{i}"]), r(row[f"d_lo{i}"]),
             r(qs[(c, 0.25)]), r(qs[(c, 0.5)]), r(qs[(c, 0.75)]), r(row[f"d_hi{i}"]))
            for i, c in enumerate(cols)]
    schema = T.StructType([T.StructField("column", T.StringType()),
                           T.StructField("count", T.LongType())] +
                          [T.StructField(k, T.DoubleType())
                           for k in ("mean", "std", "min", "q25", "q50", "q75", "max")])
    return df.sparkSession.createDataFrame(rows, schema)
