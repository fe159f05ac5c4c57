"""Column classification and null/NaN hygiene shared by all fits (X2, §1.3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformerError

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
            T.FloatType, T.DoubleType, T.DecimalType)
_STRING = (T.StringType, T.CharType, T.VarcharType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


def is_categorical(dt: T.DataType) -> bool:
    return isinstance(dt, _STRING)


def numeric_columns(df: DataFrame) -> list[str]:
    """All numeric columns in schema order (booleans excluded)."""
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """All string columns in schema order."""
    return [f.name for f in df.schema.fields if is_categorical(f.dataType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    """Everything that is not numeric (the auto-prep notion of categorical)."""
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType)]


def resolve_columns(df: DataFrame, columns: Iterable[str] | None, default,
                    strict: bool = False) -> list[str]:
    """Requested columns that exist, or ``default(df)`` when none are given.

    An empty list means "all" (as ``None``).  Missing names are ignored unless
    ``strict`` is set.
    """
    if not columns:
        return default(df)
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing and strict:
        raise TransformerError(f"columns not found: {missing}")
    return [c for c in columns if c in present]


def as_double(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN turned into NULL (fit-side hygiene)."""
    dt = df.schema[name].dataType
    c = F.col(q(name)).cast("double")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        c = F.nanvl(c, F.lit(None).cast("double"))
    return c


def q(name: str) -> str:
    """Back-quote a column name for use inside SQL expressions."""
    return "`" + name.replace("`", "``") + "`"
