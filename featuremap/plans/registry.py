"""Registry of catalogue queries: a Spark builder and, where SQL can express
it, the equivalent DuckDB statement used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def positive_zero_rounding(sql: str) -> str:
    """Append ``+ 0.0`` to every ``round(...)`` call of an oracle statement.

    DuckDB rounds a tiny negative double to ``-0.0`` where Spark's decimal
    rounding gives ``0.0``; adding zero turns ``-0.0`` into ``0.0`` and leaves
    every other double unchanged.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounding(sql[j + 6:k])
        out.append(sql[i:j] + "(" + sql[j:j + 6] + inner + ") + 0.0)")
        i = k + 1


def query(name: str, sql: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = positive_zero_rounding(sql)
        if headline:
            HEADLINE.append(name)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
