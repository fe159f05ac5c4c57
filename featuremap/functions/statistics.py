"""Statistics that several fits ask for, gathered in one pass per kind.

:func:`gather` runs one aggregate for all numeric columns (number of values, mergeable
rank sketch) and one grouped count for all categorical columns, stored in the shared
folder.  What depends on the answers (modes, label order, quartiles of codes, medians,
quartiles after filling) is read from the stored counts, or by one more job that reads
order statistics inside the sketches' brackets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .columns import as_double, q
from .quantiles import order_statistics, rank_sketch

BLOCK_CODES = 1 << 20       # consecutive codes that one task adds up


@dataclass
class Statistics:
    """``n`` and ``sketch`` of numeric columns; ``counts``: (col, value, n) of the non-null
    values of categorical columns as text, or None."""

    rows: int
    n: dict[str, int]
    sketch: dict[str, bytes]
    counts: DataFrame | None


def gather(df: DataFrame, numeric: list[str], categorical: list[str]) -> Statistics:
    """Two passes over ``df``, one of them only where there are categorical columns."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(numeric):
        x = as_double(df, c)
        aggs += [F.count(x).alias(f"n{i}"), rank_sketch(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    counts = None
    if categorical:
        path = scratch_path(df.sparkSession, "value-counts")
        items = [F.struct(F.lit(c).alias("col"), F.col(q(c)).cast("string").alias("value")) for c in categorical]
        (df.select(F.inline(F.array(*items))).where(F.col("value").isNotNull())
         .groupBy("col", "value").agg(F.count(F.lit(1)).alias("n")).write.parquet(path))
        counts = df.sparkSession.read.parquet(path)
    return Statistics(row["rows"], {c: row[f"n{i}"] for i, c in enumerate(numeric)},
                      {c: bytes(row[f"s{i}"]) for i, c in enumerate(numeric)}, counts)


def _spots(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    return math.floor(pos), math.ceil(pos), pos


def filled_quantiles(df: DataFrame, stats: Statistics, probs: list[float], stored=lambda c, v: v):
    """Per numeric column the median of its values, and the quantiles after its nulls are
    filled with it: ``({c: median}, {(c, p): value})``, None for a column without values.

    Filling puts (rows - n) copies of the median after the lower half of the values,
    which shifts the ranks of the others, so all of them are order statistics of the
    values themselves: one job.  ``stored(c, median)`` is the fill as the column's type
    holds it.
    """
    wanted = {}
    for c, n in stats.n.items():
        if n:
            lo, hi, _ = _spots(n, 0.5)
            ranks = {lo, hi}
            for p in probs:
                ranks |= {r for r in (_source(x, n, stats.rows) for x in _spots(stats.rows, p)[:2]) if r is not None}
            wanted[c] = (n, stats.sketch[c], ranks)
    at = order_statistics(df, wanted)
    medians, out = {}, {}
    for c, n in stats.n.items():
        if not n:
            medians[c] = None
            out.update({(c, p): None for p in probs})
            continue
        lo, hi, pos = _spots(n, 0.5)
        medians[c] = at[c, lo] + (at[c, hi] - at[c, lo]) * (pos - lo)
        fill = stored(c, medians[c])
        for p in probs:
            lo, hi, pos = _spots(stats.rows, p)
            a, b = (fill if r is None else at[c, r] for r in (_source(x, n, stats.rows) for x in (lo, hi)))
            out[c, p] = a + (b - a) * (pos - lo)
    return medians, out


def _source(rank: int, n: int, rows: int) -> int | None:
    """Rank among the values of a rank after filling; None: a filled row."""
    half = (n - 1) // 2 + 1
    if rank < half:
        return rank
    return None if rank < half + rows - n else rank - (rows - n)


def weighted_quantiles(pairs: list[tuple[float, int]], probs: list[float]) -> dict[float, float]:
    """Quantiles of ascending (value, number of rows)."""
    total, out = sum(n for _, n in pairs), {}
    for p in probs:
        lo, hi, pos = _spots(total, p)
        at, before = {}, 0
        for value, n in pairs:
            at.update({r: value for r in (lo, hi) if before <= r < before + n})
            before += n
        out[p] = at[lo] + (at[hi] - at[lo]) * (pos - lo)
    return out


def code_quantiles(codes: DataFrame, probs: list[float]) -> dict[float, float]:
    """Quantiles of ``code`` where each stands for ``n`` rows; codes are 0, 1, 2, ...
    Blocks of codes are added up first, then only the blocks that hold a rank are read."""
    blocks = codes.withColumn("block", F.floor(F.col("code") / BLOCK_CODES))
    sums = sorted((r["block"], r["n"]) for r in blocks.groupBy("block").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sums)
    ranks = {r for p in probs for r in _spots(total, p)[:2]}
    before, where = 0, {}
    for block, n in sums:
        where.update({r: (block, before) for r in ranks if before <= r < before + n})
        before += n
    start = F.create_map(*[F.lit(x) for b, n in set(where.values()) for x in (b, n)])
    upto = (F.sum("n").over(Window.partitionBy("block").orderBy("code"))
            + start[F.col("block")])
    held = blocks.where(F.col("block").isin([b for b, _ in set(where.values())])).withColumn("upto", upto)
    at = held.agg(*[F.min(F.when(F.col("upto") > r, F.col("code"))).alias(str(r)) for r in sorted(ranks)]).first()
    out = {}
    for p in probs:
        lo, hi, pos = _spots(total, p)
        out[p] = at[str(lo)] + (at[str(hi)] - at[str(lo)]) * (pos - lo)
    return out
