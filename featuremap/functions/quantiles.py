"""Exact quantiles without a single-task value buffer.

``F.percentile`` / ``F.median`` keep one map entry per distinct value and merge
every map in the one final task of a global aggregate, which does not hold for
a high-cardinality column of a very large table.  Here the exact answer is
found by bracketing:

1. one aggregate: ``count`` and a mergeable ``percentile_approx`` sketch
   around each requested fraction (bounded memory per task);
2. one aggregate: how many values fall below / inside every bracket;
3. if a bracket still holds more than ``max_collect`` values it is narrowed
   with another sketch over the bracket's rows only; otherwise its distinct
   values with their counts (at most ``max_collect`` rows, checked before)
   come back and the order statistics are read off exactly.

Interpolation is linear between the two neighbouring order statistics, the
same definition as pandas ``quantile`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import as_double


@dataclass
class _Task:
    col: str
    p: float
    n: int = 0
    lo: float = -math.inf
    hi: float = math.inf
    below: int = 0
    inside: int = 0
    result: float | None = None
    done: bool = False
    rank: int | None = None         # this order statistic instead of the fraction

    @property
    def ranks(self) -> tuple[int, int, float]:
        if self.rank is not None:
            return self.rank, self.rank, float(self.rank)
        pos = (self.n - 1) * self.p
        return math.floor(pos), math.ceil(pos), pos


def _in_bracket(x: Column, t: _Task) -> Column:
    cond = x.isNotNull()
    if t.lo != -math.inf:
        cond = cond & (x >= F.lit(t.lo))
    if t.hi != math.inf:
        cond = cond & (x <= F.lit(t.hi))
    return cond


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    exact: bool = True, accuracy: int = 10_000,
                    max_collect: int = 100_000,
                    stats: dict | None = None,
                    extra: list[Column] | None = None) -> dict[tuple[str, float], float | None]:
    """Quantiles of every column at every fraction; NULL/NaN ignored.

    Returns ``{(column, p): value}``; value is ``None`` for an all-null column.
    With ``exact=False`` a single ``percentile_approx`` aggregate is used.
    ``stats``, when given, receives the total row count as ``stats["rows"]``
    and, for ``extra`` aggregate columns computed in the same first pass,
    their result row as ``stats["extra"]``.
    """
    if not columns:
        if stats is not None:
            stats["rows"] = df.count()
        return {}
    xs = {c: as_double(df, c) for c in columns}
    if not exact:
        row = df.agg(F.count(F.lit(1)).alias("__rows"), *(extra or []),
                     *[F.percentile_approx(xs[c], list(probs), accuracy).alias(f"q{i}")
                       for i, c in enumerate(columns)]).first()
        if stats is not None:
            stats["rows"], stats["extra"] = row["__rows"], row
        return {(c, p): (row[f"q{i}"][j] if row[f"q{i}"] is not None else None)
                for i, c in enumerate(columns) for j, p in enumerate(probs)}

    tasks = [_Task(c, float(p)) for c in columns for p in probs]
    margin = 2.0 / accuracy

    # pass 1: counts and a first bracket from the sketch
    aggs = [F.count(F.lit(1)).alias("__rows")] + list(extra or [])
    aggs += [F.count(xs[c]).alias(f"n{i}") for i, c in enumerate(columns)]
    # one sketch per column serves all of its fractions
    wanted: dict[str, list[float]] = {c: [] for c in columns}
    for t in tasks:
        wanted[t.col] += [max(0.0, t.p - margin), min(1.0, t.p + margin)]
    for i, c in enumerate(columns):
        aggs.append(F.percentile_approx(xs[c], wanted[c], accuracy).alias(f"a{i}"))
    row = df.agg(*aggs).first()
    if stats is not None:
        stats["rows"] = row["__rows"]
        stats["extra"] = row
    for k, t in enumerate(tasks):
        t.n = row[f"n{columns.index(t.col)}"]
        if t.n == 0:
            t.done = True
            continue
        ci = columns.index(t.col)
        j = [u for u in tasks if u.col == t.col].index(t)
        a = row[f"a{ci}"]
        t.lo, t.hi = float(a[2 * j]), float(a[2 * j + 1])

    _settle(df, xs, tasks, margin, accuracy, max_collect)
    return {(t.col, t.p): t.result for t in tasks}


def _settle(df: DataFrame, xs: dict[str, Column], tasks: list[_Task], margin: float,
            accuracy: int, max_collect: int) -> None:
    """Read off every task's value, from its first bracket on."""
    first = True
    while True:
        active = [t for t in tasks if not t.done]
        if not active:
            break
        if first:
            first = False
            # common case: all brackets are small, so one grouped, limited job
            # returns the counts below each bracket and the values inside it
            if _resolve_direct(df, xs, active, max_collect):
                continue
        # verify brackets: values below and inside
        aggs = []
        for k, t in enumerate(active):
            x = xs[t.col]
            aggs.append(F.count_if(x.isNotNull() & (x < F.lit(t.lo)) if t.lo != -math.inf
                                   else F.lit(False)).alias(f"b{k}"))
            aggs.append(F.count_if(_in_bracket(x, t)).alias(f"i{k}"))
        row = df.agg(*aggs).first()
        for k, t in enumerate(active):
            t.below, t.inside = row[f"b{k}"], row[f"i{k}"]
            r_lo, r_hi, _ = t.ranks
            if not (t.below <= r_lo and t.below + t.inside > r_hi):
                # the sketch missed (should not happen): fall back to the whole range
                t.lo, t.hi = -math.inf, math.inf
                t.below, t.inside = 0, t.n
        small = [t for t in active if t.inside <= max_collect]
        large = [t for t in active if t.inside > max_collect]
        if small:
            _resolve_small(df, xs, small)
        if large:
            # narrow each large bracket with a sketch over its own rows
            aggs = []
            for k, t in enumerate(large):
                r_lo, r_hi, _ = t.ranks
                m = t.inside
                p_lo = max(0.0, (r_lo - t.below) / max(m - 1, 1) - margin)
                p_hi = min(1.0, (r_hi - t.below) / max(m - 1, 1) + margin)
                x = xs[t.col]
                aggs.append(F.percentile_approx(F.when(_in_bracket(x, t), x),
                                                [p_lo, p_hi], accuracy).alias(f"a{k}"))
            row = df.agg(*aggs).first()
            for k, t in enumerate(large):
                a = row[f"a{k}"]
                new_lo, new_hi = float(a[0]), float(a[1])
                if new_lo == t.lo and new_hi == t.hi:
                    _bisect(df, xs[t.col], t)
                else:
                    t.lo, t.hi = new_lo, new_hi


def _bisect(df: DataFrame, x: Column, t: _Task) -> None:
    """The sketch cannot narrow a bracket (heavy duplicates): split it by value."""
    if t.lo == t.hi:
        t.result, t.done = t.lo, True
        return
    mid = t.lo + (t.hi - t.lo) / 2.0
    inside = _in_bracket(x, t)
    row = df.agg(F.count_if(inside & (x < F.lit(mid))).alias("c"),
                 F.max(F.when(inside & (x < F.lit(mid)), x)).alias("mx"),
                 F.min(F.when(inside & (x >= F.lit(mid)), x)).alias("mn")).first()
    r_lo, r_hi, pos = t.ranks
    left = t.below + row["c"]
    if left > r_hi:
        t.hi = row["mx"]
    elif left <= r_lo:
        t.below, t.lo = left, row["mn"]
    else:
        # the two order statistics sit on both sides of mid
        lo_v, hi_v = row["mx"], row["mn"]
        t.result, t.done = lo_v + (hi_v - lo_v) * (pos - r_lo), True


def _resolve_direct(df: DataFrame, xs: dict[str, Column], tasks: list[_Task],
                    max_collect: int) -> bool:
    """Counts below each bracket and the (value, count) pairs inside it, at
    most ``max_collect`` rows reaching the driver; False when that bound is hit
    (then the caller counts first).  Tasks whose bracket missed the target
    ranks are reset to the whole range."""
    items = []
    for k, t in enumerate(tasks):
        x = xs[t.col]
        below = (x.isNotNull() & (x < F.lit(t.lo))) if t.lo != -math.inf else F.lit(False)
        items.append(F.when(below, F.struct(F.lit(k).alias("t"), F.lit(None).cast("double").alias("v")))
                     .when(_in_bracket(x, t), F.struct(F.lit(k).alias("t"), x.alias("v"))))
    rows = (df.select(F.explode(F.array(*items)).alias("e"))
            .where(F.col("e").isNotNull())
            .groupBy(F.col("e.t").alias("t"), F.col("e.v").alias("v"))
            .agg(F.count(F.lit(1)).alias("c"))
            .limit(max_collect + len(tasks) + 1)
            .collect())
    if len(rows) > max_collect + len(tasks):
        return False
    per: dict[int, list[tuple[float, int]]] = {}
    below: dict[int, int] = {}
    for r in rows:
        if r["v"] is None:
            below[r["t"]] = r["c"]
        else:
            per.setdefault(r["t"], []).append((r["v"], r["c"]))
    for k, t in enumerate(tasks):
        t.below = below.get(k, 0)
        vals = sorted(per.get(k, []))
        t.inside = sum(c for _, c in vals)
        r_lo, r_hi, _ = t.ranks
        if not (t.below <= r_lo and t.below + t.inside > r_hi):
            t.lo, t.hi = -math.inf, math.inf
            continue
        _read_off(t, vals)
    return True


def _read_off(t: _Task, vals: list[tuple[float, int]]) -> None:
    r_lo, r_hi, pos = t.ranks

    def at(rank: int) -> float:
        seen = t.below
        for v, c in vals:
            seen += c
            if seen > rank:
                return v
        raise RuntimeError("rank outside bracket")

    lo_v = at(r_lo)
    t.result = lo_v if r_hi == r_lo else lo_v + (at(r_hi) - lo_v) * (pos - r_lo)
    t.done = True


def _resolve_small(df: DataFrame, xs: dict[str, Column], tasks: list[_Task]) -> None:
    """Fetch (value, count) inside each bracket and read the order statistics."""
    items = [F.when(_in_bracket(xs[t.col], t),
                    F.struct(F.lit(k).alias("t"), xs[t.col].alias("v")))
             for k, t in enumerate(tasks)]
    rows = (df.select(F.explode(F.array(*items)).alias("e"))
            .where(F.col("e").isNotNull())
            .groupBy(F.col("e.t").alias("t"), F.col("e.v").alias("v"))
            .agg(F.count(F.lit(1)).alias("c"))
            .collect())
    per: dict[int, list[tuple[float, int]]] = {}
    for r in rows:
        per.setdefault(r["t"], []).append((r["v"], r["c"]))
    for k, t in enumerate(tasks):
        _read_off(t, sorted(per.get(k, [])))


#: size of the rank sketches; the normalized rank error is about 0.05 %
SKETCH_SIZE = 8192
_SKETCH_MARGIN = 0.0015


def rank_sketch(x: Column) -> Column:
    """Mergeable sketch of a column's order, for :func:`order_statistics`."""
    return F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE))


def order_statistics(df: DataFrame, wanted: dict[str, tuple[int, bytes, set[int]]], accuracy: int = 10_000,
                     max_collect: int = 100_000) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks of the non-null values.  ``wanted``: column ->
    (number of values, their sketch, ranks).  The sketches bracket the ranks, so one
    job reads them off; brackets that hold too many rows are narrowed first."""
    spark = df.sparkSession
    tasks = [_Task(c, 0.0, n=n, rank=r) for c, (n, _, ranks) in wanted.items() for r in sorted(ranks)]
    if not tasks:
        return {}
    spots: dict[str, list[float]] = {}
    for t in tasks:
        p = t.rank / max(t.n - 1, 1)
        spots.setdefault(t.col, []).extend([max(0.0, p - _SKETCH_MARGIN), min(1.0, p + _SKETCH_MARGIN)])
    row = spark.createDataFrame([tuple(bytearray(wanted[c][1]) for c in spots)],
                                ", ".join(f"s{i} binary" for i in range(len(spots))))
    row = row.select(*[F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, ps)))
                       for i, ps in enumerate(spots.values())]).first()
    edges = dict(zip(spots, row, strict=True))
    at = dict.fromkeys(spots, 0)
    for t in tasks:
        t.lo, t.hi = edges[t.col][at[t.col]], edges[t.col][at[t.col] + 1]
        at[t.col] += 2
    _settle(df, {c: as_double(df, c) for c in wanted}, tasks, _SKETCH_MARGIN, accuracy, max_collect)
    return {(t.col, t.rank): t.result for t in tasks}
