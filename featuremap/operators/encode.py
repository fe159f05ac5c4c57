"""Categorical encoders E1-E4 (label, one-hot, smoothed target mean, hash).

Fits are distributed aggregates over a stacked ``(column, value)`` view, so
several columns share one scan and one shuffle, and a hot category is
pre-aggregated map-side.  Mappings reach the driver only when their size was
counted first; apply is then a projection (tiny mappings), a broadcast join
(mapping under ``broadcast_limit`` rows) or a plain join that AQE plans.
"""

from __future__ import annotations

import warnings

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformerError
from ..functions.columns import as_double, categorical_columns, q, resolve_columns
from ..functions.ranking import sorted_index
from ..session import scratch_path
from .base import Estimator, Model

_MODES = ("error", "warn", "ignore")
MAP_LITERAL_LIMIT = 64          # mappings this small become a map literal in the projection
BROADCAST_LIMIT = 1_000_000     # mappings up to this many rows ...
BROADCAST_BYTES = 64 << 20      # ... and about this many bytes are broadcast
COLLECT_BYTES = 16 << 20        # values of all columns of a fit that may come to the driver


def _check_mode(mode: str) -> str:
    if mode not in _MODES:
        raise TransformerError(f"handle_unknown must be one of {_MODES}, got {mode!r}")
    return mode


def _stack(df: DataFrame, cols: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per (input row, column): ``(col, value[, extras])``."""
    extra = extra or {}
    items = [F.struct(F.lit(c).alias("col"), F.col(q(c)).cast("string").alias("value"),
                      *[v.alias(k) for k, v in extra.items()]) for c in cols]
    return df.select(F.inline(F.array(*items)))


def _distinct_counts(d: DataFrame) -> dict[str, tuple[int, int]]:
    """Rows and key bytes per column of a distinct ``(col, value)`` table."""
    return {r["col"]: (r["n"], r["b"] or 0) for r in
            d.groupBy("col").agg(F.count(F.lit(1)).alias("n"),
                                 F.sum(F.octet_length("value")).alias("b")).collect()}


def report_unknown(df: DataFrame, pairs: list[tuple[str, Column, Column]], mode: str) -> None:
    """``warn`` warns with the number of rows with unknown values, ``error`` raises with
    the distinct values (the first 20 by name); one aggregate for all columns.

    ``pairs``: column, value, and whether the row is unknown.  Streams are left to
    the expressions of the transform.
    """
    if mode == "ignore" or df.isStreaming or not pairs:
        return
    found = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), F.coalesce(v.cast("string"), F.lit("NULL")).alias("value"),
                 bad.alias("bad")) for c, v, bad in pairs]))).where("bad")
    counted = found.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counted.groupBy("col").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values")).collect()     # a row a column
    if not top:
        return
    if mode == "warn":
        warnings.warn("unknown categories: " + ", ".join(
            f"{r['rows']} rows with {r['values']} values in '{r['col']}'" for r in top))
        return
    some = counted.orderBy("col", "value").limit(20).collect()
    names = {r["col"]: [x["value"] for x in some if x["col"] == r["col"]] for r in top}
    raise TransformerError("; ".join(
        f"Unknown categories in '{r['col']}': {names[r['col']]}"
        + (f" and more, {r['values']} in all" if r["values"] > len(names[r["col"]]) else "")
        for r in top))


class _Mapping:
    """value -> code/encoding for one column, small (dict) or distributed."""

    def __init__(self, col: str, small: dict | None = None, table: DataFrame | None = None,
                 size: int = 0, nbytes: int = 0):
        self.col, self.small, self.table, self.size, self.nbytes = col, small, table, size, nbytes

    def lookup(self, df: DataFrame, out: str, key: Column, tag: str) -> DataFrame:
        """Add column ``out`` = mapped value of ``key`` (NULL when absent)."""
        if self.small is not None and len(self.small) <= MAP_LITERAL_LIMIT:
            if not self.small:
                return df.withColumn(out, F.lit(None))
            m = F.create_map(*[F.lit(x) for kv in sorted(self.small.items()) for x in kv])
            return df.withColumn(out, F.try_element_at(m, key))
        if self.small is not None:
            spark = df.sparkSession
            vt = T.DoubleType() if any(isinstance(v, float) for v in self.small.values()) \
                else T.LongType()
            tab = spark.createDataFrame(list(self.small.items()),
                                        T.StructType([T.StructField("value", T.StringType()),
                                                      T.StructField("enc", vt)]))
        else:
            tab = self.table
        k, v = f"__k_{tag}", f"__v_{tag}"
        tab = tab.select(F.col("value").alias(k), F.col("enc").alias(v))
        nbytes = (sum(len(x.encode()) for x in self.small) if self.small is not None else self.nbytes)
        size = len(self.small) if self.small is not None else self.size
        if size <= BROADCAST_LIMIT and nbytes + 16 * size <= BROADCAST_BYTES:
            tab = F.broadcast(tab)          # size checked at fit time
        # otherwise a shuffle join planned by AQE (skewed keys are split); rows without
        # a key match nothing and are spread by the partition they come from
        spread = F.coalesce(key, F.concat(F.lit("none "), F.spark_partition_id().cast("string")))
        return (df.withColumn(f"__none_{tag}", key.isNull()).withColumn(f"__key_{tag}", spread)
                .join(tab, (F.col(f"__key_{tag}") == F.col(k)) & ~F.col(f"__none_{tag}"), "left")
                .drop(k, f"__key_{tag}", f"__none_{tag}").withColumnRenamed(v, out))


def _fail_unknown(col: str, known: Column, value: Column, include_null: bool) -> Column:
    """``handle_unknown='error'`` as an expression: the job that first meets an
    unknown value fails with it, no extra pass over the data is needed (and
    it works on streams).  Returns a boolean column that is true for rows
    that pass."""
    bad = ~known if include_null else (value.isNotNull() & ~known)
    msg = F.concat(F.lit(f"Unknown categories in '{col}': "),
                   F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.when(bad, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))


# ---------------------------------------------------------------- E1 / E1o / E1u
class LabelEncoder(Estimator):
    """Code = position of the value in sorted distinct order (from 0).

    ``categories={col: [...]}`` gives an explicit (ordinal) order instead.
    Unknown values (NULL included): ``error`` raises, ``warn`` gives -1,
    ``ignore`` gives NULL.
    """

    def __init__(self, columns=None, handle_unknown: str = "error",
                 categories: dict[str, list] | None = None, collect_limit: int = 100_000):
        self.columns = columns
        self.handle_unknown = _check_mode(handle_unknown)
        self.categories = categories or {}
        self.collect_limit = collect_limit

    def fit(self, df: DataFrame) -> "LabelModel":
        cols = resolve_columns(df, self.columns or list(self.categories) or None,
                               categorical_columns)
        maps: dict[str, _Mapping] = {}
        learn = [c for c in cols if c not in self.categories]
        for c in cols:
            if c in self.categories:
                maps[c] = _Mapping(c, small={str(v): i for i, v in enumerate(self.categories[c])})
        if learn:
            # the distinct values are kept: the large-cardinality path reads them
            # again (count, ranking) without rescanning the input
            d = (_stack(df, learn).where(F.col("value").isNotNull()).distinct()
                 .persist(StorageLevel.MEMORY_AND_DISK))
            try:
                return self._fit_counted(d, learn, maps)
            finally:
                d.unpersist()
        return LabelModel(maps, self.handle_unknown)

    def fit_values(self, values: DataFrame, columns: list[str]) -> "LabelModel":
        """Learn from a stored table of distinct ``(col, value)`` instead of the rows."""
        return self._fit_counted(values, columns, {})

    def _fit_counted(self, d: DataFrame, learn: list[str], maps: dict) -> "LabelModel":
        """Rows and bytes are counted first: the smallest columns are collected while
        all of them together stay under both bounds, the others are ranked."""
        counts = _distinct_counts(d)
        small_cols, rows, nbytes = [], 0, 0
        for c in sorted(learn, key=lambda c: counts.get(c, (0, 0))):
            n, b = counts.get(c, (0, 0))
            rows, nbytes = rows + n, nbytes + b
            if rows <= self.collect_limit and nbytes <= COLLECT_BYTES:
                small_cols.append(c)
        big_cols = [c for c in learn if c not in small_cols]
        if small_cols:
            got: dict[str, list] = {c: [] for c in small_cols}
            for r in d.where(F.col("col").isin(small_cols)).collect():
                got[r["col"]].append(r["value"])
            for c in small_cols:
                maps[c] = _Mapping(c, small={v: i for i, v in enumerate(sorted(got[c]))},
                                   size=len(got[c]))
        if big_cols:
            total = sum(counts[c][0] for c in big_cols)
            parts = max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                        total // 2_000_000 + 1)      # about 2M distinct values per task
            idx = sorted_index(d.where(F.col("col").isin(big_cols)), "col", "value", "enc",
                               num_partitions=parts)
            for c in big_cols:
                maps[c] = _Mapping(c, table=idx.where(F.col("col") == c).select("value", "enc"),
                                   size=counts[c][0], nbytes=counts[c][1])
        return LabelModel(maps, self.handle_unknown)


class LabelModel(Model):
    def __init__(self, maps: dict[str, _Mapping], handle_unknown: str):
        self.maps, self.handle_unknown = maps, handle_unknown
        self.params = {c: {"n_categories": float(m.size or len(m.small or {}))}
                       for c, m in maps.items()}

    def mapping(self, col: str) -> dict | DataFrame:
        """value -> code: a dict, or a DataFrame (value, enc) if it is too large for one."""
        m = self.maps[col]
        return m.small if m.small is not None else m.table

    def transform(self, df: DataFrame, report: bool = True) -> DataFrame:
        """``report`` looks for unknown values first (one pass) under ``warn`` and
        ``error``; without it ``error`` fails in the job that meets one."""
        order = df.columns
        for i, (c, m) in enumerate(self.maps.items()):
            if c in df.columns:
                df = m.lookup(df, f"__code_{i}", F.col(q(c)).cast("string"), str(i))
        if report:
            report_unknown(df, [(c, F.col(q(c)), F.col(f"__code_{i}").isNull())
                                for i, c in enumerate(self.maps) if c in order], self.handle_unknown)
        for i, c in enumerate(self.maps):
            if c not in order:
                continue
            tmp = f"__code_{i}"
            if self.handle_unknown == "error":
                ok = _fail_unknown(c, F.col(tmp).isNotNull(), F.col(q(c)), include_null=True)
                code = F.when(ok, F.col(tmp))
            elif self.handle_unknown == "warn":
                code = F.coalesce(F.col(tmp), F.lit(-1))
            else:
                code = F.col(tmp)
            # counted at fit time: codes past 2^31 need a long
            df = df.withColumn(c, code.cast("long" if self.maps[c].size > 2 ** 31 else "int")).drop(tmp)
        return df.select(*map(q, order))


# ---------------------------------------------------------------- E2 / E2d / E2s
class OneHotEncoder(Estimator):
    """One 0/1 column ``{col}{sep}{category}`` per sorted category; original dropped.

    NULL and unseen values give all zeros.  Unseen values are silent (``ignore``),
    counted in a warning (``warn``), or raise with their names (``error``).
    With ``max_categories`` more distinct values than that are refused, never
    truncated; for wide columns use ``sparse=True``.

    ``sparse=True`` emits one column per input column and has no category list on the
    driver or in the plan: positions are label codes, ranked on the cluster and joined.
    ``sparse_format`` is ``vector`` (``{col}_vec``, an ML sparse vector) or ``indices``
    (``{col}_idx``, the positions of the ones as ``array<bigint>``).
    """

    def __init__(self, columns=None, drop_first: bool = False, handle_unknown: str = "ignore",
                 prefix_sep: str = "_", max_categories: int | None = None, sparse: bool = False,
                 sparse_format: str = "vector"):
        self.columns = columns
        self.drop_first = drop_first
        self.handle_unknown = _check_mode(handle_unknown)
        self.prefix_sep = prefix_sep
        self.max_categories = max_categories
        if sparse_format not in ("vector", "indices"):
            raise TransformerError("sparse_format must be 'vector' or 'indices'")
        self.sparse, self.sparse_format = sparse, sparse_format

    def _refuse_too_many(self, counts: dict[str, int]) -> None:
        over = {c: n for c, n in counts.items()
                if self.max_categories is not None and n > self.max_categories}
        if over:
            raise TransformerError(f"too many categories for one-hot: {over}")

    def fit(self, df: DataFrame) -> "OneHotModel | SparseOneHotModel":
        cols = resolve_columns(df, self.columns, categorical_columns)
        if self.sparse:
            labels = LabelEncoder(cols, collect_limit=MAP_LITERAL_LIMIT).fit(df).maps if cols else {}
            labels = {c: labels[c] for c in cols}
            self._refuse_too_many({c: m.size for c, m in labels.items()})
            return SparseOneHotModel(labels, self.drop_first, self.handle_unknown, self.sparse_format)
        cats: dict[str, list[str]] = {c: [] for c in cols}
        if cols:
            d = _stack(df, cols).where(F.col("value").isNotNull()).distinct()
            # every category becomes an output column, so their number and bytes are
            # counted before they come to the driver, which plans those columns
            counts = _distinct_counts(d)
            self._refuse_too_many({c: n for c, (n, _) in counts.items()})
            size = sum(b + 16 * n for n, b in counts.values())
            if size > BROADCAST_BYTES:
                raise TransformerError(f"categories of {size} bytes cannot become columns")
            for r in d.collect():
                cats[r["col"]].append(r["value"])
        for c in cols:
            cats[c] = sorted(cats[c])
        return OneHotModel(cats, self.drop_first, self.handle_unknown, self.prefix_sep)


class OneHotModel(Model):
    def __init__(self, categories, drop_first, handle_unknown, prefix_sep):
        self.categories = categories
        self.drop_first = drop_first
        self.handle_unknown = handle_unknown
        self.prefix_sep = prefix_sep
        self.params = {c: {"n_categories": float(len(v))} for c, v in categories.items()}

    def output_columns(self, col: str) -> list[str]:
        cats = self.categories[col][1:] if self.drop_first else self.categories[col]
        return [f"{col}{self.prefix_sep}{v}" for v in cats]

    def transform(self, df: DataFrame, report: bool = True) -> DataFrame:
        """As :meth:`LabelModel.transform`."""
        present = [c for c in self.categories if c in df.columns]
        known = {c: F.col(q(c)).cast("string").isin(self.categories[c]) for c in present}
        if report:
            report_unknown(df, [(c, F.col(q(c)), F.col(q(c)).isNotNull() & ~known[c]) for c in present],
                           self.handle_unknown)
        if self.handle_unknown == "error":
            df = df.withColumns({c: F.when(_fail_unknown(c, known[c], F.col(q(c)), False), F.col(q(c)))
                                 for c in present})
        keep = [F.col(q(c)) for c in df.columns if c not in present]
        new = []
        for c in present:
            cats = self.categories[c][1:] if self.drop_first else self.categories[c]
            s = F.col(q(c)).cast("string")
            new += [F.when(s == F.lit(v), 1).otherwise(0).alias(f"{c}{self.prefix_sep}{v}")
                    for v in cats]
        return df.select(*keep, *new)


class SparseOneHotModel(Model):
    """Positions by join to the label codes; works at any number of categories.

    ``widths`` has each column's vector length (without the first category under
    ``drop_first``); ``mapping(col)`` the codes.
    """

    def __init__(self, maps: dict[str, _Mapping], drop_first: bool, handle_unknown: str, form: str):
        self.maps, self.drop_first, self.handle_unknown, self.form = maps, drop_first, handle_unknown, form
        self.widths = {c: max(m.size - int(drop_first), 0) for c, m in maps.items()}
        self.params = {c: {"n_categories": float(m.size)} for c, m in maps.items()}

    def mapping(self, col: str) -> dict | DataFrame:
        m = self.maps[col]
        return m.small if m.small is not None else m.table

    def transform(self, df: DataFrame, report: bool = True) -> DataFrame:
        """As :meth:`LabelModel.transform`."""
        present = [c for c in self.maps if c in df.columns]
        keep = [F.col(q(c)) for c in df.columns if c not in present]
        code = {c: f"__code_{i}" for i, c in enumerate(self.maps)}
        for i, c in enumerate(self.maps):
            if c in present:
                df = self.maps[c].lookup(df, code[c], F.col(q(c)).cast("string"), f"o{i}")
        if report:
            report_unknown(df, [(c, F.col(q(c)), F.col(q(c)).isNotNull() & F.col(code[c]).isNull())
                                for c in present], self.handle_unknown)
        if self.handle_unknown == "error":
            df = df.withColumns({code[c]: F.when(_fail_unknown(c, F.col(code[c]).isNotNull(), F.col(q(c)), False),
                                                 F.col(code[c])) for c in present})
        at = {c: F.col(code[c]).cast("long") - int(self.drop_first) for c in present}
        if self.form == "indices":
            none = F.array().cast("array<bigint>")
            return df.select(*keep, *[F.when(at[c] >= 0, F.array(at[c])).otherwise(none).alias(f"{c}_idx")
                                      for c in present])
        return self._vectors(df, keep, at)

    def _vectors(self, df: DataFrame, keep: list[Column], at: dict[str, Column]) -> DataFrame:
        """ML sparse vectors; rows without a position take the last slot, which is dropped."""
        from pyspark.ml.feature import OneHotEncoder as MLOneHot

        wide = [c for c in at if self.widths[c] >= 2 ** 31 - 1]
        if wide:
            raise TransformerError(f"too many categories for an ML vector (use sparse_format='indices'): {wide}")
        slots = {c: f"__slot_{i}" for i, c in enumerate(at)}
        for c, col in at.items():
            width = self.widths[c]
            meta = {"ml_attr": {"type": "nominal", "num_vals": width, "name": slots[c]}}
            slot = F.when(col >= 0, col).otherwise(F.lit(width)).cast("double")
            df = df.withColumn(slots[c], slot.alias(slots[c], metadata=meta))
        if slots:
            out = {c: f"__vec_{i}" for i, c in enumerate(slots)}
            ml = MLOneHot(inputCols=list(slots.values()), outputCols=list(out.values()), dropLast=True,
                          handleInvalid="keep")
            df = ml.fit(df).transform(df)
            keep = [*keep, *[F.col(out[c]).alias(f"{c}_vec") for c in slots]]
        return df.select(*keep)


# ---------------------------------------------------------------- E3 / E3u / E3m / E3r
class TargetEncoder(Estimator):
    """``(n * mean + s * global) / (n + s)`` per category of each column.

    ``target`` names a numeric column of the same DataFrame.  NULL targets are
    ignored in mean, count and global mean.  Unknown, NULL or all-null-target
    categories, and categories with fewer than ``min_samples`` targets, get the
    global mean (``ignore``/``warn``) or raise (``error``).
    """

    def __init__(self, columns=None, target: str | None = None, smoothing: float = 1.0,
                 handle_unknown: str = "ignore", min_samples: int = 1,
                 collect_limit: int = MAP_LITERAL_LIMIT):
        self.columns = columns
        self.target = target
        self.smoothing = float(smoothing)
        self.handle_unknown = _check_mode(handle_unknown)
        self.min_samples = min_samples
        self.collect_limit = collect_limit

    def fit(self, df: DataFrame) -> "TargetModel":
        if not self.target or self.target not in df.columns:
            raise TransformerError(f"TargetEncoder requires a target column, got {self.target!r}")
        cols = [c for c in resolve_columns(df, self.columns, categorical_columns)
                if c != self.target]
        y = as_double(df, self.target)           # NaN targets count as missing, as NULL does
        if not cols:
            return TargetModel({}, df.agg(F.avg(y)).first()[0], self.handle_unknown)
        # one pass: per (column, value) target sum, target count and row count;
        # NULL values form their own group, so the groups of any one column
        # also give the global mean and the number of NULL targets
        st = (_stack(df, cols, {"y": y}).groupBy("col", "value")
              .agg(F.sum("y").alias("sy"), F.count("y").alias("n"),
                   F.count(F.lit(1)).alias("rows"))
              .persist(StorageLevel.MEMORY_AND_DISK))
        cap = self.collect_limit * len(cols) + len(cols)
        first = st.limit(cap + 1).collect()
        if len(first) <= cap:
            st.unpersist()
            tot = [r for r in first if r["col"] == cols[0]]
        else:
            tot = st.where(F.col("col") == cols[0]).agg(
                F.sum("sy").alias("sy"), F.sum("n").alias("n"), F.sum("rows").alias("rows")).collect()
        t_sy = sum(r["sy"] or 0.0 for r in tot)
        t_n = sum(r["n"] for r in tot)
        gmean = t_sy / t_n if t_n else None
        nulls = sum(r["rows"] for r in tot) - t_n
        if nulls:
            warnings.warn(f"{nulls} NULL targets ignored by TargetEncoder")
        sm = self.smoothing

        def encode(n, sy):
            if n == 0 or n < self.min_samples:
                return gmean
            return (n * (sy / n) + sm * gmean) / (n + sm)

        maps = {}
        if len(first) <= cap:
            got_all: dict[str, dict] = {c: {} for c in cols}
            for r in first:
                if r["value"] is not None:
                    got_all[r["col"]][r["value"]] = encode(r["n"], r["sy"])
            for c in cols:
                maps[c] = _Mapping(c, small=got_all[c], size=len(got_all[c]))
            return TargetModel(maps, gmean, self.handle_unknown)
        gl = F.lit(gmean).cast("double")
        n_, m_ = F.col("n"), F.col("sy") / F.col("n")
        enc = (F.when((n_ == 0) | (n_ < F.lit(self.min_samples)), gl)
               .otherwise((n_ * m_ + F.lit(sm) * gl) / (n_ + F.lit(sm))))
        # written once, so that nothing stays persisted behind the model
        path = scratch_path(df.sparkSession, "target-encodings")
        try:
            (st.where(F.col("value").isNotNull()).select("col", "value", enc.alias("enc"))
             .write.parquet(path))
        finally:
            st.unpersist()
        table = df.sparkSession.read.parquet(path)
        counts = _distinct_counts(table)
        for c in cols:
            maps[c] = _Mapping(c, table=table.where(F.col("col") == c).select("value", "enc"),
                               size=counts.get(c, (0, 0))[0], nbytes=counts.get(c, (0, 0))[1])
        return TargetModel(maps, gmean, self.handle_unknown)


class TargetModel(Model):
    def __init__(self, maps: dict[str, _Mapping], global_mean: float | None, handle_unknown: str):
        self.maps, self.global_mean, self.handle_unknown = maps, global_mean, handle_unknown
        self.params = {c: {"global_mean": global_mean, "n_categories": float(m.size)}
                       for c, m in maps.items()}

    def transform(self, df: DataFrame, report: bool = True) -> DataFrame:
        """As :meth:`LabelModel.transform`."""
        order = df.columns
        for i, (c, m) in enumerate(self.maps.items()):
            if c in df.columns:
                df = m.lookup(df, f"__enc_{i}", F.col(q(c)).cast("string"), f"t{i}")
        if report:
            report_unknown(df, [(c, F.col(q(c)), F.col(q(c)).isNotNull() & F.col(f"__enc_{i}").isNull())
                                for i, c in enumerate(self.maps) if c in order], self.handle_unknown)
        for i, c in enumerate(self.maps):
            if c not in order:
                continue
            tmp = f"__enc_{i}"
            enc = F.coalesce(F.col(tmp), F.lit(self.global_mean).cast("double")).cast("double")
            if self.handle_unknown == "error":
                enc = F.when(_fail_unknown(c, F.col(tmp).isNotNull(), F.col(q(c)), False), enc)
            df = df.withColumn(c, enc).drop(tmp)
        return df.select(*map(q, order))


# ---------------------------------------------------------------- E4 / E4s
def md5_bucket(text: Column, n_bins: int) -> Column:
    """``int(md5(text), 16) % n_bins`` exactly, in 64-bit arithmetic.

    The 128-bit digest is folded 32 bits at a time:
    ``acc = (acc * (2^32 mod n) + chunk) mod n`` never leaves ``bigint`` for
    ``n < 2^31``.
    """
    if not 0 < n_bins < 2 ** 31:
        raise TransformerError("n_bins must be in [1, 2^31)")
    h = F.md5(text)
    base = F.lit((2 ** 32) % n_bins).cast("bigint")
    n = F.lit(n_bins).cast("bigint")
    acc = F.lit(0).cast("bigint")
    for k in range(4):
        chunk = F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * base + chunk, n)
    return acc


class HashEncoder(Model):
    """Stateless: ``n_functions`` columns ``{col}_hash_{i}`` with the bucket of
    ``"{col}_{i}_{value}"``; NULL -> 0; original dropped.

    ``hash`` is ``md5`` (default, the reference rule), ``xxhash64`` or
    ``murmur3``; ``signed=True`` subtracts ``n_bins // 2``.
    """

    def __init__(self, columns=None, n_bins: int = 8, n_functions: int = 3,
                 hash: str = "md5", signed: bool = False):
        if hash not in ("md5", "xxhash64", "murmur3"):
            raise TransformerError(f"unknown hash {hash!r}")
        self.columns, self.n_bins, self.n_functions = columns, n_bins, n_functions
        self.hash, self.signed = hash, signed
        self.params = {}

    def fit(self, df: DataFrame) -> "HashEncoder":
        return self

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.transform(df)

    def bucket(self, col: str, i: int) -> Column:
        text = F.concat(F.lit(f"{col}_{i}_"), F.col(q(col)).cast("string"))
        if self.hash == "md5":
            b = md5_bucket(text, self.n_bins)
        elif self.hash == "xxhash64":
            b = F.pmod(F.xxhash64(text), F.lit(self.n_bins).cast("bigint"))
        else:
            b = F.pmod(F.hash(text).cast("bigint"), F.lit(self.n_bins).cast("bigint"))
        b = F.when(F.col(q(col)).isNull(), F.lit(0).cast("bigint")).otherwise(b)
        if self.signed:
            b = b - F.lit(self.n_bins // 2)
        return b.cast("int")

    def transform(self, df: DataFrame) -> DataFrame:
        cols = resolve_columns(df, self.columns, categorical_columns)
        keep = [F.col(q(c)) for c in df.columns if c not in cols]
        new = [self.bucket(c, i).alias(f"{c}_hash_{i}")
               for c in cols for i in range(self.n_functions)]
        return df.select(*keep, *new)
