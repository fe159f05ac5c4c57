"""Catalogue: numeric normalizers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.power import PowerTransformer
from ..operators.scale import LogTransformer, MinMaxScaler, RobustScaler, ZScoreScaler
from .registry import query, table

R = 6  # decimals kept in every computed double, on both sides


def _rounded(df, cols, keep):
    return df.select(*keep, *[F.round(c, R).alias(c) for c in cols])


@query("minmax", headline=True, sql="""
SELECT l_orderkey, l_linenumber,
  round((l_quantity - min(l_quantity) OVER ()) /
        (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity,
  round((l_extendedprice - min(l_extendedprice) OVER ()) /
        (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice
FROM lineitem""")
def minmax(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice"]
    out = MinMaxScaler(cols).fit(li).transform(li)
    return _rounded(out, cols, ["l_orderkey", "l_linenumber"])


@query("minmax_constant", sql="""
WITH t AS (
  SELECT c_custkey, c_acctbal,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 5.0 END AS k
  FROM customer)
SELECT c_custkey,
  round((c_acctbal - min(c_acctbal) OVER ()) /
        (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS c_acctbal,
  CAST(0.0 AS DOUBLE) AS k
FROM t""")
def minmax_constant(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.lit(5.0)).alias("k"))
    out = MinMaxScaler(["c_acctbal", "k"]).fit(c).transform(c)
    return _rounded(out, ["c_acctbal", "k"], ["c_custkey"])


@query("minmax_new_data", sql="""
WITH fit AS (
  SELECT min(c_acctbal) AS mn, max(c_acctbal) AS mx
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT c_custkey, c_mktsegment, round((c_acctbal - mn) / (mx - mn), 6) AS c_acctbal
FROM customer, fit""")
def minmax_new_data(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    model = MinMaxScaler(["c_acctbal"]).fit(c.where(F.col("c_mktsegment") == "AUTOMOBILE"))
    return _rounded(model.transform(c), ["c_acctbal"], ["c_custkey", "c_mktsegment"])


@query("minmax_eps", sql="""
SELECT l_orderkey, l_linenumber,
  round((l_discount - min(l_discount) OVER ()) /
        (max(l_discount) OVER () - min(l_discount) OVER () + 1e-8), 6) AS l_discount,
  round((l_tax - min(l_tax) OVER ()) /
        (max(l_tax) OVER () - min(l_tax) OVER () + 1e-8), 6) AS l_tax
FROM lineitem""")
def minmax_eps(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_discount", "l_tax"]
    out = MinMaxScaler(cols, epsilon=1e-8).fit(li).transform(li)
    return _rounded(out, cols, ["l_orderkey", "l_linenumber"])


@query("minmax_table", sql="""
WITH b AS (
  SELECT least(min(l_discount), min(l_tax)) AS mn,
         greatest(max(l_discount), max(l_tax)) AS mx FROM lineitem)
SELECT l_orderkey, l_linenumber,
  round((l_discount - mn) / (mx - mn), 6) AS l_discount,
  round((l_tax - mn) / (mx - mn), 6) AS l_tax
FROM lineitem, b""")
def minmax_table(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_discount", "l_tax"]
    out = MinMaxScaler(cols, whole_table=True).fit(li).transform(li)
    return _rounded(out, cols, ["l_orderkey", "l_linenumber"])


_Z_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("zscore", headline=True, sql="""
SELECT l_orderkey || '-' || l_linenumber AS line_id, l_returnflag, l_linestatus,
""" + ",\n".join(
    f"  round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in _Z_COLS
) + "\nFROM lineitem")
def zscore(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        "l_returnflag", "l_linestatus", *_Z_COLS)
    out = ZScoreScaler().fit(li).transform(li)      # no columns: every numeric one
    return _rounded(out, _Z_COLS, ["line_id", "l_returnflag", "l_linestatus"])


_R_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("robust", headline=True, sql="""
WITH p AS (SELECT """ + ", ".join(
    f"median({c}) AS med_{c}, quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
    for c in _R_COLS) + """ FROM lineitem)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"CASE WHEN q3_{c} = q1_{c} THEN 0.0 ELSE round(({c} - med_{c}) / (q3_{c} - q1_{c}), 6) END AS {c}"
    for c in _R_COLS) + "\nFROM lineitem, p")
def robust(spark, sf):
    li = table(spark, sf, "lineitem")
    out = RobustScaler(_R_COLS).fit(li).transform(li)
    return _rounded(out, _R_COLS, ["l_orderkey", "l_linenumber"])


@query("robust_range", sql="""
WITH p AS (SELECT median(c_acctbal) AS med, quantile_cont(c_acctbal, 0.1) AS lo,
                  quantile_cont(c_acctbal, 0.9) AS hi FROM customer)
SELECT c_custkey, round((c_acctbal - med) / (hi - lo), 6) AS c_acctbal
FROM customer, p""")
def robust_range(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = RobustScaler(["c_acctbal"], quantile_range=(10, 90)).fit(c).transform(c)
    return _rounded(out, ["c_acctbal"], ["c_custkey"])


@query("log_natural_shift", sql="""
WITH s AS (SELECT CASE WHEN min(c_acctbal) <= 0 THEN abs(min(c_acctbal)) + 1 ELSE 0 END AS sh
           FROM customer)
SELECT c_custkey, round(ln(c_acctbal + sh), 6) AS c_acctbal FROM customer, s""")
def log_natural_shift(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = LogTransformer(["c_acctbal"]).fit(c).transform(c)
    return _rounded(out, ["c_acctbal"], ["c_custkey"])


@query("log10", sql="""
WITH s AS (SELECT CASE WHEN min(l_extendedprice) <= 0 THEN abs(min(l_extendedprice)) + 1
                       ELSE 0 END AS sh FROM lineitem)
SELECT l_orderkey, l_linenumber, round(log10(l_extendedprice + sh), 6) AS l_extendedprice
FROM lineitem, s""")
def log10(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = LogTransformer(["l_extendedprice"], base="10").fit(li).transform(li)
    return _rounded(out, ["l_extendedprice"], ["l_orderkey", "l_linenumber"])


@query("log2_shift", sql="""
WITH s AS (SELECT CASE WHEN min(s_acctbal) <= 0 THEN abs(min(s_acctbal)) + 1 ELSE 0 END AS sh
           FROM supplier)
SELECT s_suppkey, round(log2(s_acctbal + sh), 6) AS s_acctbal FROM supplier, s""")
def log2_shift(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    out = LogTransformer(["s_acctbal"], base="base2").fit(s).transform(s)
    return _rounded(out, ["s_acctbal"], ["s_suppkey"])


@query("fit_params", sql="""
SELECT 'l_quantity' AS "column", 'min' AS parameter, round(min(l_quantity), 6) AS value FROM lineitem
UNION ALL SELECT 'l_quantity', 'max', round(max(l_quantity), 6) FROM lineitem
UNION ALL SELECT 'l_discount', 'min', round(min(l_discount), 6) + 0.0 FROM lineitem
UNION ALL SELECT 'l_discount', 'max', round(max(l_discount), 6) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'mean', round(avg(l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'std', round(stddev_samp(l_extendedprice), 6) FROM lineitem""")
def fit_params(spark, sf):
    li = table(spark, sf, "lineitem")
    a = MinMaxScaler(["l_quantity", "l_discount"]).fit(li).get_params(spark)
    b = ZScoreScaler(["l_extendedprice"]).fit(li).get_params(spark)
    return a.unionByName(b).select("column", "parameter", F.round("value", R).alias("value"))


# ---------------------------------------------------------------- N5 / N6

L = 3  # decimals kept in lambda-dependent results (lambda is an optimum of a flat curve)


def _psi_sql(method, x="x", lam="lam"):
    if method == "yeo-johnson":
        return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN {lam} = 0 THEN ln({x} + 1.0::DOUBLE) "
                f"ELSE (pow({x} + 1.0::DOUBLE, {lam}) - 1.0::DOUBLE) / {lam} END) "
                f"ELSE (CASE WHEN {lam} = 2 THEN -ln(1.0::DOUBLE - {x}) "
                f"ELSE -(pow(1.0::DOUBLE - {x}, 2.0::DOUBLE - {lam}) - 1.0::DOUBLE) / (2.0::DOUBLE - {lam}) END) END")
    return (f"CASE WHEN {lam} = 0 THEN ln({x}) "
            f"ELSE (pow({x}, {lam}) - 1.0::DOUBLE) / {lam} END")


def power_sql(src, keys, col, method, rounds=5, cands=25, lo=-4.0, hi=4.0):
    extra = ("sign(x) * ln(1.0::DOUBLE + abs(x))" if method == "yeo-johnson" else "ln(x)")
    k = ", ".join(keys)
    ctes = [f"d AS (SELECT {k}, {col}::DOUBLE AS x FROM {src})",
            f"st AS (SELECT count(x)::DOUBLE AS n, sum({extra}) AS s FROM d)",
            f"r0 AS (SELECT {lo!r}::DOUBLE AS lo, ({hi!r}::DOUBLE - {lo!r}::DOUBLE) / {cands - 1}::DOUBLE AS step)"]
    for r in range(rounds):
        ctes.append(f"c{r} AS (SELECT i, lo + i::DOUBLE * step AS lam, step FROM r{r}, range({cands}) t(i))")
        ctes.append(f"w{r} AS (SELECT i, lam, step, var_pop({_psi_sql(method)}) AS v FROM c{r}, d "
                    f"GROUP BY i, lam, step)")
        ctes.append(f"v{r} AS (SELECT w.i, w.lam, w.step, -n / 2.0::DOUBLE * ln(w.v / m.v) "
                    f"+ (w.lam - m.lam) * s AS f FROM w{r} w, st, "
                    f"(SELECT v, lam FROM w{r} WHERE i = {cands // 2}) m WHERE w.v > 0)")
        ctes.append(f"b{r} AS (SELECT i AS bi, lam AS best, step FROM v{r} "
                    f"ORDER BY f DESC, i LIMIT 1)")
        ctes.append(f"r{r + 1} AS (SELECT best - step AS lo, ((best + step) - (best - step)) / "
                    f"{cands - 1}::DOUBLE AS step FROM b{r})")
    last = rounds - 1
    ctes.append(
        f"fin AS (SELECT CASE WHEN lo.f IS NULL OR hi.f IS NULL "
        f"OR NOT 2.0::DOUBLE * (lo.f - 2.0::DOUBLE * m.f + hi.f) < 0 THEN b.best "
        f"ELSE b.best + b.step * (lo.f - hi.f) / (2.0::DOUBLE * (lo.f - 2.0::DOUBLE * m.f + hi.f)) END AS best "
        f"FROM b{last} b JOIN v{last} m ON m.i = b.bi LEFT JOIN v{last} lo ON lo.i = b.bi - 1 "
        f"LEFT JOIN v{last} hi ON hi.i = b.bi + 1)")
    ctes.append(f"t AS (SELECT {k}, {_psi_sql(method, lam='best')} AS t FROM d, fin)")
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT {k}, round((t - avg(t) OVER ()) / stddev_pop(t) OVER (), 3) + 0.0 AS {col} FROM t")


@query("power_yeojohnson", headline=True,
       sql=power_sql("customer", ["c_custkey"], "c_acctbal", "yeo-johnson"))
def power_yeojohnson(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = PowerTransformer(["c_acctbal"]).fit(c).transform(c)
    return out.select("c_custkey", F.round("c_acctbal", L).alias("c_acctbal"))


@query("power_yeojohnson_lineitem",
       sql=power_sql("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                     "l_discount", "yeo-johnson"))
def power_yeojohnson_lineitem(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = table(spark, sf, "lineitem").select(*keys, "l_discount")
    out = PowerTransformer(["l_discount"]).fit(li).transform(li)
    return out.select(*keys, F.round("l_discount", L).alias("l_discount"))


@query("power_boxcox", sql=power_sql("lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                                  "l_suppkey"], "l_extendedprice", "box-cox"))
def power_boxcox(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = table(spark, sf, "lineitem").select(*keys, "l_extendedprice")
    out = PowerTransformer(["l_extendedprice"], method="box-cox").fit(li).transform(li)
    return out.select(*keys, F.round("l_extendedprice", L).alias("l_extendedprice"))


@query("zscore_table", sql="""
WITH s AS (SELECT avg(v) AS m, stddev_samp(v) AS sd FROM (
             SELECT l_discount AS v FROM lineitem UNION ALL SELECT l_tax FROM lineitem))
SELECT l_orderkey, l_linenumber, round((l_discount - m) / sd, 6) AS l_discount,
       round((l_tax - m) / sd, 6) AS l_tax FROM lineitem, s""")
def zscore_table(spark, sf):
    """N8 for the z-score: one mean and one std pooled over both columns."""
    li = table(spark, sf, "lineitem")
    cols = ["l_discount", "l_tax"]
    out = ZScoreScaler(cols, whole_table=True).fit(li).transform(li)
    return _rounded(out, cols, ["l_orderkey", "l_linenumber"])
