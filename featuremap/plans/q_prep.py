"""Catalogue: profiling (I1-I3) and column preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.prep import (AutoPrep, MedianImputer, ModeImputer, bands, clip,
                              drop_id_columns, select_by_type)
from ..operators.profile import describe, head, inspect
from .registry import query, table

R = 6

_TYPE_SQL = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END")


@query("inspect_profile", sql=f"""
SELECT column_name, {_TYPE_SQL} AS data_type,
       CAST(row_number() OVER () AS INTEGER) AS ordinal,
       (SELECT count(*) FROM orders) AS n_rows,
       CAST(count(*) OVER () AS INTEGER) AS n_columns
FROM (DESCRIBE orders)""")
def inspect_profile(spark, sf):
    return inspect(table(spark, sf, "orders"))


@query("inspect_head", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def inspect_head(spark, sf):
    return head(table(spark, sf, "orders"), 5, ["o_orderkey"])


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, "
    f"round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
    f"round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem"
    for c in _DESC_COLS))
def describe_numeric(spark, sf):
    d = describe(table(spark, sf, "lineitem").select(*_DESC_COLS))
    stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return d.select("column", "count", *[F.round(s, 4).alias(s) for s in stats])  # X12


@query("drop_id_columns", sql="SELECT ts, event_type, value, props FROM events")
def drop_id_columns_q(spark, sf):
    return drop_id_columns(table(spark, sf, "events"))


@query("select_by_type", sql="SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def select_by_type_q(spark, sf):
    return select_by_type(table(spark, sf, "customer"), "numeric")


@query("select_categorical", sql="SELECT ts, event_type, props FROM events")
def select_categorical(spark, sf):
    return select_by_type(table(spark, sf, "events"), "categorical")


_Q_NULL = "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END"


@query("clip", sql=f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN q IS NULL THEN NULL ELSE greatest(5.0, least(45.0, q)) END AS l_quantity,
  greatest(0.02, least(0.08, l_discount)) AS l_discount
FROM (SELECT *, {_Q_NULL} AS q FROM lineitem)""")
def clip_q(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "l_quantity", F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity")))
    return li.select("l_orderkey", "l_linenumber", clip("l_quantity", 5.0, 45.0).alias("l_quantity"),
                     clip("l_discount", 0.02, 0.08).alias("l_discount"))


@query("bucket_case", sql="""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'mid'
                       ELSE 'high' END AS balance_band FROM customer""")
def bucket_case(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", bands("c_acctbal", [(0, "negative"), (5000, "mid")], "high")
                    .alias("balance_band"))


_IMP_SRC = ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS l_quantity, "
            "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_extendedprice END AS l_extendedprice "
            "FROM lineitem")


@query("impute_median", sql=f"""
WITH t AS ({_IMP_SRC}), m AS (SELECT median(l_quantity) AS mq, median(l_extendedprice) AS mp FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_quantity, mq) AS l_quantity,
       round(coalesce(l_extendedprice, mp), 6) AS l_extendedprice FROM t, m""")
def impute_median(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity"))
        .alias("l_quantity"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"))
    out = MedianImputer(["l_quantity", "l_extendedprice"]).fit(li).transform(li)
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", R))


@query("impute_mode", sql="""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS p,
                  CASE WHEN o_totalprice > 100000 THEN NULL ELSE o_orderstatus END AS s FROM orders),
mp AS (SELECT p AS v FROM t WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1),
ms AS (SELECT s AS v FROM t WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)
SELECT o_orderkey, coalesce(p, mp.v) AS o_orderpriority, coalesce(s, ms.v) AS o_orderstatus
FROM t, mp, ms""")
def impute_mode(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.when(F.col("o_totalprice") > 100000, F.lit(None)).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"))
    return ModeImputer(["o_orderpriority", "o_orderstatus"]).fit(o).transform(o)


# X16 on customers: no column name contains "id", so all five are features;
# c_name and c_mktsegment are label-coded, then every column is robust-scaled.
_AUTO_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _robust_sql(c):
    return (f"CASE WHEN quantile_cont({c}, 0.75) OVER () = quantile_cont({c}, 0.25) OVER () "
            f"THEN 0.0 ELSE round(({c} - median({c}) OVER ()) / (quantile_cont({c}, 0.75) OVER () "
            f"- quantile_cont({c}, 0.25) OVER ()), 6) END AS {c}")


@query("auto_prep", sql="""
WITH coded AS (
  SELECT c_custkey::DOUBLE AS c_custkey, (dense_rank() OVER (ORDER BY c_name) - 1)::DOUBLE AS c_name,
         c_nationkey::DOUBLE AS c_nationkey, c_acctbal,
         (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS c_mktsegment
  FROM customer)
SELECT """ + ", ".join(_robust_sql(c) for c in _AUTO_COLS) + " FROM coded")
def auto_prep(spark, sf):
    c = table(spark, sf, "customer").select(*_AUTO_COLS)
    out = AutoPrep().fit(c).transform(c)
    return out.select(*[F.round(x, R).alias(x) for x in _AUTO_COLS])
