"""Catalogue: sources, sinks and pipeline composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.base import IdentityStage
from ..operators.scale import MinMaxScaler, ZScoreScaler
from ..session import scratch_path
from ..sources import (CSVDestination, CSVSource, ExcelDestination, ExcelSource,
                       JSONArrayDestination, JSONArraySource, JSONDestination, JSONSource, ParquetSource)
from .flow import Pipeline, SOMStage
from .q_som import CUST, CUST_EPOCHS, CUST_FEATS, cust_sql, customer_features
from .registry import query, table

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDERS_SQL = "SELECT " + ", ".join(_ORDER_COLS) + " FROM orders"


@query("csv_roundtrip", sql="""
SELECT o_orderkey, o_custkey::INTEGER AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders""")
def csv_roundtrip(spark, sf):
    # written twice to the same place: the second write must overwrite (K4)
    path = scratch_path(spark, "csv")
    o = table(spark, sf, "orders").select(*_ORDER_COLS)
    CSVDestination(path).save(o.where(F.col("o_orderstatus") == "F"))
    CSVDestination(path).save(o)
    # inferred types, with one forced type
    return CSVSource(path, schema_overrides={"o_custkey": "int"}).extract(spark)


@query("json_roundtrip", sql=_ORDERS_SQL)
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    JSONDestination(path).save(table(spark, sf, "orders").select(*_ORDER_COLS))
    return JSONSource(path, lines=True).extract(spark).select(*_ORDER_COLS)


@query("json_array_roundtrip", sql=_ORDERS_SQL)
def json_array_roundtrip(spark, sf):
    path = scratch_path(spark, "json-array-out")
    JSONArrayDestination(path).save(table(spark, sf, "orders").select(*_ORDER_COLS))
    return JSONArraySource(path).extract(spark).select(*_ORDER_COLS)


@query("csv_columns", sql="""
SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_quantity FROM lineitem""")
def csv_columns(spark, sf):
    # files without a header; named, chosen and dated on reading
    path = scratch_path(spark, "csv-bare")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                               F.col("l_shipdate").cast("string").alias("l_shipdate"))
    CSVDestination(path, header=False).save(rows)
    return CSVSource(path, header=False, names=rows.columns, dates=["l_shipdate"],
                     columns=["l_orderkey", "l_shipdate", "l_quantity"]).extract(spark)


@query("xlsx_roundtrip", sql="SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def xlsx_roundtrip(spark, sf):
    path = scratch_path(spark, "xlsx")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    ExcelDestination(path, sheet_name="Customers").save(c.repartition(4))
    return ExcelSource(path, sheet_name="Customers").extract(spark)


@query("stage_identity", sql=_ORDERS_SQL)
def stage_identity(spark, sf):
    path = f"{sf.rstrip('/')}/orders.parquet"
    p = Pipeline().extract_from(ParquetSource(path)).add_transformer(IdentityStage())
    return p.run(spark).select(*_ORDER_COLS)


@query("stage_chain", sql="""
WITH a AS (SELECT o_orderkey, (o_totalprice - min(o_totalprice) OVER ()) /
                  (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) AS p FROM orders)
SELECT o_orderkey, round((p - avg(p) OVER ()) / stddev_samp(p) OVER (), 6) AS o_totalprice FROM a""")
def stage_chain(spark, sf):
    # the z-score is fitted on the min-max output of the first stage
    src = ParquetSource(f"{sf.rstrip('/')}/orders.parquet")
    p = Pipeline(src, stages=[lambda df: df.select("o_orderkey", "o_totalprice"),
                              MinMaxScaler(["o_totalprice"]), ZScoreScaler(["o_totalprice"])])
    out = p.run(spark)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"))


def price_in_thousands(df):
    """A user-defined stage: a plain function."""
    return df.withColumn("o_totalprice_k", F.col("o_totalprice") / 1000.0)


@query("custom_stage", sql="""
SELECT o_orderkey, o_totalprice, o_totalprice / 1000.0::DOUBLE AS o_totalprice_k FROM orders""")
def custom_stage(spark, sf):
    src = ParquetSource(f"{sf.rstrip('/')}/orders.parquet")
    p = Pipeline(src).add_transformer(lambda df: df.select("o_orderkey", "o_totalprice")) \
        .add_transformer(price_in_thousands)
    return p.run(spark)


@query("stage_new_data", sql="""
WITH f AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders
           WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, round((o_totalprice - mn) / (mx - mn), 6) AS o_totalprice FROM orders, f""")
def stage_new_data(spark, sf):
    """Fit a pipeline on one slice, then apply the fitted stages to all rows."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    p = Pipeline(stages=[MinMaxScaler(["o_totalprice"])])
    model = p.fit(o.where(F.col("o_orderpriority") == "1-URGENT"))
    out = model.transform(o)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"))


@query("som_pipeline_stage", sql=cust_sql() + f"""
SELECT c_custkey, nx AS som_x, ny AS som_y FROM a{CUST_EPOCHS} WHERE rn = 1""")
def som_pipeline_stage(spark, sf):
    rows = customer_features(spark, sf)
    stage = SOMStage((CUST["x"], CUST["y"]), epochs=CUST_EPOCHS, features=CUST_FEATS, tol=0,
                     initialization="grid",
                     **{k: v for k, v in CUST.items() if k not in ("x", "y")})
    out = Pipeline(stages=[stage]).fit(rows).transform(rows)
    return out.select("c_custkey", "som_x", "som_y")
