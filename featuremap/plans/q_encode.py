"""Catalogue: categorical encoders (E1-E4) and the lookup join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.encode import HashEncoder, LabelEncoder, OneHotEncoder, TargetEncoder
from .registry import query, table

R = 6


def _label_sql(col):
    return f"CAST(dense_rank() OVER (ORDER BY {col}) - 1 AS INTEGER) AS {col}"


@query("label_encode", headline=True, sql=f"""
SELECT o_orderkey, {_label_sql('o_orderpriority')}, {_label_sql('o_orderstatus')}
FROM orders""")
def label_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return LabelEncoder(["o_orderpriority", "o_orderstatus"]).fit(o).transform(o)


@query("label_encode_distributed", sql=f"""
SELECT p_partkey, {_label_sql('p_name')}, {_label_sql('p_brand')} FROM part""")
def label_encode_distributed(spark, sf):
    # collect_limit=0 forces the range-partitioned ranking path used for
    # very high cardinality columns
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return LabelEncoder(["p_name", "p_brand"], collect_limit=0).fit(p).transform(p)


_PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("label_ordered", sql="""
SELECT o_orderkey, CAST(CASE o_orderpriority """ + " ".join(
    f"WHEN '{v}' THEN {i}" for i, v in enumerate(_PRIORITY_ORDER)) + """ END AS INTEGER)
  AS o_orderpriority
FROM orders""")
def label_ordered(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    enc = LabelEncoder(categories={"o_orderpriority": _PRIORITY_ORDER})
    return enc.fit(o).transform(o)


_UNK_SQL = """
WITH codes AS (
  SELECT o_orderstatus AS v, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus <> 'P'))
SELECT o_orderkey, {expr} AS o_orderstatus
FROM orders LEFT JOIN codes ON o_orderstatus = v"""


@query("label_unknown_warn", sql=_UNK_SQL.format(expr="CAST(coalesce(code, -1) AS INTEGER)"))
def label_unknown_warn(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    model = LabelEncoder(["o_orderstatus"], handle_unknown="warn").fit(
        o.where(F.col("o_orderstatus") != "P"))
    return model.transform(o)


@query("label_unknown_ignore", sql=_UNK_SQL.format(expr="code"))
def label_unknown_ignore(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    model = LabelEncoder(["o_orderstatus"], handle_unknown="ignore").fit(
        o.where(F.col("o_orderstatus") != "P"))
    return model.transform(o)


# The five market segments of the customer table, sorted.
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _onehot_sql(col, cats, src, keep):
    cases = ", ".join(f"CAST(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS \"{col}_{v}\""
                      for v in cats)
    return f"SELECT {keep}, {cases} FROM {src}"


@query("onehot", headline=True, sql=_onehot_sql("c_mktsegment", _SEGMENTS, "customer",
                                                "c_custkey, c_acctbal"))
def onehot(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return OneHotEncoder(["c_mktsegment"]).fit(c).transform(c)


@query("onehot_drop_first", sql=_onehot_sql("o_orderstatus", ["O", "P"], "orders", "o_orderkey"))
def onehot_drop_first(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return OneHotEncoder(["o_orderstatus"], drop_first=True).fit(o).transform(o)


@query("onehot_unknown", sql=_onehot_sql(
    "c_mktsegment", _SEGMENTS[:-1],
    "(SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment"
    " FROM customer)", "c_custkey"))
def onehot_unknown(spark, sf):
    # fitted without MACHINERY; negative balances get a NULL segment: both -> zeros
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None))
        .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    model = OneHotEncoder(["c_mktsegment"]).fit(c.where(F.col("c_mktsegment") != "MACHINERY"))
    return model.transform(c)


@query("onehot_sparse", sql="SELECT c_custkey, [" + ", ".join(
    f"CASE WHEN c_mktsegment = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE" for v in _SEGMENTS)
    + "] AS c_mktsegment_vec FROM customer")
def onehot_sparse(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    out = OneHotEncoder(["c_mktsegment"], sparse=True).fit(c).transform(c)
    from pyspark.ml.functions import vector_to_array
    return out.select("c_custkey", vector_to_array("c_mktsegment_vec").alias("c_mktsegment_vec"))


def _target_sql(src, cols, target, smoothing=1.0, min_samples=1, fit_src=None, keep="o_orderkey"):
    fit_src = fit_src or src
    ctes = [f"g AS (SELECT avg({target}) AS gm FROM {fit_src})"]
    sel = [keep]
    joins = []
    for i, c in enumerate(cols):
        ctes.append(
            f"m{i} AS (SELECT {c} AS v, CASE WHEN count({target}) = 0 OR count({target}) < {min_samples} "
            f"THEN gm ELSE (count({target}) * avg({target}) + {smoothing} * gm) / "
            f"(count({target}) + {smoothing}) END AS enc "
            f"FROM {fit_src}, g WHERE {c} IS NOT NULL GROUP BY {c}, gm)")
        joins.append(f"LEFT JOIN m{i} ON s.{c} = m{i}.v")
        sel.append(f"round(CAST(coalesce(m{i}.enc, gm) AS DOUBLE), 6) AS {c}")
    return (f"WITH {', '.join(ctes)}\nSELECT {', '.join(sel)}\nFROM {src} s CROSS JOIN g "
            + " ".join(joins))


def _round_cols(df, cols, keep):
    return df.select(*keep, *[F.round(c, R).alias(c) for c in cols])


_WIDE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {idx} AS l_orderkey_idx
FROM (SELECT *, (dense_rank() OVER (ORDER BY l_orderkey::VARCHAR) - 1)::BIGINT AS code FROM lineitem)"""


def _wide(spark, sf, **options):
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order.key"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    model = OneHotEncoder(["order.key"], sparse=True, sparse_format="indices", **options).fit(li)
    return model.transform(li).withColumnRenamed("order.key_idx", "l_orderkey_idx")


@query("onehot_sparse_wide", sql=_WIDE_SQL.format(idx="[code]"))
def onehot_sparse_wide(spark, sf):
    """As many categories as orders; positions come from a join."""
    return _wide(spark, sf)


@query("onehot_sparse_drop_first", sql=_WIDE_SQL.format(
    idx="CASE WHEN code = 0 THEN []::BIGINT[] ELSE [code - 1] END"))
def onehot_sparse_drop_first(spark, sf):
    return _wide(spark, sf, drop_first=True)


@query("target_encode", headline=True, sql=_target_sql(
    "orders", ["o_orderpriority", "o_orderstatus"], "o_totalprice"))
def target_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus",
                                          "o_totalprice")
    cols = ["o_orderpriority", "o_orderstatus"]
    out = TargetEncoder(cols, target="o_totalprice").fit(o).transform(o)
    return _round_cols(out, cols, ["o_orderkey"])


@query("target_unknown", sql=_target_sql(
    "orders", ["o_orderstatus"], "o_totalprice", smoothing=5.0,
    fit_src="(SELECT * FROM orders WHERE o_orderstatus <> 'P')"))
def target_unknown(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    model = TargetEncoder(["o_orderstatus"], target="o_totalprice", smoothing=5.0,
                          handle_unknown="warn").fit(o.where(F.col("o_orderstatus") != "P"))
    return _round_cols(model.transform(o), ["o_orderstatus"], ["o_orderkey"])


_DOC_SRC = ("(SELECT d.doc_id, d.source, d.lang, CAST(l.quality AS DOUBLE) AS quality "
            "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


@query("target_min_samples", sql=_target_sql(
    _DOC_SRC, ["source", "lang"], "quality", smoothing=10.0, min_samples=5, keep="doc_id"))
def target_min_samples(spark, sf):
    # documents without a label have a NULL target; sources with fewer than
    # five labelled documents fall back to the global mean
    d = (table(spark, sf, "documents").select("doc_id", "source", "lang")
         .join(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double")),
               "doc_id", "left"))
    cols = ["source", "lang"]
    out = TargetEncoder(cols, target="quality", smoothing=10.0, min_samples=5).fit(d).transform(d)
    return _round_cols(out, cols, ["doc_id"])


def _hash_sql(col, i, n, signed=False):
    e = f"CAST(('0x' || md5('{col}_{i}_' || {col}))::UHUGEINT % {n} AS INTEGER)"
    if signed:
        e = f"CAST({e} - {n // 2} AS INTEGER)"
    return f"CASE WHEN {col} IS NULL THEN 0 ELSE {e} END AS {col}_hash_{i}"


@query("hash_encode", headline=True, sql="SELECT p_partkey, p_type, " + ", ".join(
    _hash_sql("p_brand", i, 8) for i in range(3)) + " FROM part")
def hash_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    return HashEncoder(["p_brand"], n_bins=8, n_functions=3).transform(p)


@query("hash_signed", sql="SELECT page_id, " + ", ".join(
    _hash_sql("url", i, 1000, signed=True) for i in range(2)) + " FROM pages")
def hash_signed(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return HashEncoder(["url"], n_bins=1000, n_functions=2, signed=True).transform(p)


def _dotted_sql(i):
    e = f"CAST(('0x' || md5('part.brand_{i}_' || p_brand))::UHUGEINT % 8 AS INTEGER)"
    return f"CASE WHEN p_brand IS NULL THEN 0 ELSE {e} END AS brand_{i}"


@query("hash_dotted_name", sql=f"SELECT p_partkey, {_dotted_sql(0)}, {_dotted_sql(1)} FROM part")
def hash_dotted_name(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("part.brand"))
    out = HashEncoder(["part.brand"], n_bins=8, n_functions=2).transform(p)
    return out.toDF("p_partkey", "brand_0", "brand_1")


@query("hash_xxhash64")
def hash_xxhash64(spark, sf):
    """E4s with a caller-chosen hash (xxhash64); no SQL twin of Spark's xxhash64."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return HashEncoder(["p_name"], n_bins=32, n_functions=2, hash="xxhash64").transform(p)
