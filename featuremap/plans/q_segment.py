"""Catalogue: segmentation and the relational operators of the driver
scripts (G1-G6, M22, J1, U1, O1, O2, A1, A2, X9-X14)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.auto import auto_segment
from ..operators.joins import left_join_hot_right
from ..operators.kmeans import KMeans
from ..operators.prep import bands, with_share
from ..operators.segment import SEGMENT_LOOKUP, cluster_codebook, elbow, label_rows, lookup_table, profile
from ..operators.som import default_grid_size
from ..session import scratch_path
from ..sources.files import ParquetDestination
from .kmeans_sql import kmeans_ctes
from .q_som import (CUST_EPOCHS, CUST_SRC, CUST_FEATS, LINE_EPOCHS, cust_model, cust_sql,
                    customer_features, line_model, line_sql)
from .registry import query, table

R = 6


def _line_assigned(spark, sf):
    rows, model = line_model(spark, sf)
    return model.transform(rows), model


@query("top_neurons", sql=line_sql() + f"""
SELECT nx AS neuron_x, ny AS neuron_y, count(*) AS hits FROM a{LINE_EPOCHS} WHERE rn = 1
GROUP BY nx, ny ORDER BY hits DESC, nx, ny LIMIT 10""")
def top_neurons(spark, sf):
    a, _ = _line_assigned(spark, sf)
    return (a.groupBy("neuron_x", "neuron_y").agg(F.count(F.lit(1)).alias("hits"))
            .orderBy(F.desc("hits"), "neuron_x", "neuron_y").limit(10))


@query("dense_neurons", sql=line_sql() + f"""
SELECT nx AS neuron_x, ny AS neuron_y, count(*) AS hits FROM a{LINE_EPOCHS} WHERE rn = 1
GROUP BY nx, ny HAVING count(*) > 0.04::DOUBLE * (SELECT count(*) FROM src)""")
def dense_neurons(spark, sf):
    a, _ = _line_assigned(spark, sf)
    return (a.groupBy("neuron_x", "neuron_y").agg(F.count(F.lit(1)).alias("hits"))
            .withColumn("__all", F.sum("hits").over(Window.partitionBy()))      # one row a neuron
            .where(F.col("hits") > F.lit(0.04) * F.col("__all")).drop("__all"))


@query("value_counts", sql="""
SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY c_mktsegment
ORDER BY count DESC, c_mktsegment""")
def value_counts(spark, sf):
    c = table(spark, sf, "customer")
    return (c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "c_mktsegment"))


@query("node_filter", sql=line_sql() + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM a{LINE_EPOCHS}
WHERE rn = 1 AND nx = 2 AND ny = 5""")
def node_filter(spark, sf):
    a, _ = _line_assigned(spark, sf)
    return (a.where((F.col("neuron_x") == 2) & (F.col("neuron_y") == 5))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


_BAND_SQL = "CASE WHEN nx < 2 THEN 'low' WHEN nx < 4 THEN 'mid' ELSE 'high' END"


@query("band_profile", sql=cust_sql() + f"""
, g AS (SELECT {_BAND_SQL} AS band, count(*) AS count, avg(c_acctbal) AS a1, avg(total_spent) AS a2
        FROM a{CUST_EPOCHS} JOIN src USING (c_custkey, c_mktsegment) WHERE rn = 1 GROUP BY 1)
SELECT band, count, round(count * 100.0 / sum(count) OVER (), 6) AS percent,
       round(a1, 6) AS avg_c_acctbal, round(a2, 6) AS avg_total_spent FROM g""")
def band_profile(spark, sf):
    rows, model = cust_model(spark, sf)
    a = model.transform(rows).withColumn(
        "band", bands("neuron_x", [(2, "low"), (4, "mid")], "high"))
    g = (a.groupBy("band").agg(F.count(F.lit(1)).alias("count"),
                               F.avg("c_acctbal").alias("avg_c_acctbal"),
                               F.avg("total_spent").alias("avg_total_spent")))
    g = with_share(g, "count", "percent")
    return g.select("band", "count", *[F.round(c, R).alias(c) for c in
                                       ("percent", "avg_c_acctbal", "avg_total_spent")])


# k-means over the codebook, each neuron weighted by its rows
_CODEBOOK_SQL = line_sql().rstrip() + f""",
kz AS (SELECT nx || '-' || ny AS key, coalesce(n, 0)::DOUBLE AS w, nx, ny, w0 AS z0, w1 AS z1, w2 AS z2, w3 AS z3
       FROM cb{LINE_EPOCHS} LEFT JOIN (SELECT nx, ny, count(*) AS n FROM a{LINE_EPOCHS} WHERE rn = 1 GROUP BY nx, ny)
       USING (nx, ny)),
"""


def _codebook_and_hits(spark, sf):
    rows, model = line_model(spark, sf)
    hits = model.transform(rows).groupBy("neuron_x", "neuron_y").agg(F.count(F.lit(1)).alias("hits"))
    return model.codebook_df(spark), hits


@query("segment_kmeans", sql=_CODEBOOK_SQL + kmeans_ctes(4, [5]) + """
SELECT nx AS neuron_x, ny AS neuron_y, fin.c::INTEGER AS segment FROM fin JOIN kz USING (key)""")
def segment_kmeans(spark, sf):
    codebook, hits = _codebook_and_hits(spark, sf)
    return cluster_codebook(codebook, k=5, seed=42, hits=hits)[0]


@query("segment_elbow", sql=_CODEBOOK_SQL + kmeans_ctes(4, list(range(2, 10))) + """
SELECT k::INTEGER AS k, round(sum(w * d2), 6) AS inertia FROM fin GROUP BY k""")
def segment_elbow(spark, sf):
    codebook, hits = _codebook_and_hits(spark, sf)
    return elbow(codebook, range(2, 10), hits=hits).withColumn("inertia", F.round("inertia", R))


# k-means over the rows themselves: customers in thousands of currency, weighted by orders
_ROWS_SQL = f"""WITH kz AS (SELECT c_custkey::VARCHAR AS key, n_orders::DOUBLE AS w, c_custkey,
  c_acctbal / 1000.0::DOUBLE AS z0, total_spent / 1000000.0::DOUBLE AS z1 FROM ({CUST_SRC})),
"""


def _customer_kmeans(spark, sf, ks):
    rows = customer_features(spark, sf).select(
        "c_custkey", "n_orders", (F.col("c_acctbal") / 1000.0).alias("balance.k"),
        (F.col("total_spent") / 1000000.0).alias("spent"))
    return rows, KMeans(["balance.k", "spent"], key="c_custkey", weight="n_orders", ks=ks, iterations=6).fit(rows)


@query("kmeans_rows", sql=_ROWS_SQL + kmeans_ctes(2, [4], iterations=6) + """
SELECT c_custkey, c::INTEGER AS segment FROM fin JOIN kz USING (key)""")
def kmeans_rows(spark, sf):
    rows, model = _customer_kmeans(spark, sf, [4])
    return model.transform(rows).select("c_custkey", "segment")


@query("kmeans_rows_elbow", sql=_ROWS_SQL + kmeans_ctes(2, list(range(2, 10)), iterations=6) + """
SELECT k::INTEGER AS k, round(sum(w * d2), 6) AS inertia FROM fin GROUP BY k""")
def kmeans_rows_elbow(spark, sf):
    rows, model = _customer_kmeans(spark, sf, list(range(2, 10)))
    return model.elbow(rows).withColumn("inertia", F.round("inertia", R))


# the fixed neuron -> segment rule used by the lookup and profile queries
_SEG_SQL = "nx + CASE WHEN ny >= 3 THEN 1 ELSE 0 END"
_LOOKUP_SQL = "lk(segment, name, strategy, budget) AS (VALUES " + ", ".join(
    "(" + ", ".join([str(r[0])] + ["'" + v.replace("'", "''") + "'" for v in r[1:]]) + ")"
    for r in SEGMENT_LOOKUP) + ")"


def _segmented(spark, sf):
    rows, model = cust_model(spark, sf)
    grid = model.codebook_df(spark).select(
        "neuron_x", "neuron_y",
        (F.col("neuron_x") + F.when(F.col("neuron_y") >= 3, 1).otherwise(0)).alias("segment"))
    return label_rows(model.transform(rows), grid)


@query("segment_lookup", sql=cust_sql() + f""", {_LOOKUP_SQL}
SELECT c_custkey, ({_SEG_SQL})::INTEGER AS segment,
       coalesce(lk.name, 'Segment ' || ({_SEG_SQL})) AS name, lk.strategy
FROM a{CUST_EPOCHS} LEFT JOIN lk ON lk.segment = {_SEG_SQL} WHERE rn = 1""")
def segment_lookup(spark, sf):
    lab = _segmented(spark, sf)
    lk = lookup_table(spark)
    out = lab.join(lk, "segment", "left").withColumn(
        "name", F.coalesce("name", F.concat(F.lit("Segment "), F.col("segment").cast("string"))))
    return out.select("c_custkey", "segment", "name", "strategy")


@query("segment_profile", sql=cust_sql() + f""", {_LOOKUP_SQL},
g AS (SELECT ({_SEG_SQL})::INTEGER AS segment, count(*) AS count, avg(c_acctbal) AS a1,
             avg(n_orders) AS a2, avg(total_spent) AS a3
      FROM a{CUST_EPOCHS} JOIN src USING (c_custkey, c_mktsegment) WHERE rn = 1 GROUP BY 1)
SELECT g.segment, count, round(count * 100.0 / sum(count) OVER (), 6) AS percent,
       round(a1, 6) AS avg_c_acctbal, round(a2, 6) AS avg_n_orders, round(a3, 6) AS avg_total_spent,
       coalesce(lk.name, 'Segment ' || g.segment) AS name, lk.strategy, lk.budget
FROM g LEFT JOIN lk ON lk.segment = g.segment""")
def segment_profile(spark, sf):
    lab = _segmented(spark, sf)
    p = profile(lab, "segment", CUST_FEATS, lookup_table(spark))
    return p.select("segment", "count", *[F.round(c, R).alias(c) for c in
                                          ("percent", "avg_c_acctbal", "avg_n_orders",
                                           "avg_total_spent")], "name", "strategy", "budget")


@query("customer_orders_left", sql="""
SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def customer_orders_left(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return (left_join_hot_right(c, o, "c_custkey", "o_custkey")
            .select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice"))


@query("concat_rows", sql="""
SELECT c_custkey AS party_key, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS kind
FROM customer
UNION ALL
SELECT s_suppkey, s_nationkey, s_acctbal, 'supplier' FROM supplier""")
def concat_rows(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("kind"))
    return c.unionByName(s)


# ---------------------------------------------------------------- G6 / M22
_AUTO_EPOCHS = 5
_AUTO_FEATS = ["c_mktsegment", "c_acctbal", "n_orders", "total_spent"]


def _auto_src_sql():
    def rob(c):
        return (f"CASE WHEN quantile_cont({c}, 0.75) OVER () = quantile_cont({c}, 0.25) OVER () "
                f"THEN 0.0::DOUBLE ELSE ({c} - median({c}) OVER ()) / (quantile_cont({c}, 0.75) OVER () "
                f"- quantile_cont({c}, 0.25) OVER ()) END AS {c}")
    coded = ("SELECT c_custkey AS customer_id, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE "
             "AS c_mktsegment, c_acctbal, n_orders::DOUBLE AS n_orders, total_spent "
             f"FROM ({CUST_SRC})")
    return f"SELECT customer_id, {', '.join(rob(c) for c in _AUTO_FEATS)} FROM ({coded})"


def _auto_sql():
    from .som_sql import som_ctes
    # the size rule gives a 15 x 15 map for every table of 900 customers or
    # more (all scale factors from 0.01 up), so the oracle fixes that size
    side, sigma = default_grid_size(1500)
    return som_ctes(_auto_src_sql(), ["customer_id"], _AUTO_FEATS, side, side, _AUTO_EPOCHS,
                    sigma, 0.5, "gaussian", "asymptotic")


def auto_segmentation_df(spark, sf, epochs=_AUTO_EPOCHS):
    """read -> automatic preparation -> grid-size rule -> train -> label rows."""
    base = customer_features(spark, sf).withColumnRenamed("c_custkey", "customer_id") \
        .select("customer_id", *_AUTO_FEATS)
    return auto_segment(base, epochs=epochs).rows.select(
        "customer_id", "som_group_x", "som_group_y", "som_cluster")


@query("auto_segmentation", headline=True, sql=_auto_sql() + f"""
SELECT customer_id, nx AS som_group_x, ny AS som_group_y, nx || '-' || ny AS som_cluster
FROM a{_AUTO_EPOCHS} WHERE rn = 1""")
def auto_segmentation(spark, sf):
    return auto_segmentation_df(spark, sf)


@query("auto_segmentation_rows", sql=_auto_sql() + f"""
SELECT f.c_custkey AS customer_id, f.c_mktsegment, f.c_acctbal, f.n_orders, f.total_spent,
       a.nx || '-' || a.ny AS som_cluster
FROM a{_AUTO_EPOCHS} a JOIN ({CUST_SRC}) f ON a.customer_id = f.c_custkey WHERE a.rn = 1""")
def auto_segmentation_rows(spark, sf):
    """The library call keeps every input column as it was."""
    base = customer_features(spark, sf).withColumnRenamed("c_custkey", "customer_id") \
        .select("customer_id", *_AUTO_FEATS)
    return auto_segment(base, epochs=_AUTO_EPOCHS).rows.drop("som_group_x", "som_group_y")


@query("auto_segmentation_saved", sql=_auto_sql() + f"""
SELECT f.c_custkey AS customer_id, f.c_mktsegment, f.c_acctbal, f.n_orders, f.total_spent,
       a.nx || '-' || a.ny AS som_cluster
FROM a{_AUTO_EPOCHS} a JOIN ({CUST_SRC}) f ON a.customer_id = f.c_custkey WHERE a.rn = 1""")
def auto_segmentation_saved(spark, sf):
    """Labelled, measured and written in one scoring pass; read back from the files."""
    base = customer_features(spark, sf).withColumnRenamed("c_custkey", "customer_id") \
        .select("customer_id", *_AUTO_FEATS)
    path = scratch_path(spark, "segments")
    auto_segment(base, epochs=_AUTO_EPOCHS, destination=ParquetDestination(path))
    return spark.read.parquet(path).drop("som_group_x", "som_group_y")
