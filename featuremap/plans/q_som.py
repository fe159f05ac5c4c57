"""Catalogue: self-organizing map training, scoring and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.som import SOM, SOMModel
from ..operators.som import quality as Q
from ..session import scratch_path
from .registry import query, table
from .som_sql import pca_start, som_ctes

R = 6

# ---- lineitem map: 4 features, non-square 4 x 7 grid (guards the x/y order)
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE = dict(x=4, y=7, sigma=1.5, learning_rate=0.5, neighborhood_function="gaussian",
            decay_function="asymptotic")
LINE_SRC = f"SELECT {', '.join(LINE_KEYS + LINE_FEATS)} FROM lineitem"
LINE_EPOCHS = 2


def line_sql(epochs=LINE_EPOCHS, second=False):
    return som_ctes(LINE_SRC, LINE_KEYS, LINE_FEATS, LINE["x"], LINE["y"], epochs,
                    LINE["sigma"], LINE["learning_rate"], LINE["neighborhood_function"],
                    LINE["decay_function"], second=second)


def line_rows(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE_KEYS, *LINE_FEATS)


def line_model(spark, sf, epochs=LINE_EPOCHS):
    rows = line_rows(spark, sf)
    model = SOM(features=LINE_FEATS, epochs=epochs, tol=0, initialization="grid",
                **LINE).fit(rows)
    return rows, model


# ---- customer map: balance and order history (customer LEFT JOIN orders)
CUST_FEATS = ["c_acctbal", "n_orders", "total_spent"]
CUST = dict(x=5, y=5, sigma=2.0, learning_rate=1.0, neighborhood_function="gaussian",
            decay_function="asymptotic")
CUST_EPOCHS = 3
CUST_SRC = """SELECT c_custkey, c_mktsegment, c_acctbal,
  coalesce(n, 0)::BIGINT AS n_orders, coalesce(round(spent, 2), 0.0)::DOUBLE AS total_spent
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spent
                         FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey"""


def customer_features(spark, sf):
    """Per-customer features: orders are pre-aggregated on the join key before
    the left join, so the join sees one row per customer on both sides."""
    per = (table(spark, sf, "orders").groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spent")))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return (c.join(per, c.c_custkey == per.o_custkey, "left")
            .select("c_custkey", "c_mktsegment", "c_acctbal",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"),
                    F.coalesce(F.round("spent", 2), F.lit(0.0)).cast("double").alias("total_spent")))


def cust_sql(epochs=CUST_EPOCHS, **over):
    p = dict(CUST, **over)
    return som_ctes(CUST_SRC, ["c_custkey", "c_mktsegment"], CUST_FEATS, p["x"], p["y"], epochs,
                    p["sigma"], p["learning_rate"], p["neighborhood_function"],
                    p["decay_function"])


def cust_model(spark, sf, epochs=CUST_EPOCHS, **over):
    rows = customer_features(spark, sf)
    model = SOM(features=CUST_FEATS, epochs=epochs, tol=0, initialization="grid",
                **dict(CUST, **over)).fit(rows)
    return rows, model


def _w_cols(model, prefix="w"):
    return [F.round(F.col("weights")[i], R).alias(f"{prefix}{i}") for i in range(model.d)]


# ------------------------------------------------------------------ scoring
@query("som_assign", sql=line_sql(0) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nx AS neuron_x, ny AS neuron_y FROM a0 WHERE rn = 1""")
def som_assign(spark, sf):
    rows, model = line_model(spark, sf, epochs=0)
    return model.transform(rows).select(*LINE_KEYS, "neuron_x", "neuron_y")


@query("som_assign_dotted", sql=line_sql(1) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nx AS neuron_x, ny AS neuron_y FROM a1 WHERE rn = 1""")
def som_assign_dotted(spark, sf):
    """Feature names with dots, as the CSV source yields them."""
    rows = line_rows(spark, sf).withColumnsRenamed({c: c.replace("l_", "line.") for c in LINE_FEATS})
    model = SOM(features=[c.replace("l_", "line.") for c in LINE_FEATS], epochs=1, tol=0,
                initialization="grid", **LINE).fit(rows)
    return model.transform(rows).select(*LINE_KEYS, "neuron_x", "neuron_y")


@query("som_predict", headline=True, sql=line_sql() + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nx AS neuron_x, ny AS neuron_y, round(dist, 6) AS distance
FROM a{LINE_EPOCHS} WHERE rn = 1""")
def som_predict(spark, sf):
    rows, model = line_model(spark, sf)
    return (model.predict(rows)
            .select(*LINE_KEYS, "neuron_x", "neuron_y", F.round("distance", R).alias("distance")))


@query("som_node_data", sql=line_sql() + f"""
SELECT s.* FROM src s JOIN a{LINE_EPOCHS} a USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
WHERE a.rn = 1 AND a.nx = 1 AND a.ny = 3""")
def som_node_data(spark, sf):
    rows, model = line_model(spark, sf)
    return model.node_data(rows, 1, 3).drop("neuron_x", "neuron_y")


@query("som_save_load", sql=line_sql() + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nx AS neuron_x, ny AS neuron_y FROM a{LINE_EPOCHS} WHERE rn = 1""")
def som_save_load(spark, sf):
    rows, model = line_model(spark, sf)
    path = scratch_path(spark, "som-model")
    model.save(path)
    loaded = SOMModel.load(spark, path)
    return loaded.transform(rows).select(*LINE_KEYS, "neuron_x", "neuron_y")


# ------------------------------------------------------------------ training
@query("som_train_epochs", headline=True, sql=cust_sql() + f"""
SELECT nx AS neuron_x, ny AS neuron_y, """ + ", ".join(
    f"round(w{i}, 6) + 0.0 AS w{i}" for i in range(3)) + f" FROM cb{CUST_EPOCHS}")
def som_train_epochs(spark, sf):
    _, model = cust_model(spark, sf)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *_w_cols(model))


_HIST = dict(neighborhood_function="bubble", decay_function="linear", sigma=2.5)


@query("som_history", sql=cust_sql(**_HIST) + " UNION ALL ".join(
    f"SELECT {e}::INTEGER AS epoch, round(avg(dist), 6) AS qe FROM a{e} WHERE rn = 1"
    for e in range(CUST_EPOCHS)))
def som_history(spark, sf):
    _, model = cust_model(spark, sf, **_HIST)
    return model.history_df(spark).select("epoch", F.round("qe", R).alias("qe"))


_HAT = dict(neighborhood_function="mexican_hat", decay_function="exponential", sigma=1.5)


@query("som_train_mexican_hat", sql=cust_sql(**_HAT) + f"""
SELECT nx AS neuron_x, ny AS neuron_y, """ + ", ".join(
    f"round(w{i}, 6) + 0.0 AS w{i}" for i in range(3)) + f" FROM cb{CUST_EPOCHS}")
def som_train_mexican_hat(spark, sf):
    _, model = cust_model(spark, sf, **_HAT)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *_w_cols(model))


_TRI = dict(neighborhood_function="triangle", decay_function="inverse", sigma=2.0)


@query("som_train_triangle", sql=cust_sql(**_TRI) + f"""
SELECT nx AS neuron_x, ny AS neuron_y, """ + ", ".join(
    f"round(w{i}, 6) + 0.0 AS w{i}" for i in range(3)) + f" FROM cb{CUST_EPOCHS}")
def som_train_triangle(spark, sf):
    _, model = cust_model(spark, sf, **_TRI)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *_w_cols(model))


@query("som_init_sample", sql=cust_sql(0).rstrip() + f""",
pick AS (SELECT row_number() OVER (ORDER BY md5(c_custkey || ':42'), {", ".join(f"z{i}" for i in range(3))}) - 1 AS k,
                {", ".join(f"z{i}" for i in range(3))} FROM z)
SELECT (k // {CUST["y"]})::INTEGER AS neuron_x, (k % {CUST["y"]})::INTEGER AS neuron_y,
       {", ".join(f"round(z{i}, 6) + 0.0 AS w{i}" for i in range(3))}
FROM pick WHERE k < {CUST["x"] * CUST["y"]}""")
def som_init_sample(spark, sf):
    rows = customer_features(spark, sf)
    model = SOM(features=CUST_FEATS, epochs=0, initialization="random", init_key="c_custkey",
                random_seed=42, **CUST).fit(rows)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *_w_cols(model))


@query("som_init_pca", sql=som_ctes(
    CUST_SRC, ["c_custkey", "c_mktsegment"], CUST_FEATS, CUST["x"], CUST["y"], 2, CUST["sigma"],
    CUST["learning_rate"], start=pca_start(3, CUST["x"], CUST["y"])) + """
SELECT nx AS neuron_x, ny AS neuron_y, """ + ", ".join(f"round(w{i}, 6) AS w{i}" for i in range(3)) + " FROM cb2")
def som_init_pca(spark, sf):
    rows = customer_features(spark, sf)
    model = SOM(features=CUST_FEATS, epochs=2, tol=0, initialization="pca", **CUST).fit(rows)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *_w_cols(model))


@query("som_embeddings")
def som_embeddings(spark, sf):
    """Array features: a 6 x 6 map over the 64-dimensional embedding vectors."""
    e = table(spark, sf, "embeddings")
    model = SOM(6, 6, vector_col="embedding", epochs=5, sigma=1.5, learning_rate=0.5,
                initialization="random").fit(e)
    return Q.label_hits(model.transform(e), "label")


# ------------------------------------------------------------------ codebook views
@query("som_planes", sql=line_sql() + " UNION ALL ".join(
    f"SELECT nx AS neuron_x, ny AS neuron_y, '{f}' AS feature, round(w{i}, 6) AS value "
    f"FROM cb{LINE_EPOCHS}" for i, f in enumerate(LINE_FEATS)))
def som_planes(spark, sf):
    _, model = line_model(spark, sf)
    return model.component_planes(spark).withColumn("value", F.round("value", R))


@query("som_codebook_units", sql=line_sql() + " UNION ALL ".join(
    f"SELECT nx AS neuron_x, ny AS neuron_y, '{f}' AS feature, "
    f"round(w{i} * (CASE WHEN mx{i} - mn{i} = 0 THEN 1.0::DOUBLE ELSE mx{i} - mn{i} END) + mn{i}, 6)"
    f" AS value FROM cb{LINE_EPOCHS}, b" for i, f in enumerate(LINE_FEATS)))
def som_codebook_units(spark, sf):
    _, model = line_model(spark, sf)
    return (model.component_planes(spark, original_units=True)
            .withColumn("value", F.round("value", R)))


_U_SQL = f"""
, pairs AS (
  SELECT a.nx, a.ny, sqrt(""" + " + ".join(
    f"(a.w{i} - b.w{i}) * (a.w{i} - b.w{i})" for i in range(len(LINE_FEATS))) + f""") AS d
  FROM cb{LINE_EPOCHS} a JOIN cb{LINE_EPOCHS} b
    ON abs(a.nx - b.nx) <= 1 AND abs(a.ny - b.ny) <= 1 AND NOT (a.nx = b.nx AND a.ny = b.ny)),
u AS (SELECT nx, ny, sum(d) AS u_sum, avg(d) AS u_mean FROM pairs GROUP BY nx, ny),
um AS (SELECT u.*, u_sum / max(u_sum) OVER () AS u_scaled FROM u)
"""


@query("som_umatrix", sql=line_sql().rstrip() + _U_SQL + """
SELECT nx AS neuron_x, ny AS neuron_y, round(u_sum, 6) AS u_sum, round(u_mean, 6) AS u_mean,
       round(u_scaled, 6) AS u_scaled FROM um""")
def som_umatrix(spark, sf):
    _, model = line_model(spark, sf)
    return model.distance_map(spark).select(
        "neuron_x", "neuron_y", *[F.round(c, R).alias(c) for c in ("u_sum", "u_mean", "u_scaled")])


@query("som_boundaries", sql=line_sql().rstrip() + _U_SQL + """
, t AS (SELECT avg(u_mean) + stddev_pop(u_mean) AS th FROM um),
f AS (SELECT um.nx, um.ny, um.u_mean, um.u_mean > th AS is_boundary FROM um, t),
e AS (SELECT a.nx, a.ny, count(*) AS n FROM f a JOIN f b
        ON abs(a.nx - b.nx) <= 1 AND abs(a.ny - b.ny) <= 1 AND NOT (a.nx = b.nx AND a.ny = b.ny)
       AND a.is_boundary <> b.is_boundary GROUP BY a.nx, a.ny)
SELECT f.nx AS neuron_x, f.ny AS neuron_y, round(f.u_mean, 6) AS u_mean, f.is_boundary,
       coalesce(e.n, 0)::BIGINT AS n_edges
FROM f LEFT JOIN e ON f.nx = e.nx AND f.ny = e.ny""")
def som_boundaries(spark, sf):
    _, model = line_model(spark, sf)
    b = Q.boundaries(model.distance_map(spark))
    return b.withColumn("u_mean", F.round("u_mean", R))


# ------------------------------------------------------------------ quality
_X, _Y = LINE["x"], LINE["y"]
_GRID = f"grid AS (SELECT i::INTEGER AS nx, j::INTEGER AS ny FROM range({_X}) t(i), range({_Y}) u(j))"
_HITS = (f", {_GRID}, h AS (SELECT nx, ny, count(*) AS hits FROM a{LINE_EPOCHS} WHERE rn = 1 "
         f"GROUP BY nx, ny), hz AS (SELECT g.nx, g.ny, coalesce(h.hits, 0)::BIGINT AS hits "
         f"FROM grid g LEFT JOIN h ON g.nx = h.nx AND g.ny = h.ny)\n")
_METRICS = (", m AS (SELECT avg(distance) AS qe, avg(CASE WHEN greatest(abs(neuron_x - neuron2_x), "
            "abs(neuron_y - neuron2_y)) > 1 THEN 1 ELSE 0 END)::DOUBLE AS te FROM sc), "
            f"p AS (SELECT count(*)::BIGINT AS nodes_used, max(hits)::BIGINT AS max_hits, "
            f"avg(hits)::DOUBLE AS mean_hits FROM h)\n")


def _scored_once(scored):
    """Rows that are read more than once are written once, so the kernel runs once."""
    path = scratch_path(scored.sparkSession, "scored")
    scored.write.parquet(path)
    return scored.sparkSession.read.parquet(path)


def _line_scored(spark, sf):
    rows, model = line_model(spark, sf)
    return model.score(rows), model


@query("som_qe", sql=line_sql(second=True) + "SELECT round(avg(distance), 6) AS qe FROM sc")
def som_qe(spark, sf):
    s, _ = _line_scored(spark, sf)
    return Q.quantization_error(s).select(F.round("qe", R).alias("qe"))


@query("som_te", sql=line_sql(second=True) + """
SELECT round(avg(CASE WHEN greatest(abs(neuron_x - neuron2_x), abs(neuron_y - neuron2_y)) > 1
                 THEN 1 ELSE 0 END)::DOUBLE, 6) AS te FROM sc""")
def som_te(spark, sf):
    s, _ = _line_scored(spark, sf)
    return Q.topographic_error(s).select(F.round("te", R).alias("te"))


@query("som_hits", sql=line_sql().rstrip() + _HITS +
       "SELECT nx AS neuron_x, ny AS neuron_y, hits FROM hz")
def som_hits(spark, sf):
    rows, model = line_model(spark, sf)
    return Q.hits(model.transform(rows), _X, _Y)


_METRICS_SELECT = f"""SELECT round(qe, 6) AS qe, round(te, 6) AS te, nodes_used,
  {_X * _Y}::BIGINT AS total_nodes, round(nodes_used / {float(_X * _Y)}, 6) AS coverage,
  max_hits, round(mean_hits, 6) AS mean_hits FROM m, p"""


def _round_metrics(m):
    return m.select(*[F.round(c, R).alias(c) if c in ("qe", "te", "coverage", "mean_hits")
                      else F.col(c) for c in m.columns])


@query("som_metrics", headline=True, sql=line_sql(second=True).rstrip() + _HITS + _METRICS
       + _METRICS_SELECT)
def som_metrics(spark, sf):
    s, _ = _line_scored(spark, sf)
    return _round_metrics(Q.metrics(s, _X, _Y))


@query("som_metrics_observed", sql=line_sql(second=True).rstrip() + _HITS + _METRICS + _METRICS_SELECT)
def som_metrics_observed(spark, sf):
    """The same row, taken while the scored rows are written."""
    rows, model = line_model(spark, sf)
    scored, seen = Q.observe_metrics(model.score(rows), _X, _Y)
    scored.write.parquet(scratch_path(spark, "scored"))
    return _round_metrics(seen.table(spark))


@query("som_quality_bands", sql=line_sql(second=True).rstrip() + _HITS + _METRICS
       + "SELECT *, CASE WHEN qe < 0.1 THEN 'excellent' WHEN qe < 0.2 THEN 'good' "
       "WHEN qe < 0.3 THEN 'acceptable' ELSE 'poor' END AS qe_band, "
       "CASE WHEN te < 0.1 THEN 'excellent' WHEN te < 0.2 THEN 'good' ELSE 'poor' END AS te_band, "
       "CASE WHEN coverage > 0.7 THEN 'good' WHEN coverage > 0.5 THEN 'acceptable' "
       "ELSE 'poor' END AS coverage_band FROM (" + _METRICS_SELECT + ")")
def som_quality_bands(spark, sf):
    s, _ = _line_scored(spark, sf)
    return Q.quality_report(_round_metrics(Q.metrics(s, _X, _Y)))


@query("som_uniformity", sql=line_sql().rstrip() + _HITS + """
SELECT round(stddev_pop(hits) / avg(hits), 6) AS cv,
       count(*) FILTER (WHERE hits = 0)::BIGINT AS empty_nodes,
       count(*) FILTER (WHERE hits > 0.04::DOUBLE * (SELECT sum(hits) FROM hz))::BIGINT AS dense_nodes,
       round(avg(hits), 6) AS mean_hits FROM hz""")
def som_uniformity(spark, sf):
    rows, model = line_model(spark, sf)
    u = Q.uniformity(Q.hits(model.transform(rows), _X, _Y), dense_share=0.04)
    return u.select(F.round("cv", R).alias("cv"), "empty_nodes", "dense_nodes",
                    F.round("mean_hits", R).alias("mean_hits"))


@query("som_density", sql=line_sql().rstrip() + _HITS + f"""
, mark AS (SELECT DISTINCT a.nx, a.ny FROM a{LINE_EPOCHS} a JOIN src s USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
           WHERE a.rn = 1 AND s.l_extendedprice = (SELECT max(l_extendedprice) FROM src))
SELECT hz.nx AS neuron_x, hz.ny AS neuron_y, hits, (mark.nx IS NOT NULL) AS is_bmu
FROM hz LEFT JOIN mark ON hz.nx = mark.nx AND hz.ny = mark.ny""")
def som_density(spark, sf):
    rows, model = line_model(spark, sf)
    scored = _scored_once(model.transform(rows))
    top = rows.agg(F.max("l_extendedprice").alias("m"))
    sample = scored.join(F.broadcast(top), scored.l_extendedprice == top.m)   # one-row side
    return Q.density_with_bmu(scored, _X, _Y, sample)


@query("som_outliers", sql=line_sql() + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(dist, 6) AS distance,
  CASE WHEN dist < 0.1 THEN 'normal' WHEN dist < 0.2 THEN 'unusual' ELSE 'outlier' END AS anomaly
FROM a{LINE_EPOCHS} WHERE rn = 1""")
def som_outliers(spark, sf):
    rows, model = line_model(spark, sf)
    a = Q.anomaly_flag(model.predict(rows))
    return a.select(*LINE_KEYS, F.round("distance", R).alias("distance"), "anomaly")


@query("som_activation", sql=line_sql() + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1.0::DOUBLE / (1.0::DOUBLE + dist), 6) AS activation
FROM a{LINE_EPOCHS} WHERE rn = 1""")
def som_activation(spark, sf):
    rows, model = line_model(spark, sf)
    return Q.activation(model.predict(rows)).select(
        *LINE_KEYS, F.round("activation", R).alias("activation"))


@query("som_quantize", sql=line_sql() + f"""
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey, """ + ", ".join(
    f"round(c.w{i}, 6) AS q{i}" for i in range(len(LINE_FEATS))) + f"""
FROM a{LINE_EPOCHS} a JOIN cb{LINE_EPOCHS} c ON a.nx = c.nx AND a.ny = c.ny WHERE a.rn = 1""")
def som_quantize(spark, sf):
    rows, model = line_model(spark, sf)
    q = model.quantize(rows)
    return q.select(*LINE_KEYS, *[F.round(F.col("quantized")[i], R).alias(f"q{i}")
                                  for i in range(len(LINE_FEATS))])


@query("som_sparse_outliers", sql=line_sql().rstrip() + _HITS + f"""
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey, a.nx AS neuron_x, a.ny AS neuron_y
FROM a{LINE_EPOCHS} a JOIN hz ON a.nx = hz.nx AND a.ny = hz.ny WHERE a.rn = 1 AND hz.hits <= 0.03::DOUBLE * (SELECT sum(hits) FROM hz)""")
def som_sparse_outliers(spark, sf):
    rows, model = line_model(spark, sf)
    out = Q.sparse_outliers(_scored_once(model.transform(rows)), _X, _Y, max_share=0.03)
    return out.select(*LINE_KEYS, "neuron_x", "neuron_y")


@query("som_label_hits", sql=cust_sql() + f"""
SELECT nx AS neuron_x, ny AS neuron_y, c_mktsegment, count(*) AS hits
FROM a{CUST_EPOCHS} WHERE rn = 1 GROUP BY nx, ny, c_mktsegment""")
def som_label_hits(spark, sf):
    rows, model = cust_model(spark, sf)
    return Q.label_hits(model.transform(rows), "c_mktsegment")


# ---- array features: the 64-dimensional embedding vectors, grid init, SQL-checked
_EMB_D = 64
_EMB = dict(x=6, y=6, sigma=1.5, learning_rate=0.5, neighborhood_function="gaussian",
            decay_function="asymptotic")
_EMB_EPOCHS = 2
_EMB_SRC = ("SELECT vec_id, label, " + ", ".join(
    f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(_EMB_D)) + " FROM embeddings")


@query("som_embeddings_grid", sql=som_ctes(
    _EMB_SRC, ["vec_id", "label"], [f"f{i}" for i in range(_EMB_D)], _EMB["x"], _EMB["y"],
    _EMB_EPOCHS, _EMB["sigma"], _EMB["learning_rate"]) + f"""
SELECT nx AS neuron_x, ny AS neuron_y, label, count(*) AS hits
FROM a{_EMB_EPOCHS} WHERE rn = 1 GROUP BY nx, ny, label""")
def som_embeddings_grid(spark, sf):
    e = table(spark, sf, "embeddings")
    model = SOM(vector_col="embedding", epochs=_EMB_EPOCHS, tol=0, initialization="grid",
                **_EMB).fit(e)
    return Q.label_hits(model.transform(e), "label")
