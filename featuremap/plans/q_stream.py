"""Catalogue: fitted models applied to a stream (Z1, extension)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.encode import LabelEncoder
from ..operators.scale import MinMaxScaler
from ..operators.som import SOM
from ..operators.som import quality as Q
from ..session import scratch_path
from ..streaming import IncrementalFit, apply_stages, run_available, stream_files
from .registry import query, table
from .som_sql import som_ctes


@query("stream_apply", sql="""
SELECT event_id, user_id,
  round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 6) AS value,
  CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS event_type
FROM events""")
def stream_apply(spark, sf):
    batch = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    models = [MinMaxScaler(["value"]).fit(batch), LabelEncoder(["event_type"]).fit(batch)]
    events = stream_files(spark, sf, table(spark, sf, "events").schema,
                          glob_filter="events.parquet")
    scored = apply_stages(events.select("event_id", "user_id", "value", "event_type"), models)
    out = run_available(scored, scratch_path(spark, "stream-out"))
    return spark.read.parquet(out).select("event_id", "user_id", F.round("value", 6).alias("value"),
                                          "event_type")


# ---- the map applied to a stream: events scored against a map fitted on the batch table

_EV_FEATS = ["value", "user_id"]
_EV = dict(x=4, y=4, sigma=1.0, learning_rate=0.5, neighborhood_function="gaussian",
           decay_function="asymptotic")
_EV_EPOCHS = 2


@query("stream_som_outliers", sql=som_ctes(
    "SELECT event_id, value, user_id FROM events", ["event_id"], _EV_FEATS, _EV["x"], _EV["y"],
    _EV_EPOCHS, _EV["sigma"], _EV["learning_rate"]) + f"""
SELECT event_id, nx AS neuron_x, ny AS neuron_y, round(dist, 6) AS distance,
  CASE WHEN dist < 0.1 THEN 'normal' WHEN dist < 0.2 THEN 'unusual' ELSE 'outlier' END AS anomaly
FROM a{_EV_EPOCHS} WHERE rn = 1""")
def stream_som_outliers(spark, sf):
    batch = table(spark, sf, "events").select("event_id", *_EV_FEATS)
    model = SOM(features=_EV_FEATS, epochs=_EV_EPOCHS, tol=0, initialization="grid",
                **_EV).fit(batch)
    events = stream_files(spark, sf, table(spark, sf, "events").schema,
                          glob_filter="events.parquet")
    scored = Q.anomaly_flag(model.predict(events.select("event_id", *_EV_FEATS)))
    out = run_available(scored.select("event_id", "neuron_x", "neuron_y", "distance", "anomaly"),
                        scratch_path(spark, "stream-som"))
    return spark.read.parquet(out).withColumn("distance", F.round("distance", 6))


# ---- fits kept up to date by a stream: the orders arrive in several files, one a batch

_INC = ["o_totalprice", "o_custkey"]


def _orders_in_batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", *_INC, "o_orderstatus", "o_orderpriority")
    src = scratch_path(spark, "arriving")
    orders.repartition(4, "o_orderkey").write.parquet(src)
    fit = IncrementalFit(scratch_path(spark, "fit-state"), _INC, ["o_orderstatus", "o_orderpriority"])
    fit.run_available(stream_files(spark, src, orders.schema, max_files_per_trigger=1),
                      scratch_path(spark, "stream-ckpt"))
    return orders, fit


@query("stream_fit_moments", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM orders" for c in _INC))
def stream_fit_moments(spark, sf):
    _, fit = _orders_in_batches(spark, sf)
    return fit.table(spark).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("stream_fit_models", sql="""
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6) AS o_totalprice,
  (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus,
  (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS o_orderpriority FROM orders""")
def stream_fit_models(spark, sf):
    orders, fit = _orders_in_batches(spark, sf)
    out = fit.labels(spark).transform(fit.zscore(spark).transform(orders))
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"),
                      "o_orderstatus", "o_orderpriority")
