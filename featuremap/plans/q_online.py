"""Catalogue: sample-by-sample map training (M1); its SQL is a recursion over the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.som import SOM
from .registry import query, table

X, Y, EPOCHS, SEED = 3, 4, 2, 42
FEATS = ["s_acctbal", "s_nationkey"]
_GAUSS = dict(sigma=1.0, learning_rate=0.5, neighborhood_function="gaussian", decay_function="asymptotic")
_TRIANGLE = dict(sigma=2.5, learning_rate=0.8, neighborhood_function="triangle", decay_function="linear")


def _decayed(v: float, kind: str) -> str:
    if kind == "linear":
        return f"{v!r}::DOUBLE * (1.0::DOUBLE - t / {float(EPOCHS)}::DOUBLE)"
    return f"{v!r}::DOUBLE / (1.0::DOUBLE + t / {EPOCHS / 2}::DOUBLE)"


def online_sql(sigma, learning_rate, neighborhood_function, decay_function) -> str:
    dx, dy = f"(i // 2 // {Y} - b // {Y})::DOUBLE", f"(i // 2 % {Y} - b % {Y})::DOUBLE"
    if neighborhood_function == "triangle":
        h = f"greatest(0.0::DOUBLE, sg - abs({dx})) * greatest(0.0::DOUBLE, sg - abs({dy}))"
    else:
        h = f"exp(-({dx} * {dx} + {dy} * {dy}) / (2.0::DOUBLE * sg * sg))"
    scaled = ", ".join(f"({f} - min({f}) OVER ()) / (max({f}) OVER () - min({f}) OVER ())::DOUBLE AS z{i}"
                       for i, f in enumerate(FEATS))
    return f"""
WITH RECURSIVE s AS (SELECT s_suppkey::VARCHAR AS key, {scaled} FROM supplier),
p AS (SELECT *, ('0x' || substr(md5(key || ':{SEED}:' || e), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS place
      FROM s, (SELECT unnest(range({EPOCHS})) AS e)),
z AS (SELECT row_number() OVER (ORDER BY e, place, key) AS rn, e + place AS t, z0, z1 FROM p),
r AS (SELECT rn, z0, z1, {_decayed(learning_rate, decay_function)} AS lr, {_decayed(sigma, decay_function)} AS sg FROM z),
st AS (
  SELECT 0::BIGINT AS step, list_transform(range({2 * X * Y}), lambda i:
    CASE WHEN i % 2 = 0 THEN (i // 2 // {Y} + 0.5::DOUBLE) / {X}::DOUBLE
         ELSE (i // 2 % {Y} + 0.5::DOUBLE) / {Y}::DOUBLE END) AS w
  UNION ALL
  SELECT step + 1, list_transform(range({2 * X * Y}), lambda i:
           w[i + 1] + lr * ({h}) * (v[i % 2 + 1] - w[i + 1]))
  FROM (SELECT step, w, v, lr, sg, list_position(d, list_min(d)) - 1 AS b
        FROM (SELECT step, w, [z0, z1] AS v, lr, sg, list_transform(range({X * Y}), lambda k:
                (z0 - w[2 * k + 1]) * (z0 - w[2 * k + 1]) + (z1 - w[2 * k + 2]) * (z1 - w[2 * k + 2])) AS d
              FROM st JOIN r ON r.rn = st.step + 1)))
SELECT (k // {Y})::INTEGER AS neuron_x, (k % {Y})::INTEGER AS neuron_y,
       round(w[2 * k + 1], 6) AS w0, round(w[2 * k + 2], 6) AS w1
FROM (SELECT w FROM st ORDER BY step DESC LIMIT 1), (SELECT unnest(range({X * Y})) AS k)"""


def _codebook(spark, sf, **over):
    rows = table(spark, sf, "supplier").select("s_suppkey", *FEATS)
    model = SOM(x=X, y=Y, features=FEATS, epochs=EPOCHS, initialization="grid", mode="online",
                init_key="s_suppkey", workers=1, random_seed=SEED, **over).fit(rows)
    return model.codebook_df(spark).select("neuron_x", "neuron_y", *[
        F.round(F.col("weights")[i], 6).alias(f"w{i}") for i in range(2)])


@query("som_train_online", sql=online_sql(**_GAUSS))
def som_train_online(spark, sf):
    return _codebook(spark, sf, **_GAUSS)


@query("som_train_online_triangle", sql=online_sql(**_TRIANGLE))
def som_train_online_triangle(spark, sf):
    """Sync points don't change what a single worker does."""
    return _codebook(spark, sf, syncs=3, **_TRIANGLE)
