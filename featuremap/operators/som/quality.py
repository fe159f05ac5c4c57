"""Map quality and grid summaries as DataFrame queries (M15-M21, M24, M26-M28,
M32-M34).  ``scored`` is the output of ``SOMModel.score``: input rows plus
``neuron_x, neuron_y, distance, neuron2_x, neuron2_y``.  Every function is a
lazy aggregate or join; grid-sized sides (x*y rows) are broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ...functions.columns import q

# Quality bands used by the reference's tutorial report.
QE_BANDS = ((0.1, "excellent"), (0.2, "good"), (0.3, "acceptable"))
TE_BANDS = ((0.1, "excellent"), (0.2, "good"))
COVERAGE_BANDS = ((0.7, "good"), (0.5, "acceptable"))
# Distance bands of the anomaly flag.
DISTANCE_BANDS = ((0.1, "normal"), (0.2, "unusual"))


def grid(spark: SparkSession, x: int, y: int) -> DataFrame:
    """All ``x * y`` coordinates."""
    return (spark.range(x * y)
            .select((F.col("id") / y).cast("int").alias("neuron_x"),
                    (F.col("id") % y).cast("int").alias("neuron_y")))


def chebyshev(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.greatest(F.abs(ax - bx), F.abs(ay - by))


def quantization_error(scored: DataFrame) -> DataFrame:
    """Mean distance of every row to its best unit."""
    return scored.agg(F.avg("distance").alias("qe"))


def topographic_error(scored: DataFrame) -> DataFrame:
    """Share of rows whose two best units are not 8-neighbours (M16, D15), over
    all rows (D14)."""
    bad = (chebyshev(F.col("neuron_x"), F.col("neuron_y"),
                     F.col("neuron2_x"), F.col("neuron2_y")) > 1).cast("int")
    return scored.where(F.col("neuron_x").isNotNull()).agg(F.avg(bad).cast("double").alias("te"))


def hits(scored: DataFrame, x: int, y: int) -> DataFrame:
    """Rows per neuron, zero-filled over the whole grid."""
    counts = (scored.where(F.col("neuron_x").isNotNull())
              .groupBy("neuron_x", "neuron_y").agg(F.count(F.lit(1)).alias("hits")))
    return (grid(scored.sparkSession, x, y)
            .join(counts, ["neuron_x", "neuron_y"], "left")
            .select("neuron_x", "neuron_y", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")))


def metrics(scored: DataFrame, x: int, y: int) -> DataFrame:
    """One row: qe, te, nodes_used, total_nodes, coverage, max_hits, mean_hits.

    Two stacked aggregates, no join: per neuron (partial per partition, at
    most x*y groups) the hits and the sums of distance and of topographic
    faults, then one row from those.
    """
    valid = scored.where(F.col("neuron_x").isNotNull())
    bad = (chebyshev(F.col("neuron_x"), F.col("neuron_y"),
                     F.col("neuron2_x"), F.col("neuron2_y")) > 1).cast("long")
    per = valid.groupBy("neuron_x", "neuron_y").agg(
        F.count(F.lit(1)).alias("h"), F.sum("distance").alias("sd"), F.sum(bad).alias("sb"))
    total = x * y
    return per.agg(
        (F.sum("sd") / F.sum("h")).alias("qe"),
        (F.sum("sb") / F.sum("h")).cast("double").alias("te"),
        F.count(F.lit(1)).cast("bigint").alias("nodes_used"),
        F.lit(total).cast("bigint").alias("total_nodes"),
        (F.count(F.lit(1)) / F.lit(float(total))).alias("coverage"),
        F.max("h").cast("bigint").alias("max_hits"),
        F.avg("h").cast("double").alias("mean_hits"))


class ObservedMetrics:
    """The metrics of rows that were observed while another action wrote them."""

    def __init__(self, observation: Observation, x: int, y: int):
        self._seen, self.x, self.y = observation, x, y

    def table(self, spark: SparkSession) -> DataFrame:
        """As :func:`metrics`; waits for the action that computes the observed rows."""
        seen, total = self._seen.get, self.x * self.y
        hits = [h["count"] for h in seen["hits"] or [] if h["item"] is not None]
        n, used = sum(hits), len(hits)
        row = (seen["sd"] / n, seen["sb"] / n, used, total, used / total, max(hits), n / used) if n else (
            None, None, 0, total, 0.0, None, None)
        return spark.createDataFrame([row], "qe double, te double, nodes_used long, total_nodes long, "
                                            "coverage double, max_hits long, mean_hits double")


def observe_metrics(scored: DataFrame, x: int, y: int, prefix: str = "neuron") -> tuple[DataFrame, ObservedMetrics]:
    """``scored`` unchanged, with its metrics computed by the action that reads it: no
    second scoring pass.  That must be an action on the rows themselves, such as a write
    (each partition then counts once, also when tasks are tried again), and each further
    action on the result scores again.

    The hits of all neurons come from one frequent-items sketch with room for every
    neuron, which never drops one and so counts exactly.
    """
    nx, ny, mx, my = (F.col(q(f"{prefix}{c}")) for c in ("_x", "_y", "2_x", "2_y"))
    bad = (chebyshev(nx, ny, mx, my) > 1).cast("long")
    k, room = x * y, max(64, 4 * x * y)
    seen = Observation()
    top = f"approx_top_k(CAST({q(prefix + '_x')} * {y} + {q(prefix + '_y')} AS BIGINT), {k + 1}, {room})"
    out = scored.observe(seen, F.sum(F.when(nx.isNotNull(), F.col("distance"))).alias("sd"),
                         F.sum(F.when(nx.isNotNull(), bad)).alias("sb"), F.expr(top).alias("hits"))
    return out, ObservedMetrics(seen, x, y)


def _bands(c: Column, bands, default: str) -> Column:
    out = None
    for lim, label in bands:
        out = F.when(c < lim, label) if out is None else out.when(c < lim, label)
    return out.otherwise(default)


def quality_report(metrics_df: DataFrame) -> DataFrame:
    """Band labels for QE, TE and coverage on the metrics row."""
    cov = F.col("coverage")
    return metrics_df.select(
        "*",
        _bands(F.col("qe"), QE_BANDS, "poor").alias("qe_band"),
        _bands(F.col("te"), TE_BANDS, "poor").alias("te_band"),
        F.when(cov > COVERAGE_BANDS[0][0], COVERAGE_BANDS[0][1])
         .when(cov > COVERAGE_BANDS[1][0], COVERAGE_BANDS[1][1])
         .otherwise("poor").alias("coverage_band"))


def anomaly_flag(scored: DataFrame) -> DataFrame:
    """``normal`` / ``unusual`` / ``outlier`` by distance to the best unit."""
    return scored.withColumn("anomaly", _bands(F.col("distance"), DISTANCE_BANDS, "outlier"))


def activation(scored: DataFrame) -> DataFrame:
    """``1 / (1 + distance)`` (M32; the form is our documented choice)."""
    return scored.withColumn("activation", F.lit(1.0) / (F.lit(1.0) + F.col("distance")))


def uniformity(hits_df: DataFrame, dense_share: float) -> DataFrame:
    """Spread of the hit map (M28): coefficient of variation, empty neurons, and dense
    ones, which have more than ``dense_share`` of all rows."""
    h = F.col("hits")
    hits_df = hits_df.withColumn("__all", F.sum(h).over(_over_grid()))
    return hits_df.agg(
        (F.stddev_pop(h) / F.avg(h)).alias("cv"),
        F.count_if(h == 0).cast("bigint").alias("empty_nodes"),
        F.count_if(h > F.lit(dense_share) * F.col("__all")).cast("bigint").alias("dense_nodes"),
        F.avg(h).cast("double").alias("mean_hits"))


def label_hits(scored: DataFrame, label: str) -> DataFrame:
    """Rows per neuron and label."""
    return (scored.where(F.col("neuron_x").isNotNull())
            .groupBy("neuron_x", "neuron_y", label).agg(F.count(F.lit(1)).alias("hits")))


def sparse_outliers(scored: DataFrame, x: int, y: int, max_share: float) -> DataFrame:
    """Rows that land on neurons with at most ``max_share`` of all rows.

    The hit table has ``x * y`` rows, so it is broadcast to the row side.
    ``scored`` is read twice: pass stored or persisted rows, or they are scored
    twice.
    """
    h = hits(scored, x, y).withColumn("__all", F.sum("hits").over(_over_grid()))
    h = h.where(F.col("hits") <= F.lit(max_share) * F.col("__all")).drop("__all")
    return scored.join(F.broadcast(h), ["neuron_x", "neuron_y"], "inner")


def density_with_bmu(scored: DataFrame, x: int, y: int, sample: DataFrame) -> DataFrame:
    """Hit map plus ``is_bmu`` for the best unit(s) of ``sample``."""
    marks = sample.select("neuron_x", "neuron_y").distinct().withColumn("is_bmu", F.lit(True))
    return (hits(scored, x, y).join(F.broadcast(marks), ["neuron_x", "neuron_y"], "left")
            .withColumn("is_bmu", F.coalesce("is_bmu", F.lit(False))))


# the 8-neighbourhood as coordinate offsets (Chebyshev distance 1)
_OFFSETS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)]


def _with_neighbours(grid_df: DataFrame) -> DataFrame:
    """Each neuron once per existing-or-not neighbour coordinate (8 rows)."""
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _OFFSETS])
    return (grid_df.select("*", F.explode(offs).alias("__o"))
            .withColumn("nb_x", F.col("neuron_x") + F.col("__o.dx"))
            .withColumn("nb_y", F.col("neuron_y") + F.col("__o.dy")).drop("__o"))


def _over_grid():
    # a window over a grid-sized table (x*y rows, a fixed bound)
    return Window.partitionBy()


def umatrix(codebook: DataFrame) -> DataFrame:
    """Distances to the 8-neighbours of every neuron (M19): sum, mean over the
    neighbours that exist (D27), and sum divided by its maximum (D16).

    Neighbours are found by an equi-join on the 8 offset coordinates, so each
    neuron meets only its adjacent neurons; both sides have x*y rows.
    """
    a = _with_neighbours(codebook.withColumnRenamed("weights", "wa"))
    b = codebook.select(F.col("neuron_x").alias("bx"), F.col("neuron_y").alias("by"),
                        F.col("weights").alias("wb"))
    sq = F.aggregate(F.zip_with("wa", "wb", lambda p, q: (p - q) * (p - q)),
                     F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    pairs = (a.join(F.broadcast(b), (F.col("nb_x") == F.col("bx")) & (F.col("nb_y") == F.col("by")))
             .select("neuron_x", "neuron_y", F.sqrt(sq).alias("d")))
    u = pairs.groupBy("neuron_x", "neuron_y").agg(F.sum("d").alias("u_sum"),
                                                   F.avg("d").alias("u_mean"))
    return u.withColumn("u_scaled", F.col("u_sum") / F.max("u_sum").over(_over_grid()))


def boundaries(u: DataFrame, threshold: float | None = None) -> DataFrame:
    """Neurons above ``threshold`` (default mean(U) + stddev_pop(U)) and the
    grid edges between a boundary and a non-boundary neighbour (M24).

    Returns ``neuron_x, neuron_y, u_mean, is_boundary, n_edges``.
    """
    if threshold is None:
        t = F.avg("u_mean").over(_over_grid()) + F.stddev_pop("u_mean").over(_over_grid())
    else:
        t = F.lit(float(threshold))
    flagged = u.select("neuron_x", "neuron_y", "u_mean", (F.col("u_mean") > t).alias("is_boundary"))
    a = _with_neighbours(flagged)
    b = flagged.select(F.col("neuron_x").alias("bx"), F.col("neuron_y").alias("by"),
                       F.col("is_boundary").alias("b_boundary"))
    edges = (a.join(F.broadcast(b), (F.col("nb_x") == F.col("bx")) & (F.col("nb_y") == F.col("by")))
             .where(F.col("is_boundary") != F.col("b_boundary"))
             .groupBy("neuron_x", "neuron_y").agg(F.count(F.lit(1)).alias("n_edges")))
    return (flagged.join(edges, ["neuron_x", "neuron_y"], "left")
            .select("neuron_x", "neuron_y", "u_mean", "is_boundary",
                    F.coalesce("n_edges", F.lit(0)).cast("bigint").alias("n_edges")))
