"""Segmentation over a trained map (G1-G6): clustering of the codebook,
labelling rows through their neuron, and segment profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kmeans import KMeans
from .prep import attach_lookup, with_share

#: an example lookup: segment id, name, strategy, budget; pass your own rows
SEGMENT_LOOKUP = [
    (0, "large accounts", "account manager", "high"),
    (1, "price sensitive", "bundles", "medium"),
    (2, "seasonal", "reminders", "low"),
    (3, "regular", "loyalty points", "medium"),
    (4, "inactive", "survey", "low"),
]


def lookup_table(spark: SparkSession, rows=SEGMENT_LOOKUP) -> DataFrame:
    return spark.createDataFrame(rows, "segment int, name string, strategy string, budget string")


def _weighted_codebook(codebook: DataFrame, hits: DataFrame | None) -> tuple[DataFrame, int]:
    """Codebook rows with a key and, from ``hits`` (neuron_x, neuron_y, hits), weights."""
    out = codebook.withColumn("__key", F.concat_ws("-", "neuron_x", "neuron_y"))
    if hits is not None:
        weights = hits.select("neuron_x", "neuron_y", F.col("hits").cast("double").alias("__hits"))
        out = out.join(weights, ["neuron_x", "neuron_y"], "left")
    return out, codebook.select(F.size("weights")).first()[0]


def _kmeans(codebook: DataFrame, ks, seed: int, hits: DataFrame | None):
    rows, size = _weighted_codebook(codebook, hits)
    return rows, KMeans(vector_col="weights", size=size, key="__key", ks=ks, seed=seed,
                        weight="__hits" if hits is not None else None).fit(rows)


def cluster_codebook(codebook: DataFrame, k: int = 5, seed: int = 42, hits: DataFrame | None = None):
    """K-means over the codebook vectors (G1): ``neuron_x, neuron_y, segment`` and the cost.

    With ``hits`` every neuron counts as often as rows fell on it, so the clusters are
    those of the quantized rows; neurons without rows get the nearest cluster.  To
    cluster rows themselves use :class:`KMeans`.
    """
    rows, model = _kmeans(codebook, [k], seed, hits)
    return model.transform(rows, k).select("neuron_x", "neuron_y", "segment"), model.inertia[k]


def elbow(codebook: DataFrame, ks=range(2, 10), seed: int = 42, hits: DataFrame | None = None) -> DataFrame:
    """Inertia for each k (G2); all k are fitted in the same jobs."""
    _, model = _kmeans(codebook, list(ks), seed, hits)
    return model.elbow(codebook)


def label_rows(assigned: DataFrame, neuron_segments: DataFrame) -> DataFrame:
    """Segment of every row through its neuron (G3).  The planner decides how the
    neuron table is joined: its size is the caller's."""
    return assigned.join(neuron_segments, ["neuron_x", "neuron_y"], "left")


def profile(labelled: DataFrame, segment: str, measures: list[str],
            lookup: DataFrame | None = None) -> DataFrame:
    """Per segment: count, percent of all rows, average of each measure, and
    the lookup attributes with ``Segment {id}`` as default name (G4, X13, X14)."""
    agg = (labelled.groupBy(segment)
           .agg(F.count(F.lit(1)).alias("count"),
                *[F.avg(m).alias(f"avg_{m}") for m in measures]))
    out = with_share(agg, "count", "percent")
    if lookup is not None:
        out = attach_lookup(out, lookup.withColumnRenamed("segment", segment), segment,
                            {"name": F.concat(F.lit("Segment "), F.col(segment).cast("string"))})
    return out
