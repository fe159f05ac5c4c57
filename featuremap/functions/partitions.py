"""Parallelism guard for Python-heavy iterative steps."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread_persisted(df: DataFrame, minimum: int | None = None) -> DataFrame:
    """``df`` is persisted and already materialized.  If it sits in fewer
    partitions than the cluster has cores (one huge parquet row group, a gzip
    file, ...), return a persisted, round-robin spread copy instead, so that
    the passes that follow use every core; otherwise return ``df`` itself.

    Large inputs already have many more splits than cores, so at scale this
    adds no shuffle.  Reading the partition count of a cached plan runs no
    job.
    """
    spark = df.sparkSession
    try:
        want = minimum or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - no RDD access (e.g. Spark Connect)
        return df
    if have >= want:
        return df
    spread = df.repartition(want).persist(StorageLevel.MEMORY_AND_DISK)
    spread.count()                      # materialize from the cached copy
    df.unpersist()
    return spread
