"""Position of every distinct value in sorted order, per group, at any scale.

A ``dense_rank()`` window without ``partitionBy`` puts every value into one
task.  Instead the distinct values are range-partitioned and sorted, each row
takes its partition-local position (``monotonically_increasing_id``), the
result is checkpointed so the positions are stable, and the only data that
reaches the driver is one count per (partition, group).
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def sorted_index(d: DataFrame, group: str, value: str, code: str = "code",
                 num_partitions: int | None = None) -> DataFrame:
    """``d`` holds distinct ``(group, value)`` rows; returns them with ``code``,
    the 0-based position of ``value`` in ascending order within ``group``."""
    spark = d.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (d.repartitionByRange(n, group, value)
         .sortWithinPartitions(group, value)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    stats = (s.groupBy("_pid", group)
             .agg(F.count(F.lit(1)).alias("c"), F.min("_mid").alias("m0"))
             .collect())
    running: dict = defaultdict(int)
    rows = []
    for r in sorted(stats, key=lambda r: r["_pid"]):
        rows.append((r["_pid"], r[group], running[r[group]] - r["m0"]))
        running[r[group]] += r["c"]
    gtype = s.schema[group].dataType
    off = spark.createDataFrame(rows, T.StructType([
        T.StructField("_pid", T.IntegerType()),
        T.StructField(group, gtype),
        T.StructField("_off", T.LongType()),
    ]))
    # ``off`` has at most partitions x groups rows: a proven bound, so broadcast
    return (s.join(F.broadcast(off), ["_pid", group])
            .select(group, value, (F.col("_mid") + F.col("_off")).alias(code)))
