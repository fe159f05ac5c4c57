"""Applying fitted stages to a Structured Streaming DataFrame.

Every fitted model of this library is stateless at apply time: a projection
with literals, a broadcast (stream-static) join with a small mapping, or the
Arrow-batched map scorer.  So the same ``transform`` runs on ``readStream``
input without a state store, and the sink is any file sink with a
checkpoint location in shared storage (exactly-once by the file sink log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def apply_stages(stream: DataFrame, models) -> DataFrame:
    for m in models:
        stream = m.transform(stream)
    return stream


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None,
                 glob_filter: str | None = None) -> DataFrame:
    """A file stream over the folder ``path`` (optionally only names matching
    ``glob_filter``)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available(stream: DataFrame, out_path: str, checkpoint: str | None = None,
                  fmt: str = "parquet") -> str:
    """Process everything available now into ``out_path`` and stop."""
    spark = stream.sparkSession
    q = (stream.writeStream.format(fmt)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
         .option("path", out_path)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:   # pragma: no cover
        raise q.exception()
    return out_path
