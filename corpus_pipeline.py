"""A corpus cleaning pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps, the last one the encoded documents.  ``run`` applies
them in order; between two stages the rows are written as Parquet below
``spark.checkpoint.dir`` and read again, so a lost executor never costs more
than the stage it worked on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremap.llm import byte_bpe, decontaminate, line_dedup, ngram_join, quality_ledger
from featuremap.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy ``v1`` of the quality ledger."""
    return quality_ledger.keep(docs, "v1")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay only in the smallest document that has them; ``n_chars``
    follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies."""
    return ngram_join.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, checked by decoding them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = docs.select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
    coded = byte_bpe.encode(docs, path, digest=True)
    same = F.col("decoded_sha256") == F.coalesce("text_sha256", F.sha2(F.lit(""), 256))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("byte_bpe", token_ids),
]
#: byte-level BPE has no SQL; the result is tested against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{i}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
