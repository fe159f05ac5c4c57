"""Documents dealt into blocks of bounded size by a hash of their id and text.

An operator that needs corpus-wide facts about the many small parts of its
documents (lines, n-grams) sends one packed request per (block, shard) with the
distinct keys of the block, and gets one packed reply back.  A key found in
every document of a block is asked for once, so a hot key costs one entry per
block and no task gets all its occurrences.  Both uses of the dealt documents
read the same shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 6 << 20


def id_type(docs: DataFrame, id: str) -> T.DataType:
    """The type of the id column: a whole number of any width, which results keep."""
    kind = docs.schema[id].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"column '{id}' is {kind.simpleString()}; ids are whole numbers")
    return kind


def pack(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``text`` and every other column inside one struct ``rest``; the
    names below are free of clashes with the input's."""
    id_type(docs, id)
    others = [c for c in docs.columns if c not in (id, text)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    return docs.select(F.col(f"`{id}`").cast("long").alias("id"),
                       F.col(f"`{text}`").cast("string").alias("text"), rest.alias("rest"))


def unpack(df: DataFrame, docs: DataFrame, id: str, text: str, *more: Column) -> DataFrame:
    """The columns of ``docs`` in their order (text as it is now) and ``more``."""
    cols = [F.col("id").cast(id_type(docs, id)).alias(c) if c == id else F.col("text").alias(c) if c == text
            else F.col("rest")[c].alias(c) for c in docs.columns]
    return df.select(*cols, *more)


def count_blocks(docs: DataFrame, text: str) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")) + 64).alias("n")).first()["n"] or 0
    return max(1, math.ceil(size / BLOCK_BYTES))


def deal(packed: DataFrame, n: int) -> DataFrame:
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")
    return packed.withColumn("block", block).repartition(
        max(n, packed.sparkSession.sparkContext.defaultParallelism), "block")
