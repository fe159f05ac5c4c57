"""Byte-level BPE encoding and decoding of whole texts.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel,
each from its own start.  Chunk i is trusted from the place where it was
stitched to its left neighbour; inside the overlap the first boundary that both
chunks have is where they resynchronise, because the pattern matches from a
boundary on without looking back.  The pieces between stitches are encoded
(each match of the pattern separately) and their ids concatenated in order.
Where an overlap has no common boundary (a run longer than it), the rest of
that text stays one piece, so the ids are always those of the whole text.
Decoding concatenates the bytes of the ids.

Defined results: null is an empty text with no ids; every row gives one result
row, repeated rows and ids included; special tokens are never recognised; other
columns are kept.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremap.llm._words import ready, slices

CHUNK, OVERLAP = 32_768, 512


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tiktoken encoding of a rank file; loaded once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@lru_cache(maxsize=4)
def pattern(source: str):
    import regex

    return regex.compile(source)


def boundaries(text: str, ends: bool, source: str) -> np.ndarray:
    """Starts of the pattern's matches; unless the text ``ends`` here, without
    those that depend on what follows (a match must end before the last
    character)."""
    starts, stop = [0], len(text) - (0 if ends else 1)
    for m in pattern(source).finditer(text):
        if m.end() > stop:
            break
        starts.append(m.end())
    return np.array(starts, np.int32)


def _plus(df: DataFrame, **columns: str) -> T.StructType:
    out = T.StructType(list(df.schema.fields))
    for name, kind in columns.items():
        out.add(T.StructType.fromDDL(f"`{name}` {kind}")[0])
    return out


def _bounds(source: str, chunk: int, overlap: int):
    """Boundaries in the overlap with the left and the right neighbour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for text, i, n in zip(*(batch.column(c).to_pylist() for c in ("part", "i", "n")), strict=True):
                b = boundaries(text, i == n - 1, source)
                left.append(b[b < overlap] + i * chunk)
                # a piece must not end in white space, where the pattern looks ahead
                right.append(np.array([x for x in b[b >= chunk].tolist()
                                       if not text[x - 1].isspace()], np.int32) + i * chunk)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(left, pa.list_(pa.int32())),
                 pa.array(right, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "left", "right"])

    return run


def _encode(path: str, digest: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in batches:
            for part in slices(batch, "part"):
                ids = [np.array(enc.encode_ordinary(t or ""), np.int32)
                       for t in part.column("part").to_pylist()]
                out = _with(part, "ids", ids)
                if digest:
                    out = out.append_column("decoded_sha256", pa.array(
                        [hashlib.sha256(enc.decode_bytes(x.tolist())).hexdigest() for x in ids]))
                yield out

    return run


def _with(part: pa.RecordBatch, name: str, ids: list[np.ndarray]) -> pa.RecordBatch:
    at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(values, pa.int32()))
    keep = [c for c in part.schema.names if c != "part"]
    return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], names=[*keep, name])


def _pieces(long: DataFrame, chunk: int, overlap: int, source: str) -> DataFrame:
    """Rows (row, i, part): the pieces of each long text, in order of ``i``."""
    n = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = (long.withColumn("n", n)
              .select("row", "n", "text", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
              .select("row", "n", "i",
                      F.substring("text", F.col("i") * chunk + 1, F.lit(chunk + overlap)).alias("part"))
              .repartition(F.col("row.key"), F.col("i")))
    seen = chunks.mapInArrow(_bounds(source, chunk, overlap),
                             _plus(chunks, left="array<int>", right="array<int>"))
    order = Window.partitionBy("row").orderBy("i")
    cut = F.array_min(F.array_intersect(F.lag("right").over(order), F.col("left")))
    seen = seen.select("row", "n", "i", "part",
                       F.when(F.col("i") == 0, 0).otherwise(cut).alias("cut"))
    # from the first failed stitch on, the rest of the text is one piece
    ok = F.min(F.col("cut").isNotNull()).over(order)
    seen = seen.withColumn("ok", ok)
    last = F.max(F.when(F.col("ok"), F.col("i"))).over(Window.partitionBy("row"))
    end = F.lead(F.when(F.col("ok"), F.col("cut"))).over(order)
    seen = seen.withColumn("end", end).withColumn("last", last)
    base = F.col("i") * chunk
    inner = F.substring("part", F.col("cut") - base + 1,
                        F.coalesce(F.col("end") - F.col("cut"), F.length("part")))
    whole = seen.filter("ok and (i < last or last = n - 1)").select("row", "i", inner.alias("part"))
    tail = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("i", F.when(
            F.col("i") == F.col("last"), F.substring("part", F.col("cut") - base + 1, F.lit(2 ** 31 - 1)))
            .otherwise(F.substring("part", F.lit(overlap + 1), F.lit(2 ** 31 - 1))).alias("s")))),
        lambda x: x["s"]), "")
    rest = (seen.filter("last < n - 1 and i >= last").groupBy("row")
            .agg(F.min("last").alias("i"), tail.alias("part")))
    return whole.unionByName(rest)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
           chunk: int = CHUNK, overlap: int = OVERLAP, digest: bool = False) -> DataFrame:
    """``docs`` without the text column and with ``ids`` (array of int); with
    ``digest`` also ``decoded_sha256`` as :func:`decode` gives it, in the same pass."""
    import public_tokenizers

    ready(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text, ids) and not (digest and c == "decoded_sha256")]
    fields = [F.col(f"`{c}`") for c in others] or [F.lit(0).alias("_")]
    rows = docs.select(F.struct(*fields).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap
    short = rows.filter(~long).select("row", F.col("text").alias("part"))
    more = {"decoded_sha256": "string"} if digest else {}
    coded = short.mapInArrow(_encode(path, digest), _plus(short.select("row"), ids="array<int>", **more))
    # each long text once, by its digest; other columns are of any type and stay with their rows
    keyed = rows.filter(long).withColumn("key", F.sha2("text", 256))
    texts = keyed.select(F.struct("key").alias("row"), "text").distinct()
    pieces = _pieces(texts, chunk, overlap, public_tokenizers.PATTERN)
    parts = pieces.mapInArrow(_encode(path), _plus(pieces.drop("part"), ids="array<int>"))
    joined = parts.groupBy("row").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("i", "ids"))), lambda x: x["ids"])).alias("ids"))
    if digest:
        joined = decode(joined, path, digest=True)
    joined = (keyed.select("row", "key").join(joined.select(F.col("row.key").alias("key"), "ids", *more), "key")
              .drop("key"))
    return coded.unionByName(joined).select(
        *[F.col("row")[c].alias(c) for c in others], F.col("ids").alias(ids), *more)


def _decode(path: str, ids: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in batches:
            lists = batch.column(ids)
            values, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            at = at - at[0]
            raw = [enc.decode_bytes(values[i:j].tolist())
                   for i, j in zip(at[:-1], at[1:], strict=True)]
            if digest:
                raw = [hashlib.sha256(x).hexdigest() for x in raw]
            keep = [c for c in batch.schema.names if c != ids] if not digest else batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(raw, pa.string() if digest else pa.binary())],
                names=[*keep, "decoded_sha256" if digest else "decoded"])

    return run


def decode(coded: DataFrame, path: str, ids: str = "ids", digest: bool = False) -> DataFrame:
    """The bytes of the ids as column ``decoded`` in place of ``ids``; with
    ``digest`` their SHA-256 in hex as ``decoded_sha256`` beside ``ids``."""
    ready(coded.sparkSession)
    coded = coded.drop("decoded_sha256" if digest else "decoded")
    schema = (_plus(coded, decoded_sha256="string") if digest
              else _plus(coded.drop(ids), decoded="binary"))
    return coded.mapInArrow(_decode(path, ids, digest), schema)
