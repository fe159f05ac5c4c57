"""Line deduplication against a sharded minimal perfect hash index.

1. Every distinct line key (text stripped, A-Z lower-cased, at least
   ``min_chars`` code points) becomes a 128-bit hash with its number of
   occurrences and its smallest document id; aggregated map-side per slice of
   texts first, so a hot line is a few rows.
2. All distinct keys are dealt to shards by hash.  Each shard is one row of the
   index table: a minimal perfect hash, and arrays by slot of fingerprint (64
   bits), count and owner (the smallest document id).
3. Documents probe the arrays with packed requests (see ``_blocks``): lines are
   never joined.  A key whose count is 1 stays where it is; of the others, a line
   is dropped in every document but the owner.

Defined results: a null or empty text is one empty line; rows without an id
count as one document after all others; rows that repeat an id are one document
when lines are counted, and each gives its own result row; lines below
``min_chars`` always stay, also empty ones.  All other columns are kept, the id with
its type, which is a whole number (others raise a ``TypeError``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremap.llm import _blocks, _mph
from featuremap.llm._words import ready, slices, trim
from featuremap.session import scratch_path

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
LAST_ID = 2 ** 63 - 1
SHARD_LINES = 100_000
_UPPER = bytes(range(256)).lower()

INDEX = "shard int, hash binary, fingerprints binary, counts binary, owners binary"


def _keys(text: str | None, min_chars: int) -> Iterator[tuple[str, bytes | None]]:
    """Each line with the hash of its key, None where the key is too short."""
    for line in (text or "").split("\n"):
        key = line.strip(SPACE)
        yield line, (hashlib.blake2b(key.encode().translate(_UPPER), digest_size=16).digest()
                     if len(key) >= min_chars else None)


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _count(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen: dict[bytes, list[int]] = {}
                ids = part.column("id").to_pylist()
                for i, text in zip(ids, part.column("text").to_pylist(), strict=True):
                    i = LAST_ID if i is None else i
                    for _, key in _keys(text, min_chars):
                        if key is not None:
                            x = seen.setdefault(key, [i, 0])
                            x[0], x[1] = min(x[0], i), x[1] + 1
                if seen:
                    a, b = _hashes(list(seen))
                    x = np.array(list(seen.values()), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (a.view("i8"), b.view("i8"), x[:, 0], x[:, 1])],
                        names=["a", "b", "low", "n"])

    return run


def _build(table: pa.Table) -> pa.Table:
    a, b, owner, n = (table.column(c).to_numpy() for c in ("a", "b", "low", "n"))
    a, b = a.view("u8"), b.view("u8")
    f = _mph.build(a, b)
    at = _mph.Mph(f).slots(a, b)
    arrays = []
    for values in (b, n.astype("<i8"), owner.astype("<i8")):
        by_slot = np.empty_like(values)
        by_slot[at] = values
        arrays.append(by_slot.tobytes())
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                     "hash": [f], "fingerprints": [arrays[0]], "counts": [arrays[1]],
                     "owners": [arrays[2]]})


def build_index(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS) -> int:
    """Write the index of the distinct lines of ``docs`` to ``path`` (Parquet, one
    row a shard); returns the number of shards that hashes are dealt to."""
    spark = docs.sparkSession
    ready(spark)
    rows = _blocks.pack(docs.select(id, text), id, text).select("id", "text")
    lines = (rows.mapInArrow(_count(min_chars), "a long, b long, low long, n long")
             .groupBy("a", "b").agg(F.min("low").alias("low"), F.sum("n").alias("n")))
    counted = scratch_path(spark, "lines")
    lines.write.parquet(counted)
    distinct = spark.read.schema("a long, b long, low long, n long").parquet(counted)
    shards = max(1, math.ceil(distinct.count() / SHARD_LINES))
    (distinct.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
     .groupBy("shard").applyInArrow(_build, INDEX).write.parquet(path))
    return shards


def _request(shards: int, min_chars: int):
    def run(table: pa.Table) -> pa.Table:
        keys = {key for text in table.column("text").to_pylist()
                for _, key in _keys(text, min_chars) if key is not None}
        block = table.column("block")[0].as_py()
        a, b = _hashes(sorted(keys))
        shard = (a.view("i8") % shards).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        both = np.stack([a, b], 1)[order]
        return pa.table({
            "block": pa.array([block] * (len(edges) - 1), pa.int32()),
            "shard": pa.array(shard[order][edges[:-1]], pa.int32()),
            "keys": pa.array([both[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)],
                             pa.binary())})

    return run


def _probe(requests: pa.Table, index: pa.Table) -> pa.Table:
    block, found = [], []
    if index.num_rows:
        f = _mph.Mph(index.column("hash")[0].as_py())
        fingerprint, count, owner = (
            np.frombuffer(index.column(c)[0].as_py(), t)
            for c, t in (("fingerprints", "<u8"), ("counts", "<i8"), ("owners", "<i8")))
        for at, keys in zip(requests.column("block").to_pylist(), requests.column("keys"), strict=True):
            both = np.frombuffer(keys.as_buffer(), "<u8").reshape(-1, 2)
            slot = f.slots(both[:, 0], both[:, 1])
            hit = slot >= 0
            hit[hit] = (fingerprint[slot[hit]] == both[hit, 1]) & (count[slot[hit]] > 1)
            if hit.any():
                block.append(at)
                found.append(np.concatenate(
                    [both[hit], owner[slot[hit], None].view("u8")], 1).tobytes())
    return pa.table({"block": pa.array(block, pa.int32()), "found": pa.array(found, pa.binary())})


def _finish(min_chars: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        trim()
        owners: dict[bytes, int] = {}
        for found in replies.column("found").to_pylist():
            rows = np.frombuffer(found, "<u8").reshape(-1, 3)
            owner = rows[:, 2].astype("<i8").tolist()
            owners.update((x[:16].tobytes(), o) for x, o in
                          zip(rows.view("u1").reshape(len(rows), 24), owner, strict=True))
        kept, total, dropped = [], [], []
        for i, text in zip(docs.column("id").to_pylist(), docs.column("text").to_pylist(), strict=True):
            i = LAST_ID if i is None else i
            lines = list(_keys(text, min_chars))
            stay = [line for line, key in lines if key is None or owners.get(key, i) == i]
            kept.append("\n".join(stay))
            total.append(len(lines))
            dropped.append(len(lines) - len(stay))
        return pa.table({"id": docs.column("id"), "text": pa.array(kept, pa.string()),
                         "rest": docs.column("rest"), "n_lines": pa.array(total, pa.int64()),
                         "n_dropped": pa.array(dropped, pa.int64())})

    return run


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS, index: tuple[str, int] | None = None,
                report: bool = False) -> DataFrame:
    """``docs`` with repeated lines removed from all but the smallest document
    that has them; with ``report`` also ``n_lines`` and ``n_dropped`` (which
    then replace columns of these names)."""
    spark = docs.sparkSession
    ready(spark)
    if index is None:
        path = scratch_path(spark, "line-index")
        index = path, build_index(docs, path, id, text, min_chars)
    path, shards = index
    if report:
        docs = docs.drop("n_lines", "n_dropped")
    dealt = _blocks.deal(_blocks.pack(docs, id, text), _blocks.count_blocks(docs, text))
    requests = dealt.groupBy("block").applyInArrow(
        _request(shards, min_chars), "block int, shard int, keys binary")
    replies = (requests.groupBy("shard")
               .cogroup(spark.read.schema(INDEX).parquet(path).groupBy("shard"))
               .applyInArrow(_probe, "block int, found binary"))
    schema = T.StructType([dealt.schema[c] for c in ("id", "text", "rest")]
                          + [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")])
    done = (dealt.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(_finish(min_chars), schema))
    more = (F.col("n_lines"), F.col("n_dropped")) if report else ()
    return _blocks.unpack(done, docs, id, text, *more)
