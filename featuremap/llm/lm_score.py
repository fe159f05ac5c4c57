"""Stupid-backoff scores from n-gram counts of the whole corpus.

A word's score is the relative frequency of the longest n-gram it ends that the
other documents have, times ``ALPHA`` for each order given up:

    S(w | u v) = c(u v w) / c(u v)    if c(u v w) > 0,  else ALPHA * S(w | v)
    S(w)       = max(c(w), 1) / max(N, 1)

c counts occurrences in all documents but the scored one and N their words; a
document's log score is the sum of ln S.

The documents are dealt into blocks (see ``_blocks``).  A block sends its
distinct n-grams, exploded from its texts and pre-aggregated, to the shards of
the count tables, which are dealt by the n-gram's hash.  A shard adds the counts
of an n-gram from all blocks and answers each block with the totals of the
n-grams it sent, so counting and joining are one exchange, and an n-gram that
every document holds is one entry per block.  The block then sums per document.
For very large corpora larger ``BLOCK_BYTES`` and ``shard_keys`` keep packets full.

Defined results: null and empty texts have no words and score 0; repeated rows
and ids each get a row and count as documents of their own; the first words of a
text have shorter contexts; other columns are ignored.  N-grams are compared by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm import _blocks
from featuremap.llm._packed import pack, runs, unpack
from featuremap.llm._words import ALNUM, Words, mix, slices, words
from featuremap.session import ship_package

ALPHA = 0.4
ORDER = 3
SHARD_KEYS = 700_000


def _grams(w: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of this order inside a text, and the words they end with."""
    grams = mix(w.hash) if order == 1 else w.ngrams(order)
    inside = np.flatnonzero(w.whole(order))
    return grams[inside], inside + order - 1


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed words: what a block needs of them, a third of the bytes."""
    pack_ = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column("text"), ALNUM)
            bare = np.where(ALNUM[w.data], w.data, np.uint8(0x20))
            lo, hi = w.first[:-1], w.first[1:]
            z = [pack_(bare[w.start[i]:w.end[j - 1]].tobytes()) if j > i else None
                 for i, j in zip(lo.tolist(), hi.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array(z, pa.binary())], names=["id", "key", "z"])


def _words(table: pa.Table) -> Words:
    open_ = zstandard.ZstdDecompressor().decompress
    return words(pa.array([None if z is None else open_(z) for z in table.column("z").to_pylist()],
                          pa.binary()), ALNUM)


_REQUEST = "block int, part long, keys binary, counts binary"


def _request(order: int, shards: int):
    def run(table: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
        block = table.column("block")[0].as_py()
        w = _words(table)
        rows = []
        for n in range(1, order + 1):
            keys, counts = np.unique(_grams(w, n)[0], return_counts=True)
            for s, lo, hi in runs(keys, shards):
                rows.append((n * shards + s, pack(keys[lo:hi], True), pack(counts[lo:hi])))
        part, keys, counts = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"block": pa.array([block] * len(rows), pa.int32()),
                         "part": pa.array(part, pa.int64()), "keys": pa.array(keys, pa.binary()),
                         "counts": pa.array(counts, pa.binary())})

    return run


def _total(table: pa.Table) -> pa.Table:
    """Totals of all n-grams of a shard, for each block in the order of its keys."""
    keys = [unpack(k, True) for k in table.column("keys").to_pylist()]
    counts = [unpack(c) for c in table.column("counts").to_pylist()]
    every, index = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.uint64)
    np.add.at(total, index, np.concatenate(counts))
    at = np.cumsum([len(k) for k in keys])[:-1]
    return pa.table({"block": table.column("block"), "part": table.column("part"),
                     "totals": pa.array([pack(t) for t in np.split(total[index], at)], pa.binary())})


def _finish(order: int, alpha: float, total_words: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        w = _words(docs)
        replies = replies.sort_by("part")
        totals = [unpack(t) for t in replies.column("totals").to_pylist()]
        totals = np.concatenate(totals).astype(np.int64) if totals else np.zeros(0, np.int64)
        doc, n, used = w.doc, w.n_words, 0
        others = []             # per order: occurrences elsewhere of the n-gram each word ends
        for k in range(1, order + 1):
            grams, ends = _grams(w, k)
            keys, index = np.unique(grams, return_inverse=True)
            pair, own_at, own = np.unique(doc[ends] * np.int64(len(keys) + 1) + index,
                                          return_inverse=True, return_counts=True)
            elsewhere = np.zeros(len(doc), np.int64)
            elsewhere[ends] = totals[used + index] - own[own_at]
            used += len(keys)
            others.append(elsewhere)
        level = np.zeros(len(doc), np.int64)
        rest = np.maximum(total_words - n, 1)[doc]
        score = np.log(np.maximum(others[0], 1) / rest)
        level[others[0] > 0] = 1
        for k in range(2, order + 1):
            score += math.log(alpha)                        # as if order k gives up
            has = others[k - 1] > 0
            before = np.roll(others[k - 2], 1)              # the context ends one word earlier
            score[has] = np.log(others[k - 1][has] / before[has])
            level[has] = k
        # shorter contexts at a text's start give up no order
        place = np.arange(len(doc)) - w.first[:-1][doc]
        for k in range(2, order + 1):
            score[(place < k - 1)] -= math.log(alpha)
        out = {"id": docs.column("id"), "n_words": pa.array(n),
               "log_score": pa.array(np.bincount(doc, score, len(n)).astype(np.float64))}
        for k in range(order + 1):
            out[f"n_order_{k}"] = pa.array(np.bincount(doc[level == k], minlength=len(n)))
        return pa.table(out)

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = count = 0
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column("text"), ALNUM)
            size, count = size + len(w.data), count + len(w.hash)
    yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([count])], names=["size", "words"])


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER,
          alpha: float = ALPHA, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(id, n_words, log_score, n_order_0 .. n_order_n): how many words were scored
    by which order, 0 for words found nowhere else."""
    ship_package(docs.sparkSession)
    rows = _blocks.pack(docs.select(id, text), id, text)
    all_ = rows.select("text").mapInArrow(_sizes, "size long, words long").agg(
        F.sum("size").alias("size"), F.sum("words").alias("words")).first()
    total = all_["words"] or 0
    n = max(1, math.ceil((all_["size"] or 0) / _blocks.BLOCK_BYTES))
    dealt = (rows.select("id", F.xxhash64("id", "text").alias("key"), "text")
             .mapInArrow(_squeeze, "id long, key long, z binary")
             .withColumn("block", F.pmod("key", F.lit(n)).cast("int")).drop("key")
             .repartition(max(n, docs.sparkSession.sparkContext.defaultParallelism), "block"))
    shards = max(1, math.ceil(total / shard_keys))
    requests = dealt.groupBy("block").applyInArrow(_request(order, shards), _REQUEST)
    replies = requests.groupBy("part").applyInArrow(_total, "block int, part long, totals binary")
    levels = "".join(f", n_order_{k} long" for k in range(order + 1))
    return (dealt.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(_finish(order, alpha, total), f"id long, n_words long, log_score double{levels}")
            .withColumn("id", F.col("id").cast(_blocks.id_type(docs, id))).withColumnRenamed("id", id))
