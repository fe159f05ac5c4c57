"""Benchmark decontamination by winnowing.

A document is hit where it holds a window of ``window`` consecutive benchmark
words (an item of fewer words is one window).  Fingerprints are found by
winnowing: of the k-gram hashes in each sliding window the smallest is kept,
with k and the width chosen so that k + width - 1 is the length of the
benchmark window.  Every window therefore has exactly one fingerprint, which
depends on its own words only, so each occurrence in a document selects the
same one and none can be missed.

1. The benchmark gives one row per distinct window: fingerprint, the window's
   words, and the ids of its items.  Windows shorter than ``window`` (from short
   items) are their own length class with their own k.
2. Documents are winnowed for each length that occurs.  A Bloom filter of the
   benchmark's fingerprints (bounded size; it only saves shuffling) passes the
   fingerprints worth joining; each is extended to the windows that selected it,
   spelled out in words.
3. The join of both sides is on the fingerprint and the words themselves, so a
   match is exact.  Hits are united per document.

Defined results: null and empty texts have no words and no hits; items without
words are ignored; items with a null id are ignored in the id list but their
words count as hits; rows that repeat an id and text are one result each;
equal items share windows and are all listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm import _bloom
from featuremap.llm._words import ALNUM, Words, mix, ready, slices, words
from featuremap.session import scratch_path

WINDOW = 10
#: benchmark windows are broadcast up to this size, counted before the join
BROADCAST_BYTES = 8 << 20


def _selected(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every window of ``length`` words inside a text, and the
    hash of the k-gram that winnowing keeps for it."""
    k = (length + 1) // 2
    grams = w.ngrams(k)
    n = len(w.hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = grams[:n].copy()
    for j in range(1, length - k + 1):
        np.minimum(low, grams[j:j + n], out=low)
    start = np.flatnonzero(w.whole(length))
    return start, low[start]


def _bench_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), ALNUM)
                ids, n, rows = part.column("id"), w.n_words, []
                for length in sorted({min(int(x), window) for x in n if x}):
                    start, low = _selected(w, length)
                    doc = np.searchsorted(w.first, start, side="right") - 1
                    for s, h, d in zip(start.tolist(), low.view("i8").tolist(), doc.tolist(), strict=True):
                        if min(n[d], window) == length:
                            rows.append((length, h, w.string(s, s + length), ids[d].as_py()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(
                            zip(*rows, strict=True),
                            (pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True)],
                        names=["length", "print", "words", "item"])

    return run


def bench_windows(benchmark: DataFrame, id: str = "item_id", text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """One row per distinct window: length, print, words, items."""
    rows = benchmark.select(F.col(id).cast("string").alias("id"),
                            F.col(text).cast("string").alias("text"))
    return (rows.mapInArrow(_bench_windows(window), "length int, print long, words string, item string")
            .groupBy("length", "print", "words").agg(F.collect_set("item").alias("items")))


def _candidates(lengths: list[int], bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bloom.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield _extend(part, lengths, table)

    return run


def _extend(part: pa.RecordBatch, lengths: list[int], table: np.ndarray) -> pa.RecordBatch:
    """A header row per document (words null) and a row per window to look up."""
    w = words(part.column("text"), ALNUM)
    docs = part.num_rows
    doc, length, low, at, text = [np.arange(docs)], [np.zeros(docs, np.int32)], [], [], [None] * docs
    low.append(mix(np.arange(docs, dtype=np.uint64)))       # header rows spread over the join
    at.append(np.zeros(docs, np.int64))
    for n in lengths:
        start, prints = _selected(w, n)
        if not len(start):
            continue
        ok = _bloom.test(table, prints)
        start, prints = start[ok], prints[ok]
        owner = np.searchsorted(w.first, start, side="right") - 1
        doc.append(owner)
        length.append(np.full(len(start), n, np.int32))
        low.append(prints)
        at.append(start - w.first[owner])
        text.extend(w.string(s, s + n) for s in start.tolist())
    doc, length = np.concatenate(doc), np.concatenate(length)
    return pa.RecordBatch.from_arrays(
        [part.column("id").take(pa.array(doc)), part.column("key").take(pa.array(doc)),
         pa.array(w.n_words[doc]), pa.array(length), pa.array(np.concatenate(low).view("i8")),
         pa.array(np.concatenate(at)), pa.array(text, pa.string())],
        names=["id", "key", "n_words", "length", "print", "at", "words"])


_CANDIDATE = "id {}, key long, n_words long, length int, print long, at long, words string"


def hits(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``id``, text key ``key``, ``n_words``, ``spans`` (place and
    length of the windows found, sorted), ``items`` (sorted ids as strings)."""
    spark = docs.sparkSession
    ready(spark)
    path = scratch_path(spark, "benchmark-windows")
    bench_windows(benchmark, item_id, item_text, window).write.parquet(path)
    windows = spark.read.parquet(path)
    size = windows.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("words") + F.size("items") * 40 + 64).alias("bytes"),
        F.collect_set("length").alias("lengths")).first()       # at most ``window`` lengths
    bloom = spark.sparkContext.broadcast(_bloom.build(windows, "print", size["n"]))
    if (size["bytes"] or 0) <= BROADCAST_BYTES:
        windows = F.broadcast(windows)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    found = (rows.withColumn("key", F.xxhash64("text"))
             .mapInArrow(_candidates(sorted(size["lengths"]), bloom), _CANDIDATE.format(kind))
             .join(windows, ["length", "print", "words"], "left"))
    span = F.struct(F.col("at"), F.col("length"))
    per_doc = found.groupBy("id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("length") == 0, 1)).alias("rows"),
        F.collect_set(F.when(F.col("items").isNotNull(), span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return per_doc.select(
        "id", "key", "n_words", F.sort_array("spans").alias("spans"),
        F.sort_array("items").alias("items"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_")).drop("_")


def _covered(spans: str):
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["end"], s["at"] + s["length"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(a["end"], s["at"])))
        .cast("long").alias("n")), lambda a: a["n"])


def report(found: DataFrame) -> DataFrame:
    """Counts and item digest of :func:`hits`."""
    out = found.select("id", "n_words", _covered("spans").alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
          **options) -> DataFrame:
    """The rows of ``docs`` without any hit; columns unchanged."""
    bad = (hits(docs, benchmark, id, text, **options).filter(F.size("spans") > 0)
           .select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct())
    same = docs[id].eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text].cast("string")) == bad["__key"])
    return docs.join(bad, same, "left_anti")
