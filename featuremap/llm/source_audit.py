"""Divergence of the sources of each language, recounted on minimal perfect hashes.

1. Exact frequency filter: every (lang, term) with its number of documents, counted
   per task first; terms of ``min_docs`` documents or more are kept.
2. The kept terms of a language are dealt to shards by hash.  A shard is one row: a
   minimal perfect hash over 128-bit digests, and the terms themselves by slot.
3. The shards are broadcast in batches of at most ``BROADCAST_BYTES``, as many batches
   as the vocabulary needs.  A pass over the documents per batch counts into dense
   arrays, one slot a term for each (lang, source) it meets; the stored term is
   compared first, so a term that was not kept never counts.
4. Slots travel packed by blocks, (lang, block of slots, source), and are added up one
   at a time.  A block holds every source's counts of its terms; its width leaves room
   for all sources of the language.  Probabilities are exact integers (Python's where
   they could pass 64 bits).  Each block returns its part of the sum for a pair of
   sources and the best terms of each source; these are added up and ranked.

Defined results: null text, lang and source are empty strings, which are a language
and a source like others; a text without terms still makes its (lang, source) occur;
a language without kept terms has only its pairs, with value 0, and a lone source has
no pairs; equal values are ranked by the item's bytes; repeated rows are documents of
their own; other columns are ignored, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremap.llm import _mph
from featuremap.llm._words import ready, slices, trim
from featuremap.session import scratch_path

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
SHARD_TERMS = 50_000
BROADCAST_BYTES = 48 << 20
HELD_TERMS = 200_000            # distinct terms that a task holds before it sends them
HELD_WORDS = 4_000_000          # occurrences that a task holds before it counts them
DENSE_BYTES = 96 << 20          # of a task's dense arrays
BLOCK_VALUES = 1 << 18          # sources x slots of a block

_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
INDEX = "lang string, shard int, shards int, size long, hash binary, ends binary, terms binary"


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, lower-cased, and non-ASCII characters."""
    return text.translate(_TERM).split() if text else []


def _digests(lang: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    person = hashlib.blake2b(lang.encode(), digest_size=16).digest()
    both = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16, person=person).digest()
                                  for t in found), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _document_counts(held_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                if c:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(c), pa.string()), _strings(list(c)),
                         pa.array(list(c.values()), pa.int64())], names=["lang", "term", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    held.setdefault(lang, Counter()).update(set(terms(text)))
                if sum(map(len, held.values())) > held_terms:
                    yield from give()
        yield from give()
        trim()

    return run


def _build(table: pa.Table) -> pa.Table:
    lang = table.column("lang")[0].as_py()
    found = [t.encode() for t in table.column("term").to_pylist()]
    a, b = _digests(lang, found)
    f = _mph.build(a, b)
    by_slot = [b""] * len(found)
    for slot, t in zip(_mph.Mph(f).slots(a, b).tolist(), found, strict=True):
        by_slot[slot] = t
    ends = np.cumsum([len(t) for t in by_slot], dtype="<i8")
    return pa.table({"lang": [lang], **{c: pa.array([table.column(c)[0].as_py()], pa.int32())
                                        for c in ("shard", "shards")}, "size": [len(found)],
                     "hash": [f], "ends": [ends.tobytes()], "terms": [b"".join(by_slot)]})


def build_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The stored index of the kept terms of ``docs`` (lang, source, text), a row per
    shard."""
    spark = docs.sparkSession
    kept, at = scratch_path(spark, "audit-terms"), scratch_path(spark, "audit-index")
    (docs.select("lang", "text").mapInArrow(_document_counts(HELD_TERMS), "lang string, term string, n long")
     .groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
     .select("lang", "term").write.parquet(kept))
    rows = spark.read.parquet(kept)
    # the languages of more than one shard are fewer than kept terms / SHARD_TERMS
    large = (rows.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_TERMS).cast("int").alias("shards"))
             .filter("shards > 1"))
    dealt = rows.join(F.broadcast(large), "lang", "left").withColumn(
        "shards", F.coalesce("shards", F.lit(1))).withColumn(
        "shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
    dealt.groupBy("lang", "shard").applyInArrow(_build, INDEX).write.parquet(at)
    return spark.read.schema(INDEX).parquet(at)


class Shard:
    """One shard in a task: terms to slots, verified by the stored terms."""

    def __init__(self, hash: bytes, ends: bytes, stored: bytes):
        self.hash, self.stored = _mph.Mph(hash), stored
        self.ends = np.frombuffer(ends, "<i8")
        self.size = len(self.ends)

    def slots(self, a: np.ndarray, b: np.ndarray, found: list[bytes]) -> np.ndarray:
        out = self.hash.slots(a, b)
        hit = np.flatnonzero(out >= 0)
        end = self.ends[out[hit]]
        start = np.where(out[hit] > 0, self.ends[out[hit] - 1], 0)
        stored = self.stored
        out[[i for i, x, y in zip(hit.tolist(), start.tolist(), end.tolist(), strict=True)
             if stored[x:y] != found[i]]] = -1
        return out


class _Ids(dict):
    """Numbers the terms it is asked for."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class _Recount:
    """Dense counts of a task, an array for each (lang, source) and shard."""

    def __init__(self, shards: list[tuple], dense_bytes: int):
        self.dense_bytes, self.index, self.of, self.shape = dense_bytes, {}, {}, {}
        for lang, shard, of, width, per_shard, *data in shards:
            self.index[lang, shard], self.of[lang], self.shape[lang] = Shard(*data), of, (width, per_shard)
        self.ids: dict[str, _Ids] = {}
        self.held: dict[tuple[str, str], list[np.ndarray]] = {}
        self.words = 0
        self.dense: dict[tuple[str, str, int], np.ndarray] = {}

    def add(self, lang: str, source: str, text: bytes | None) -> None:
        if lang in self.of and (found := terms(text)):
            ids = self.ids.setdefault(lang, _Ids())
            self.held.setdefault((lang, source), []).append(
                np.fromiter(map(ids.__getitem__, found), np.uint32, len(found)))
            self.words += len(found)

    def count(self) -> Iterator[pa.RecordBatch]:
        """Increment the slots of what is held; rows where the arrays get too large."""
        place = {lang: self._places(lang, list(ids)) for lang, ids in self.ids.items()}
        for (lang, source), held in self.held.items():
            shard, slot = (x[np.concatenate(held)] for x in place[lang])
            for s in np.unique(shard[slot >= 0]).tolist():
                at = slot[(shard == s) & (slot >= 0)]
                counts = self.dense.get((lang, source, s))
                if counts is None:
                    counts = self.dense[lang, source, s] = np.zeros(self.index[lang, s].size, np.int64)
                counts += np.bincount(at, minlength=len(counts))
            if sum(x.nbytes for x in self.dense.values()) > self.dense_bytes:
                yield from self.give()
        self.held.clear()
        self.ids.clear()
        self.words = 0

    def _places(self, lang: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each term; slot -1 for terms that are not in a shard of this pass."""
        a, b = _digests(lang, found)
        shard, slot = _shard_of(found, self.of[lang]), np.full(len(found), -1, np.int64)
        for s in np.unique(shard).tolist():
            if (lang, s) in self.index:
                at = np.flatnonzero(shard == s)
                slot[at] = self.index[lang, s].slots(a[at], b[at], [found[i] for i in at.tolist()])
        return shard, slot

    def give(self) -> Iterator[pa.RecordBatch]:
        for (lang, source, shard), counts in self.dense.items():
            width, per_shard = self.shape[lang]
            rows = []
            for k in range(0, len(counts), width):
                part = counts[k:k + width]
                at = np.flatnonzero(part)
                if len(at):
                    rows.append((lang, shard * per_shard + k // width, source, *_pack(at, part[at])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PACKED, strict=True)],
                    names=["lang", "block", "source", "at", "n"])
        self.dense.clear()


_PACKED = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary())
PACKED = "lang string, block long, source string, at binary, n binary"


def _pack(at: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return at.astype("<u4").tobytes(), n.astype("<i8").tobytes()


def _unpack(at: bytes | None, n: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(at or b"", "<u4"), np.frombuffer(n or b"", "<i8")


def _shard_of(found: list[bytes], shards: int) -> np.ndarray:
    """The shard of each term, as Spark's pmod(xxhash64(term), shards) deals it."""
    if shards == 1:
        return np.zeros(len(found), np.int64)
    h = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in found), np.uint64, len(found))
    return h.view(np.int64) % shards


def _recount(shards, held_terms: int, held_words: int, dense_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            counts = counts or _Recount(shards.value, dense_bytes)
            for part in slices(batch, "text"):
                for row in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    counts.add(*row)
                if counts.words > held_words or sum(map(len, counts.ids.values())) > held_terms:
                    yield from counts.count()
        if counts:
            yield from counts.count()
            yield from counts.give()
        trim()

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each (lang, block, source) of sorted rows."""
    key, total = None, np.zeros(0, np.int64)

    def give() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        row = (*key, *_pack(at, total[at]))
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], t) for v, t in zip(row, _PACKED, strict=True)), pa.array([int(total.sum())])],
            names=["lang", "block", "source", "at", "n", "total"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "source", "at", "n")), strict=True):
            if row[:3] != key:
                if key is not None:
                    yield give()
                key, total = row[:3], np.zeros(0, np.int64)
            at, n = _unpack(*row[3:])
            if at[-1] >= len(total):
                total = np.concatenate([total, np.zeros(at[-1] + 1 - len(total), np.int64)])
            total[at] += n          # the slots of one row are distinct
    if key is not None:
        yield give()
    trim()


def recount(docs: DataFrame, index: DataFrame) -> DataFrame:
    """(lang, block, source, at, n, total), stored: the counts of every block and source
    that has some.  ``index`` has each language's ``width`` and ``per_shard`` too."""
    spark = docs.sparkSession
    size = F.octet_length("hash") + F.octet_length("ends") + F.octet_length("terms")
    # a row for every SHARD_TERMS terms of a language
    names = index.select("lang", "shard", size.alias("bytes")).orderBy("lang", "shard").collect()
    batches, room = [], 0
    for r in names:
        if not batches or room < r["bytes"]:
            batches.append([])
            room = BROADCAST_BYTES
        batches[-1].append((r["lang"], r["shard"]))
        room -= r["bytes"]
    path = scratch_path(spark, "audit-counts")
    key = F.struct("lang", "shard")
    for batch in batches:
        mine = index.filter((key >= _pair(*batch[0])) & (key <= _pair(*batch[-1])))
        shards = spark.sparkContext.broadcast([tuple(r) for r in mine.select(
            "lang", "shard", "shards", "width", "per_shard", "hash", "ends", "terms").collect()])
        keys = ["lang", "block", "source"]
        (docs.mapInArrow(_recount(shards, HELD_TERMS, HELD_WORDS, DENSE_BYTES), PACKED)
         .repartition(*keys).sortWithinPartitions(*keys)
         .mapInArrow(_add_up, PACKED + ", total long").write.mode("append").parquet(path))
        shards.unpersist()
    if not batches:
        spark.createDataFrame([], PACKED + ", total long").write.parquet(path)
    return spark.read.schema(PACKED + ", total long").parquet(path)


def _pair(lang: str, shard: int) -> Column:
    return F.struct(F.lit(lang).alias("lang"), F.lit(shard).cast("int").alias("shard"))


def _p(n: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exactly."""
    if n.size and n.max() >= 2 ** 63 // SCALE - 1:
        n = n.astype(object)
    return (1 + SCALE * (n + 1) // (total + kept)).astype(np.int64)


def _block(top: int):
    """A block's part of the sums for every two sources, and the ``top`` terms of each."""
    def run(groups: pa.Table, names: pa.Table) -> pa.Table:
        lang, sources = groups.column("lang")[0].as_py(), groups.column("source").to_pylist()
        found = names.column("terms")[0].as_py() if names.num_rows else b""
        found = found.split(b" ") if found else []
        n = np.zeros((len(sources), len(found)), np.int64)
        for i, row in enumerate(zip(groups.column("at").to_pylist(), groups.column("n").to_pylist(), strict=True)):
            at, counts = _unpack(*row)
            n[i, at] = counts
        kept = groups.column("n_terms")[0].as_py()
        lang_total = groups.column("lang_total")[0].as_py()
        p = _p(n, groups.column("total").to_numpy()[:, None], kept) if found else n
        q = _p(n.sum(0), lang_total, kept) if found else n[:0].sum(0)
        order = np.empty(len(found), np.int64)
        order[sorted(range(len(found)), key=found.__getitem__)] = np.arange(len(found))
        source, item, value, part = [], [], [], []
        for i, name in enumerate(sources):
            sums = ((p[i] - p) ** 2 // p).sum(1).tolist()
            item += sources[:i] + sources[i + 1:]
            value += sums[:i] + sums[i + 1:]
            at = np.flatnonzero((n[i] > 0) & (p[i] > q))
            over = (p[i, at] - q[at]) ** 2 // q[at]
            best = np.lexsort((order[at], -over))[:top]
            item += [found[k].decode() for k in at[best].tolist()]
            value += over[best].tolist()
            part += ["pair"] * (len(sources) - 1) + ["term"] * len(best)
            source += [name] * (len(part) - len(source))
        text = lambda x: pa.array(x, pa.string())
        return pa.table({"lang": text([lang] * len(part)), "source": text(source), "part": text(part),
                         "item": text(item), "value": pa.array(value, pa.int64())})

    return run


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of every block, by slot; terms hold no space."""
    for batch in batches:
        for lang, shard, width, per_shard, ends, stored in zip(*(batch.column(c).to_pylist() for c in (
                "lang", "shard", "width", "per_shard", "ends", "terms")), strict=True):
            ends = np.frombuffer(ends, "<i8").tolist()
            found = [stored[x:y] for x, y in zip([0, *ends], ends, strict=False)]
            blocks = [b" ".join(found[k:k + width]) for k in range(0, len(found), width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(blocks), pa.string()), pa.array(np.arange(len(blocks)) + shard * per_shard),
                 pa.array(blocks, pa.binary())], names=["lang", "block", "terms"])


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: per (lang, source) all other sources of the
    language (part ``pair``) and its ``top`` most over-represented terms (``term``)."""
    spark = docs.sparkSession
    ready(spark)
    own = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = docs.select(own(lang).alias("lang"), own(source).alias("source"),
                       own(text).cast("binary").alias("text"))
    index = build_index(docs, min_docs)
    groups = docs.select("lang", "source").distinct()
    sizes = index.groupBy("lang").agg(F.sum("size").alias("n_terms"), F.max("size").alias("largest"),
                                      F.first("shards").alias("shards"))
    sizes = (groups.groupBy("lang").agg(F.count("*").alias("n_sources")).join(sizes, "lang", "left")
             .fillna({"n_terms": 0, "largest": 0, "shards": 1}))
    # slots of a block: as many as the language's sources leave room for
    sizes = sizes.withColumn("width", F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.col("n_sources"))))
    sizes = sizes.withColumn("per_shard", F.greatest(F.lit(1), F.ceil(F.col("largest") / F.col("width"))))
    path = scratch_path(spark, "audit-sizes")
    sizes.select("lang", "n_terms", "shards", "width", "per_shard").write.parquet(path)
    sizes = spark.read.parquet(path)
    wide = index.join(sizes.select("lang", "width", "per_shard"), "lang")
    counts = recount(docs, wide)

    total = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    total = groups.join(total, ["lang", "source"], "left").fillna({"total": 0})
    total = total.join(total.groupBy("lang").agg(F.sum("total").alias("lang_total")), "lang").join(sizes, "lang")
    # a language without kept terms has one empty block, for its pairs
    blocks = F.sequence(F.lit(0).cast("long"), F.col("shards") * F.col("per_shard") - 1)
    total = total.select("lang", "source", "total", "lang_total", "n_terms", F.explode(blocks).alias("block"))
    rows = total.join(counts.drop("total"), ["lang", "block", "source"], "left")
    names = wide.select("lang", "shard", "width", "per_shard", "ends", "terms").mapInArrow(
        _names, "lang string, block long, terms binary")
    found = (rows.groupBy("lang", "block").cogroup(names.groupBy("lang", "block"))
             .applyInArrow(_block(top), "lang string, source string, part string, item string, value long"))
    # each term is in one block; the pairs' parts are added up
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (found.withColumn("rank", F.row_number().over(order))
            .filter((F.col("part") == "pair") | (F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", "rank"))
