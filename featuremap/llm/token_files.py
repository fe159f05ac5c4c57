"""Token ids as raw binary shards with a minimal perfect hash index.

Layout below ``path``:

``shards/``     one file per range of the documents in ascending id order (rows
                without an id first, equal ids by their text's hash): nothing
                but the ids, little-endian, two bytes each when the vocabulary
                fits, else four.  A file's name holds a random part, so a task
                that is run twice never overwrites another attempt's file; only
                files named in the directory belong to the data.
``directory/``  Parquet: id, rep (0, 1, ... among equal ids), shard, file,
                offset, n.
``meta/``       Parquet, one row: how ids are stored, the end id, index shards.
``index/``      Parquet, one row per index shard: a minimal perfect hash over
                (id, rep) with arrays by slot of 64-bit fingerprint, shard,
                offset and n.  A key costs one hash evaluation, one comparison
                and one read of exactly its bytes.

Defined results: a null or empty text has the end id only; the text of an added
token (``<|endoftext|>``) becomes that token's id, as the library's plain call has
it, or with ``literal`` ordinary pieces; repeated rows and ids each have their own
entry; an empty table gives no files and empty tables;
other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremap.llm import _mph
from featuremap.llm._words import mix, slices
from featuremap.session import ship_package

SHARD_BYTES = 16 << 20
INDEX_KEYS = 100_000
CACHE_UNITS = 400_000

#: the characters the pre-tokeniser takes as white space, for re and for RE2
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BEFORE_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")


class Encoder:
    """The library's ids; the units of a text are encoded once while they stay cached.

    A text is cut where white space follows a character that is none.  The
    pre-tokeniser's pattern always ends a match there and never looks back, so
    the ids of the text are the ids of its units in order.  Texts with an added
    token in them are left to the library as a whole; with ``literal`` special
    tokens are ordinary characters.
    """

    def __init__(self, path: str, literal: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                      if not (literal and t.special)]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = np.dtype(self.dtype).itemsize
        (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of a string column as little-endian bytes."""
        import pyarrow.compute as pc

        column = pc.fill_null(column, "")
        odd = pc.match_substring_regex(column, _BEFORE_SPACE).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(column)
        whole = np.zeros(len(column), bool)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole).tolist():
            (coded,) = self.tokenizer.encode_batch_fast([column[i].as_py()], add_special_tokens=False)
            out[i] = np.array(coded.ids, self.dtype).tobytes()
        for i in np.flatnonzero(odd & ~whole).tolist():
            out[i] = b"".join(self._ids(_UNIT.findall(column[i].as_py())))
        plain = np.flatnonzero(~odd & ~whole)
        if not len(plain):
            return out
        lists = pc.split_pattern(column.take(pa.array(plain)), " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        words = lists.flatten().dictionary_encode()
        index = words.indices.to_numpy().astype(np.int64)
        # the stop or comma after a word is a piece of its own, so the word is looked up once
        stems, mark = _stems(words.dictionary)
        stems = stems.dictionary_encode()
        # all but the first piece of a text follow a space
        units = [" " + u for u in stems.dictionary.to_pylist()]
        first = words.dictionary.take(words.indices.take(pa.array(at[:-1]))).to_pylist()
        values = self._ids(units + first + list(_MARKS))
        raw = np.frombuffer(b"".join(values), self.dtype)
        size = np.fromiter(map(len, values), np.int64, len(values)) // self.width
        start = np.cumsum(size) - size
        stem, mark = stems.indices.to_numpy().astype(np.int64)[index], mark[index]
        stem[at[:-1]], mark[at[:-1]] = len(units) + np.arange(len(first)), -1
        pieces = 1 + (mark >= 0)
        place = np.cumsum(pieces) - pieces
        index = np.empty(place[-1] + pieces[-1], np.int64)
        index[place] = stem
        index[place[mark >= 0] + 1] = len(units) + len(first) + mark[mark >= 0]
        n = size[index]
        end = np.cumsum(n)
        ids = raw[np.repeat(start[index] - (end - n), n) + np.arange(end[-1])]
        last = at[1:] - 1
        for i, lo, hi in zip(plain.tolist(), (end - n)[place[at[:-1]]].tolist(),
                             end[place[last] + pieces[last] - 1].tolist(), strict=True):
            out[i] = ids[lo:hi].tobytes()
        return out

    def _ids(self, units: list[str]) -> list[bytes]:
        if len(self.young) > CACHE_UNITS:
            self.young, self.old = {"": b""}, self.young
        young, old = self.young, self.old
        out = [young.get(u) for u in units]
        new = {}
        for i, v in enumerate(out):
            if v is None:
                u = units[i]
                if (v := old.get(u)) is None:
                    new[u] = None
                else:
                    young[u] = out[i] = v
        if new:
            split = {u: parts for u in new if ("\n" in u or u.endswith(_MARKS)) and len(parts := _parts(u)) > 1}
            todo = dict.fromkeys(p for u in new for p in split.get(u, (u,)))
            for u in list(todo):
                if (v := young.get(u) or old.get(u)) is not None:
                    young[u] = v
                    del todo[u]
            # a line feed is a token of its own between other characters and before a space
            bare = [u for u in todo if u.split() == [u.removeprefix(" ")]]
            for lo in range(0, len(bare), 1000):
                part = bare[lo:lo + 1000]
                (coded,) = self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)
                raw = np.array(coded.ids, self.dtype)
                cut = [-1, *np.flatnonzero(raw == self.line).tolist(), len(raw)]
                if len(cut) != len(part) + 1:
                    raise AssertionError("a unit holds a line feed")
                raw, width = raw.tobytes(), self.width
                young.update((u, raw[(i + 1) * width:j * width]) for u, i, j in zip(part, cut, cut[1:], strict=False))
            rest = [u for u in todo if u not in young]
            for u, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
                young[u] = np.array(coded.ids, self.dtype).tobytes()
            young.update((u, b"".join([young[p] for p in parts])) for u, parts in split.items())
            out = [young[u] if v is None else v for u, v in zip(units, out, strict=True)]
        return out


_MARKS = (".", ",")
_LATIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+[.,]$"


def _stems(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without the stop or comma after Latin letters, where the pattern ends a
    match; and which of ``_MARKS`` that is, or -1.  Other words are left to :func:`_parts`."""
    import pyarrow.compute as pc

    mark = np.full(len(words), -1, np.int64)
    marked = pc.match_substring_regex(words, _LATIN)
    for i, m in enumerate(_MARKS):
        mark[pc.and_(marked, pc.ends_with(words, m)).to_numpy(zero_copy_only=False)] = i
    return pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words), mark


def _parts(unit: str) -> list[str]:
    """A unit at its line feeds between other characters, and before a full stop or
    comma after letters: there the pattern ends a match too."""
    out = []
    lines = unit.split("\n")
    if len(lines) > 1 and any(not x or x[0].isspace() or x[-1].isspace() for x in (lines[0].removeprefix(" "), *lines[1:])):
        return [unit]
    for i, line in enumerate(lines):
        if i:
            out.append("\n")
        word = line[:-1]
        if line[-1:] in (".", ",") and word.removeprefix(" ").isalpha():
            out += [word, line[-1]]
        else:
            out.append(line)
    return out


@lru_cache(maxsize=2)
def encoder(path: str, literal: bool = False) -> Encoder:
    return Encoder(path, literal)


def _filesystem(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path)))


_DIRECTORY = "id long, rep long, shard int, file string, offset long, n long"


def _write(tokenizer: str, folder: str, end_id: int, literal: bool):
    """Encode a range of documents into one file; a directory row for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, literal)
        system, base = _filesystem(folder)
        shard = TaskContext.get().partitionId()
        name, out = f"{shard:06d}-{uuid.uuid4().hex}.ids", None
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.width
        offset, last, rep = 0, object(), 0
        try:
            for batch in batches:
                for part in slices(batch, "text", SHARD_BYTES):
                    if out is None:
                        out = system.open_output_stream(f"{base}/{name}")
                    raw = [x + end for x in enc.encode(part.column("text"))]
                    out.write(b"".join(raw))
                    ids, reps = part.column("id"), []
                    for i in ids.to_pylist():
                        rep = rep + 1 if i == last else 0
                        last = i
                        reps.append(rep)
                    n = np.array([len(x) // width for x in raw], np.int64)
                    rows = len(raw)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(reps, pa.int64()), pa.array([shard] * rows, pa.int32()),
                         pa.array([name] * rows), pa.array(offset + np.cumsum(n) - n), pa.array(n)],
                        names=["id", "rep", "shard", "file", "offset", "n"])
                    offset += int(n.sum())
        finally:
            if out is not None:
                out.close()

    return run


def _key(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of (id, rep); rows without an id have their own seed."""
    import pyarrow.compute as pc

    none = pc.is_null(table.column("id")).to_numpy(zero_copy_only=False)
    i = pc.fill_null(table.column("id"), 0).to_numpy().astype("<i8").view("u8")
    rep = table.column("rep").to_numpy().astype("<i8").view("u8")
    a = mix(mix(i + none.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ rep)
    return a, mix(a ^ mix(i ^ np.uint64(0x5851F42D4C957F2D)) ^ none.astype(np.uint64))


_INDEX = "part int, hash binary, fingerprints binary, shards binary, offsets binary, counts binary"


def _build(table: pa.Table) -> pa.Table:
    a, b = _key(table)
    f = _mph.build(a, b)
    at = _mph.Mph(f).slots(a, b)
    out = {"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "hash": [f]}
    for name, values in (("fingerprints", b), ("shards", table.column("shard").to_numpy().astype("<i4")),
                         ("offsets", table.column("offset").to_numpy().astype("<i8")),
                         ("counts", table.column("n").to_numpy().astype("<i8"))):
        by_slot = np.empty_like(values)
        by_slot[at] = values
        out[name] = [by_slot.tobytes()]
    return pa.table(out)


_META = "dtype string, end_id int, parts int"


def _part(parts: int):
    return F.pmod(F.xxhash64("id", "rep"), F.lit(parts)).cast("int")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id: str = "doc_id",
          text: str = "text", literal: bool = False) -> None:
    """Write shards, directory and index of ``docs`` below ``path``, a folder all
    executors share; with ``literal`` special tokens in a text are ordinary characters."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / SHARD_BYTES))
    system, base = _filesystem(f"{path}/shards")
    system.create_dir(base, recursive=True)
    order = ["id", F.xxhash64("text")]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .mapInArrow(_write(tokenizer, f"{path}/shards", end_id, literal), _DIRECTORY)
     .write.parquet(f"{path}/runs"))
    # equal ids may run on into the next shard: one row per shard says how many came before
    runs = spark.read.schema(_DIRECTORY).parquet(f"{path}/runs")
    edge = runs.groupBy("shard").agg(
        F.min(F.struct("offset", "id")).alias("first"), F.max(F.struct("offset", "id", "rep")).alias("last")
    ).orderBy("shard").collect()
    carry, before, seen = [], object(), 0
    for e in edge:
        if e.first.id == before:
            carry.append((e.shard, e.first.id, seen))
        seen = (seen if e.first.id == before and e["last"].id == before else 0) + e["last"].rep + 1
        before = e["last"].id
    shift = spark.createDataFrame(carry, "shard int, first long, more long")
    fixed = (runs.join(F.broadcast(shift), "shard", "left")
             .withColumn("rep", F.col("rep") + F.when(
                 F.col("more").isNotNull() & F.col("id").eqNullSafe(F.col("first")), F.col("more"))
                 .otherwise(0)).select(*runs.columns))
    fixed.write.parquet(f"{path}/directory")
    keys = directory(spark, path)
    parts = max(1, math.ceil(keys.count() / INDEX_KEYS))
    (keys.withColumn("part", _part(parts)).groupBy("part").applyInArrow(_build, _INDEX)
     .write.parquet(f"{path}/index"))
    spark.createDataFrame([(encoder(tokenizer, literal).dtype, end_id, parts)], _META).write.parquet(f"{path}/meta")


def _probe(keys: pa.Table, index: pa.Table) -> pa.Table:
    a, b = _key(keys)
    slot = np.full(len(a), -1, np.int64)
    columns = {c: np.zeros(0, t) for c, t in (("shards", "<i4"), ("offsets", "<i8"), ("counts", "<i8"))}
    if index.num_rows:
        row = {c: index.column(c)[0].as_py() for c in index.schema.names}
        slot = _mph.Mph(row["hash"]).slots(a, b)
        fingerprint = np.frombuffer(row["fingerprints"], "<u8")
        hit = slot >= 0
        slot[hit] = np.where(fingerprint[slot[hit]] == b[hit], slot[hit], -1)
        columns = {c: np.frombuffer(row[c], v.dtype) for c, v in columns.items()}
    ok = slot >= 0
    return pa.table({"id": keys.column("id").filter(pa.array(ok)), "rep": keys.column("rep").filter(pa.array(ok)),
                     **{c: pa.array(v[slot[ok]]) for c, v in columns.items()}})


def _fetch(folder: str, dtype: str, digest: bool):
    """Read each document's bytes from its shard's file."""
    def run(table: pa.Table) -> pa.Table:
        system, base = _filesystem(folder)
        width, out = np.dtype(dtype).itemsize, []
        table = table.sort_by("offsets")
        with system.open_input_file(f"{base}/{table.column('file')[0].as_py()}") as f:
            for at, n in zip(table.column("offsets").to_pylist(), table.column("counts").to_pylist(), strict=True):
                raw = np.frombuffer(f.read_at(n * width, at * width), dtype).astype("<u4")
                out.append(zlib.crc32(raw.tobytes()) if digest else raw.astype(np.int32))
        values = pa.array(out, pa.int64() if digest else pa.list_(pa.int32()))
        return pa.table({**{c: table.column(c) for c in ("id", "rep", "shard", "offsets", "counts")},
                         "value": values})

    return run


def directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DIRECTORY).parquet(f"{path}/directory")


def lookup(spark: SparkSession, path: str, keys: DataFrame, digest: bool = False) -> DataFrame:
    """(id, rep, start, n, value) for the keys (id, rep) that exist; ``value`` is the
    array of ids or, with ``digest``, their CRC-32 as 32-bit integers; ``start``
    counts the ids of all documents before."""
    ship_package(spark)
    shards = directory(spark, path).groupBy("shard").agg(F.min("file").alias("file"), F.sum("n").alias("total")) \
        .orderBy("shard").collect()             # one row per file
    base, files = 0, []
    for s in shards:
        files.append((s.shard, s.file, base))
        base += s.total
    files = spark.createDataFrame(files, "shard int, file string, base long")
    index = spark.read.schema(_INDEX).parquet(f"{path}/index")
    meta = spark.read.schema(_META).parquet(f"{path}/meta").first()
    found = (keys.select("id", "rep").withColumn("part", _part(meta.parts)).groupBy("part")
             .cogroup(index.groupBy("part"))
             .applyInArrow(_probe, "id long, rep long, shards int, offsets long, counts long")
             .withColumnRenamed("shards", "shard").join(files.drop("base"), "shard"))
    kind = "long" if digest else "array<int>"
    read = found.groupBy("file").applyInArrow(
        _fetch(f"{path}/shards", meta.dtype, digest),
        f"id long, rep long, shard int, offsets long, counts long, value {kind}")
    return read.join(files, "shard").select(
        "id", "rep", (F.col("base") + F.col("offsets")).alias("start"), F.col("counts").alias("n"), "value")
