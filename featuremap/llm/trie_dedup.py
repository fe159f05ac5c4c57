"""Exact duplicates by owners in Patricia tries.

1. The texts' lengths and 128-bit content hashes are counted once; the few hashes
   that hold a thousandth of all rows or more (1,000 at most, so the list is
   bounded) are *hot*.
2. Every task inserts the whole byte strings it reads into a trie and sends each
   distinct text on once, with the owner among its copies and their number.
3. Partitions by length and content hash insert those strings into compressed
   radix tries.  A terminal node keeps the owner, the largest or the smallest id,
   and the number of copies.  Hot texts are salted by the task that read them
   first, so no partition gets one copy from every task; a second round merges them.
4. A trie above ``TRIE_BYTES`` spills its heaviest subtree: the strings below that
   prefix leave as rows of the next round, which has a trie for each subtree.
   Rounds are written to the shared folder and end when no string is open.
5. Documents find their owner by length and hash.  Two texts that share both (the
   tries tell them apart) are grouped by the text itself.

Defined results: a null text is an empty text, and empty texts are equal; ids of
any orderable type, a null id is below all others and owns a text only if no copy
has an id (then ``keep_id`` is null and all of them stay); rows that repeat an id
and a text are one document twice, each row gets the same verdict and counts in
``group_size``; texts of any length are compared whole; an empty table gives no
rows; other columns are kept by :func:`mark` and :func:`dedup`, but those named
like a result column give way to it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from featuremap.llm._words import ready, slices, trim
from featuremap.session import scratch_path

TRIE_BYTES = 96 << 20
SLICE_TRIE_BYTES = 16 << 20
PARTITION_BYTES = 32 << 20
MAX_PARTITIONS = 50_000     # beyond, partitions grow and spill by subtree
HOT_SHARE = 1000
OUT_BYTES = 4 << 20
RESULT = ("keep_id", "group_size", "kept", "text_sha256")
_KEY = ("size", "a", "b")


class _Node:
    """An edge's label and what lies below it; ``n`` copies end here."""

    __slots__ = ("key", "kids", "label", "n", "owner", "spilled")

    def __init__(self, label: bytes):
        self.label, self.kids, self.n, self.owner, self.key = label, {}, 0, None, None
        self.spilled = False


def _shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``text[at:]``, which differ."""
    lo, hi = 0, min(len(label), len(text) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if text.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


_NODE = 64          # bytes a string is counted with besides its labels


class Trie:
    """Compressed radix trie of byte strings; ``better(x, y)`` picks an owner."""

    def __init__(self, better: Callable):
        self.root, self.better = _Node(b""), better
        self.bytes = self.strings = 0

    def insert(self, text: bytes, owner, n: int, key: tuple) -> bytes | None:
        """None, or the longest prefix of the string whose subtree was spilled."""
        node, at, spilled = self.root, 0, 0 if self.root.spilled else None
        while at < len(text):
            child = node.kids.get(text[at])
            if child is not None and text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                spilled = at if node.spilled else spilled
            elif spilled is not None:
                break
            elif child is None:
                child = node.kids[text[at]] = _Node(text[at:])
                self.bytes += len(text) - at
                node, at = child, len(text)
            else:
                k = _shared(child.label, text, at)
                fork = _Node(child.label[:k])
                child.label = child.label[k:]
                fork.kids[child.label[0]] = child
                node.kids[text[at]] = fork
                node, at = fork, at + k
        if spilled is not None:
            return text[:spilled]
        if not node.n:
            node.owner, node.key = owner, key
            self.strings += 1
            self.bytes += _NODE
        elif owner is not None:
            node.owner = owner if node.owner is None else self.better(node.owner, owner)
        node.n += n
        return None

    def walk(self, node: _Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, _Node]]:
        """Every terminal node with its string, from ``node`` on (``prefix`` leads to it)."""
        todo = [(node or self.root, prefix)]
        while todo:
            node, path = todo.pop()
            if node.n:
                yield path, node
            todo.extend((kid, path + kid.label) for kid in node.kids.values())

    def _weigh(self) -> dict[_Node, int]:
        """Bytes of each subtree that holds a string."""
        order, weight = [self.root], {}
        for node in order:
            order.extend(node.kids.values())
        for node in reversed(order):
            below = sum(weight.get(kid, 0) for kid in node.kids.values())
            if below or node.n:
                weight[node] = below + len(node.label) + _NODE * (node.n > 0)
        return weight

    def spill(self) -> tuple[bytes, list[tuple[bytes, _Node]]]:
        """Take out the heaviest subtree that is at most half of the trie, or else the
        heaviest string: its prefix and its strings.  :meth:`insert` refuses later strings
        with that prefix; those of a subtree spilled before keep that one's prefix."""
        weight = self._weigh()
        node, prefix, half = self.root, b"", weight[self.root] / 2
        while live := [kid for kid in node.kids.values() if kid in weight]:
            node = max(live, key=weight.get)
            prefix += node.label
            if weight[node] <= half:
                break
        gone = [(text, x.key, x.owner, x.n) for text, x in self.walk(node, prefix)]
        node.spilled = True
        self._clear(node)
        self.strings -= len(gone)
        self.bytes = self._weigh().get(self.root, 0)
        return prefix, gone

    def _clear(self, node: _Node) -> None:
        """Leave only the ways to subtrees spilled before."""
        order = [node]
        for x in order:
            order.extend(x.kids.values())
        for x in reversed(order):
            x.n, x.owner, x.key = 0, None, None
            x.kids = {c: kid for c, kid in x.kids.items() if kid.spilled or kid.kids}


class _Rows:
    """Output rows, given away in batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += 64 + len(row[-1] or b"")
        if self.bytes > OUT_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows, self.bytes = [], 0


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    cols = [batch.column(c).to_pylist() for c in (*_KEY, "owner", "n", "text")]
    return zip(*cols, strict=True)


def _combine(better: Callable):
    """Distinct texts of a task's rows, a trie of bounded size at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out = Trie(better), None
        for batch in batches:
            out = out or _Rows(batch.schema)
            for part in slices(batch, "text"):
                for size, a, b, owner, n, text in _read(part):
                    trie.insert(text, owner, n, (size, a, b))
                if trie.bytes > SLICE_TRIE_BYTES:
                    for text, x in trie.walk():
                        yield from out.add((*x.key, x.owner, x.n, text))
                    trie = Trie(better)
        for text, x in trie.walk():
            yield from out.add((*x.key, x.owner, x.n, text))
        if out:
            yield from out.flush()
        trim()

    return run


def _own(better: Callable, schema: pa.Schema, first: bool):
    """The owners of a partition's texts.  Open rows (``part`` set) are those of spilled
    subtrees and, in the first round, salted ones; they carry their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, tries = _Rows(schema), {}
        for batch in batches:
            for piece in slices(batch, "text"):
                for part, row in zip(piece.column("part").to_pylist(), _read(piece), strict=True):
                    trie = tries.get(part) or tries.setdefault(part, Trie(better))
                    size, a, b, owner, n, text = row
                    prefix = trie.insert(text, owner, n, (size, a, b))
                    if prefix is not None:
                        yield from out.add((_subtree(part, prefix), *row))
                while sum(t.bytes for t in tries.values()) > TRIE_BYTES:
                    part, trie = max(tries.items(), key=lambda x: x[1].bytes)
                    if trie.strings < 2:
                        break
                    prefix, gone = trie.spill()
                    for text, key, owner, n in gone:
                        yield from out.add((_subtree(part, prefix), *key, owner, n, text))
        for part, trie in tries.items():
            salted = first and part != _WHOLE
            for text, x in trie.walk():
                yield from out.add((_WHOLE if salted else None, *x.key, x.owner, x.n, text if salted else None))
        yield from out.flush()
        trim()

    return run


_WHOLE = -1         # part of the rows that are not salted and of no subtree


def _subtree(part: int, prefix: bytes) -> int:
    """A number for the subtree below ``prefix`` of the trie of ``part``."""
    return xxhash.xxh64_intdigest(b"%d," % part + prefix) >> 1


def _larger(x, y):
    return x if x > y else y


def _smaller(x, y):
    return x if x < y else y


def content_hash(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _keyed(docs: DataFrame, id: str, text: str, *more: Column) -> DataFrame:
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    a, b = content_hash(t)
    return docs.select(F.octet_length(t).cast("long").alias("size"), a.alias("a"), b.alias("b"),
                       F.col(f"`{id}`").alias("owner"), t.alias("text"), *more)


def _same(a: str, b: str) -> Column:
    return F.expr(" AND ".join(f"{a}.{c} = {b}.{c}" for c in _KEY))


def owners(docs: DataFrame, id: str = "doc_id", text: str = "text",
           keep: str = "largest") -> tuple[DataFrame, DataFrame]:
    """(size, a, b, owner, n) of every distinct text, read from the shared folder; and
    (size, a, b) of the hot texts, :data:`HOT_SHARE` rows at most."""
    spark = docs.sparkSession
    ready(spark)
    better = {"largest": _larger, "smallest": _smaller}[keep]
    keyed = _keyed(docs, id, text)
    at = scratch_path(spark, "text-keys")
    keyed.groupBy(*_KEY).agg(F.count("*").alias("n")).write.parquet(at)
    counted = spark.read.parquet(at)
    total = counted.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("size") + 64)).alias("bytes")).first()
    rows, size = total["n"] or 0, total["bytes"] or 0
    at = scratch_path(spark, "hot-texts")
    counted.filter(F.col("n") >= max(2, math.ceil(rows / HOT_SHARE))).select(*_KEY).write.parquet(at)
    hot = spark.read.parquet(at)

    tasks = min(MAX_PARTITIONS, max(math.ceil(size / PARTITION_BYTES), spark.sparkContext.defaultParallelism))
    fields = [*(T.StructField(c, T.LongType()) for c in _KEY), T.StructField("owner", docs.schema[id].dataType),
              T.StructField("n", T.LongType()), T.StructField("text", T.BinaryType())]
    schema = T.StructType([T.StructField("part", T.LongType()), *fields])
    arrow = to_arrow_schema(schema)
    sent = (keyed.select(*_KEY, "owner", F.lit(1).cast("long").alias("n"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(_combine(better), T.StructType(fields)))
    salt = F.pmod(F.spark_partition_id(), F.lit(math.isqrt(tasks) + 1)).cast("long")
    open_ = (sent.withColumn("salt", salt).alias("x")
             .join(F.broadcast(hot).alias("h"), _same("x", "h"), "left")
             .select(F.when(F.col("h.size").isNotNull(), F.col("salt")).otherwise(F.lit(_WHOLE)).alias("part"),
                     *(F.col(f"x.{f.name}") for f in fields)))
    rounds = []
    while True:
        path = scratch_path(spark, "text-owners")
        (open_.repartition(tasks, "part", *_KEY).mapInArrow(_own(better, arrow, not rounds), schema)
         .write.parquet(path))
        rounds.append(spark.read.schema(schema).parquet(path))
        open_ = rounds[-1].filter("part IS NOT NULL")
        if open_.isEmpty():
            break
    done = rounds[0]
    for more in rounds[1:]:
        done = done.unionByName(more)
    return done.filter("part IS NULL").select(*_KEY, "owner", "n"), hot


def mark(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with ``keep_id`` (the id that owns the text), ``group_size`` (rows with
    this text), ``kept`` and ``text_sha256``."""
    done, hot = owners(docs, id, text, keep)
    docs = docs.drop(*(c for c in RESULT if c not in (id, text)))
    # columns of their own, not a struct: the plan drops those that are not asked for
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = _keyed(docs, id, text, *carried).withColumn("sha", F.sha2("text", 256))
    twins = done.groupBy(*_KEY).agg(F.count("*").alias("texts")).filter("texts > 1").select(*_KEY)
    parts = [(rows, done)]
    if not twins.isEmpty():
        # texts that differ but share length and hash: the text itself is the key
        alike = rows.alias("x").join(twins.alias("t"), _same("x", "t"), "left_semi")
        best = F.max if keep == "largest" else F.min
        exact = alike.groupBy(*_KEY, "text").agg(best("owner").alias("owner"), F.count("*").alias("n"))
        exact = alike.alias("x").join(exact.alias("g"), _same("x", "g") & F.expr("x.text = g.text"))
        parts = [(rows.alias("x").join(twins.alias("t"), _same("x", "t"), "left_anti"),
                  done.alias("x").join(twins.alias("t"), _same("x", "t"), "left_anti"))]
    out = [_found(x, groups, hot) for x, groups in parts]
    if not twins.isEmpty():
        out.append(exact.select("x.*", F.col("g.owner").alias("keep_id"), F.col("g.n").alias("group_size"))
                   .select(out[0].columns))
    both = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    kept = F.col("keep_id").isNull() | F.col("owner").eqNullSafe(F.col("keep_id"))
    return both.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)), "keep_id", "group_size",
                       kept.alias("kept"), F.col("sha").alias("text_sha256"))


def _found(rows: DataFrame, groups: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows with their text's owner.  Hot texts are looked up by a broadcast of their
    owners; rows of the rest meet the owners of repeated texts by a shuffle."""
    groups = groups.filter("n > 1")
    warm = groups.alias("x").join(F.broadcast(hot).alias("h"), _same("x", "h"), "left_anti")
    hot = groups.alias("x").join(F.broadcast(hot).alias("h"), _same("x", "h"), "left_semi")
    # no text has a negative size: rows already found match nothing below, and spread
    nowhere = -1 - F.pmod(F.xxhash64("x.owner"), F.lit(1 << 20))
    rest = [c for c in rows.columns if c not in (*_KEY, "text")]
    first = (rows.alias("x").join(F.broadcast(hot).alias("h"), _same("x", "h"), "left")
             .select(*(f"x.{c}" for c in (*rest, "a", "b")), F.col("h.owner").alias("hot_id"),
                     F.col("h.n").alias("hot_n"),
                     F.when(F.col("h.n").isNotNull(), nowhere).otherwise(F.col("x.size")).alias("size")))
    pick = lambda name, own: F.when(F.col("hot_n").isNotNull(), F.col(f"hot_{name}")).when(
        F.col("g.n").isNotNull(), F.col("g.owner" if name == "id" else "g.n")).otherwise(own)
    return (first.alias("x").join(warm.alias("g"), _same("x", "g"), "left")
            .select(*(f"x.{c}" for c in rest), pick("id", F.col("x.owner")).alias("keep_id"),
                    pick("n", F.lit(1).cast("long")).alias("group_size")))


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    wide = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    return mark(wide, "id", "text", keep).filter("kept").select("whole.*")
