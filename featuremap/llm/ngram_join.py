"""N-gram Jaccard join with adaptive multi-match prefixes, and its components.

A document's set holds its distinct 5-word shingles as 64-bit hashes, in the
order of the hash.  Two sets of similarity t share at least o = ceil(t * n) of
the n elements of either, so their prefixes of n - o + l elements share at least
l.  l is chosen per set: the more partners a first, short prefix promises, the
longer the prefix and the more elements a pair has to share before its sets are
compared.  A pair is held to the smaller l of its two sets.

1. All documents, elements in the order of their hash: the prefix with
   l = ``SHARE`` * n.  Elements that two different sets hold go into a Bloom
   filter; a document with fewer of them than any partner asks for has none.
2. The sets left are kept and all their elements counted; nested Bloom filters
   by count give every element a frequency level.
3. Elements in the order of level, then hash: the rare ones come first.  l is the
   one of ``TRY`` with the lowest estimated cost, the postings of the prefix plus
   the comparisons (postings / l bounds the candidates met l times).
4. Star rounds: each set is compared with the most central holder it shares
   elements with.  A large group of near copies is linked in a number of
   comparisons that grows with its members, not their pairs.
5. Pairs not yet in one component are all compared if the first element they share
   leaves room for the overlap and they share l elements of their prefixes.

Equal sets are one class throughout.  Comparisons are exact on the sets.

Defined results: texts without words (null, empty, white space) have an empty
set, link with nothing and are their own component; a text of fewer than five
words is one shingle; repeated ids give a row each, linked by their own text;
the component of documents without an id is named by the smallest id in it,
null if there is none.  Extra columns are ignored by :func:`links`, kept by
:func:`keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm import _bloom
from featuremap.llm._components import extended, measured, stored
from featuremap.llm._packed import pack, runs, unpack
from featuremap.llm._words import NON_SPACE, mix, ready, slices, trim, words

SHINGLE = 5
PERCENT = 80
#: l of the first prefix as a share of the set, and at least
SHARE, FIRST = 0.1, 3
#: l tried for the second prefix
TRY = (1, 2, 4, 8)
#: counts from which the frequency levels start
LEVELS = (2, 4, 8, 16, 32, 64, 128, 512, 2048, 8192, 1 << 15, 1 << 18, 1 << 21)
PART_ELEMENTS = 500_000


def _shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and each text's offsets."""
    w = words(column, NON_SPACE)
    grams, n = w.ngrams(SHINGLE), w.n_words
    out, size = [], np.zeros(len(n), np.int64)
    for i, (lo, count) in enumerate(zip(w.first[:-1].tolist(), n.tolist(), strict=True)):
        if count >= SHINGLE:
            h = np.sort(grams[lo:lo + count - SHINGLE + 1])
            new = np.empty(len(h), bool)
            new[0] = True
            np.not_equal(h[1:], h[:-1], out=new[1:])
            h = h[new]
        elif count:
            h = np.zeros(1, np.uint64)
            for x in w.hash[lo:lo + count]:
                h = mix(h * np.uint64(31) + x + np.uint64(count))
        else:
            continue
        out.append(h)
        size[i] = len(h)
    at = np.concatenate([[0], np.cumsum(size)])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), at


def _need(n, percent: int):
    """Elements shared at least with any partner: ceil(n * percent / 100)."""
    return -(-n * percent // 100)


def _match(n, percent: int):
    """l of the first prefix."""
    return np.minimum(np.maximum(FIRST, np.ceil(n * SHARE).astype(np.int64)), _need(n, percent))


def _class(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1, np.int64)
    for i, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if hi > lo:
            out[i] = int.from_bytes(hashlib.blake2b(h[lo:hi].tobytes(), digest_size=8).digest(),
                                    "little", signed=True)
    return out


def _ranges(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the first ``size`` elements of each run, and the run of each."""
    run = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    return at[:-1][run] + np.arange(len(run)) - start[run], run


def _packets(t: np.ndarray, c: np.ndarray, parts: int) -> pa.RecordBatch:
    """Elements with their class, one row per part: distinct elements, the smallest
    and largest class that holds each, and the number of holders.  So an element
    that every document holds is one entry."""
    classes, c = np.unique(c, return_inverse=True)
    order = np.lexsort((c, t))
    t, c = t[order], c[order]
    first = np.flatnonzero(np.diff(t, prepend=~t[:1]))
    count = np.diff(np.append(first, len(t)))
    t, low, high = t[first], c[first], c[first + count - 1]
    rows = []
    for k, lo, hi in runs(t, parts):
        s = slice(lo, hi)
        used, a, b = classes, low[s], high[s]
        if hi - lo < len(classes):          # few elements: only the classes they name
            names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            used, a, b = classes[names], at[:hi - lo], at[hi - lo:]
        rows.append((k, pack(t[s], True), pack(a), pack(b - a), pack(count[s]), used.tobytes()))
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])],
        names=["part", "t", "low", "more", "n", "classes"])


_PACKET = "part int, t binary, low binary, more binary, n binary, classes binary"


def _shared(table: pa.Table) -> pa.Table:
    """Elements of a part that two different classes hold, and their holders."""
    trim()
    t, low, high, n = [], [], [], []
    for r in table.select(["t", "low", "more", "n", "classes"]).to_pylist():
        classes = np.frombuffer(r["classes"], "<i8")
        a, more = unpack(r["low"]), unpack(r["more"])
        t.append(unpack(r["t"], True))
        low.append(classes[a])
        high.append(classes[a + more])
        n.append(unpack(r["n"]))
    t, low, high, n = (np.concatenate(x) for x in (t, low, high, n))
    order = np.argsort(t, kind="stable")
    t = t[order]
    first = np.flatnonzero(np.diff(t, prepend=~t[:1]))
    low, high = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
    n = np.add.reduceat(n[order], first)
    ok = low < high
    return pa.table({"t": pa.array(t[first][ok].view("i8")), "k": pa.array(n[ok].astype(np.int64))})


def _first_prefixes(percent: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                h, at = _shingles(part.column("text"))
                n, c = np.diff(at), _class(h, at)
                size = np.where(n > 0, n - _need(n, percent) + _match(n, percent), 0)
                index, owner = _ranges(at, size)
                if len(index):
                    yield _packets(h[index], c[owner], parts)

    return run


def _sets(percent: int, shared):
    """Each document's size and class; sets that may have a partner also in full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                h, at = _shingles(part.column("text"))
                n, c = np.diff(at), _class(h, at)
                size = np.where(n > 0, n - _need(n, percent) + _match(n, percent), 0)
                index, owner = _ranges(at, size)
                hits = np.bincount(owner[_bloom.test(table, h[index])], minlength=len(n))
                # the smallest partner may ask for fewer
                size = np.where((n > 0) & (hits >= _match(_need(n, percent), percent)), n, 0)
                index, _ = _ranges(at, size)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                    pa.array(h[index].view("i8")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(n), pa.array(c), lists],
                    names=["id", "key", "n", "c", "t"])

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of all sets of a batch, the set of each, and the sets' sizes."""
    lists = batch.column("t")
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return lists.flatten().to_numpy().view("u8"), np.repeat(np.arange(len(size)), size), size


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
            trim()


def _elements(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            t, owner, _ = _flat(batch)
            if len(t):
                yield _packets(t, batch.column("c").to_numpy()[owner], parts)

    return run


def _prefixes(percent: int, levels):
    """Rows (t, c, n, l, pos, central) of the second prefixes: elements that another
    set holds too, with their place in the order of level and hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = levels.value
        for batch in _pieces(batches):
            t, owner, n = _flat(batch)
            c = batch.column("c").to_numpy()
            level, todo = np.zeros(len(t), np.int64), np.arange(len(t))
            for k, table in enumerate(tables, 1):
                todo = todo[_bloom.test(table, t[todo])]
                level[todo] = k
            order = np.lexsort((level, owner))          # stable: by hash within a level
            t, level = t[order], level[order]
            first = np.cumsum(n) - n
            pos = np.arange(len(t)) - first[owner]
            # an element of level k has about LEVELS[k - 1] holders
            posting = np.concatenate([[0], np.cumsum(np.array([0, *LEVELS])[level])])
            need, best = _need(n, percent), None
            for l in TRY:
                l = np.minimum(l, need)
                met = posting[first + n - need + l] - posting[first]
                cost = met + met / l * n / 8
                if best is None:
                    best, match = cost, l.copy()
                else:
                    match = np.where(cost < best, l, match)
                    best = np.minimum(best, cost)
            central = np.bincount(owner, level, len(n)) / np.maximum(n, 1)
            keep = (pos < (n - need + match)[owner]) & (level > 0)
            o = owner[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(t[keep].view("i8")), pa.array(c[o]), pa.array(n[o].astype(np.int64)),
                 pa.array(match[o]), pa.array(pos[keep]), pa.array(central[o])],
                names=["t", "c", "n", "l", "pos", "central"])

    return run


_PREFIX = "t long, c long, n long, l long, pos long, central double"


def _active(p: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, int]:
    """The prefix rows with ``comp``, whose element has a holder in another component,
    and their number."""
    if labels is None:
        p = p.withColumn("comp", F.col("c"))
    else:
        p = (p.drop("comp").join(labels.withColumnRenamed("node", "c"), "c", "left")
             .withColumn("comp", F.coalesce("root", "c")).drop("root"))
    held = p.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    out, seen = measured(p.join(held.select("t"), "t", "left_semi")
                          .select("t", "c", "n", "l", "pos", "central", "comp"), "prefixes", rows=F.count("*"))
    return out, seen["rows"]


def _overlap(percent: int) -> str:
    """What sets of n and m elements share at least."""
    return f"({percent} * (n + m) + {percent + 99}) div {100 + percent}"


def _star(p: DataFrame, tested: DataFrame | None, percent: int, turn: int) -> DataFrame:
    """For each set one pair (a < b): the holder it shares most elements with among
    the most central holders of its elements (or, later, the first in a random order)."""
    order = -F.col("central") if turn == 0 else F.xxhash64("c", F.lit(turn)).cast("double")
    held = p.groupBy("t").agg(F.min(F.struct(order.alias("o"), F.col("c").alias("pivot"),
                                             F.col("n").alias("m"), "comp")).alias("x"))
    x = p.join(held, "t").filter(
        f"comp <> x.comp and 100 * least(n, x.m) >= {percent} * greatest(n, x.m)")
    pairs = x.groupBy(F.least("c", "x.pivot").alias("a"), F.greatest("c", "x.pivot").alias("b"),
                      F.col("c").alias("of")).agg(F.count("*").alias("shared"))
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    best = pairs.groupBy("of").agg(F.max(F.struct("shared", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def _all_pairs(p: DataFrame, tested: DataFrame | None, percent: int) -> DataFrame:
    """Pairs of different components that share as many prefix elements as the smaller l.

    Of the elements that two sets share, the first in the common order has all the
    others after it in both; so it must come early enough for the overlap, and only
    elements that do make a pair.  The shared elements of those pairs are counted.
    """
    left = p.select("t", F.col("c").alias("a"), "n", "pos", F.col("comp").alias("ca"))
    right = p.select("t", F.col("c").alias("b"), F.col("n").alias("m"),
                     F.col("pos").alias("at"), F.col("comp").alias("cb"))
    pairs = (left.join(right, "t")
             .filter(f"a < b and ca <> cb and 100 * least(n, m) >= {percent} * greatest(n, m) and "
                     f"least(n - pos, m - at) >= {_overlap(percent)}")
             .select("a", "b").distinct())
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    pairs = stored(pairs, "near")
    prefix = p.groupBy("c").agg(F.collect_set("t").alias("t"), F.min("l").alias("l"))
    of_a = prefix.select(F.col("c").alias("a"), F.col("t").alias("ta"), F.col("l").alias("la"))
    of_b = prefix.select(F.col("c").alias("b"), F.col("t").alias("tb"), F.col("l").alias("lb"))
    return (pairs.join(of_a, "a").join(of_b, "b")
            .filter(F.size(F.array_intersect("ta", "tb")) >= F.least("la", "lb")).select("a", "b"))


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, ok) from the whole sets."""
    nodes = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    full = sets.join(nodes, "c", "left_semi")
    both = (pairs.join(full.select(F.col("c").alias("a"), F.col("t").alias("ta")), "a")
            .join(full.select(F.col("c").alias("b"), F.col("t").alias("tb")), "b"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.select("a", "b", shared.alias("s"), F.size("ta").alias("na"), F.size("tb").alias("nb")) \
        .select("a", "b", F.expr(f"100 * s >= {percent} * (na + nb - s)").alias("ok"))


def _sets_of(docs: DataFrame, percent: int) -> DataFrame:
    """Step 1: rows (id, key, n, c, t) of all documents; ``t`` is empty where no
    partner is possible."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(size / 20 / PART_ELEMENTS))        # of at most so many elements
    held, seen = measured(docs.select("text").mapInArrow(_first_prefixes(percent, parts), _PACKET)
                           .groupBy("part").applyInArrow(_shared, "t long, k long").select("t"),
                           "elements", rows=F.count("*"))
    shared = spark.sparkContext.broadcast(_bloom.build(held, "t", seen["rows"]))
    schema = f"id {docs.schema['id'].dataType.simpleString()}, key long, n long, c long, t array<long>"
    out = stored(docs.mapInArrow(_sets(percent, shared), schema), "sets")
    shared.unpersist()
    return out


def _prefixes_of(sets: DataFrame, total: int, percent: int) -> DataFrame:
    """Steps 2 and 3; ``total`` elements are in the sets."""
    spark = sets.sparkSession
    parts = max(1, math.ceil(total / PART_ELEMENTS))
    counted, seen = measured(sets.mapInArrow(_elements(parts), _PACKET)
                              .groupBy("part").applyInArrow(_shared, "t long, k long"), "counts",
                              **{str(k): F.count(F.when(F.col("k") >= k, 1)) for k in LEVELS})
    levels = spark.sparkContext.broadcast(
        _bloom.build_levels(counted, [(k, seen[str(k)]) for k in LEVELS if seen[str(k)]]))
    out = stored(sets.mapInArrow(_prefixes(percent, levels), _PREFIX), "second")
    levels.unpersist()
    return out


STAR_TURNS = 2


def links(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, key, n_shingles, component_id) per row of ``docs``; ``key`` is the text's
    xxhash64.  ``percent`` is the similarity asked for, more than 50."""
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    all_sets = _sets_of(rows.withColumn("key", F.xxhash64("text")), percent)
    # one row per class: equal sets are found once
    sets, seen = measured(all_sets.filter(F.size("t") > 0).select("c", "t").dropDuplicates(["c"]),
                          "class-sets", elements=F.sum(F.size("t")))
    (p, left), tested, labels = _active(_prefixes_of(sets, seen["elements"] or 0, percent), None), None, None
    for turn in range(STAR_TURNS + 1):
        if not left:
            break
        pairs = _star(p, tested, percent, turn) if turn < STAR_TURNS else _all_pairs(p, tested, percent)
        done, seen = measured(_compare(stored(pairs, "pairs"), sets, percent), "compared", linked=F.count_if("ok"))
        tested = done if tested is None else tested.union(done)
        if seen["linked"]:
            labels = extended(labels, done.filter("ok"))
            if turn < STAR_TURNS:
                p, left = _active(p, labels)
    named = all_sets.filter("n > 0").groupBy("c").agg(F.min("id").alias("least"))
    if labels is None:
        named = named.withColumn("root", F.col("c"))
    else:
        named = named.join(labels.withColumnRenamed("node", "c"), "c", "left") \
            .withColumn("root", F.coalesce("root", "c"))
    named = stored(named, "classes")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "root").select("c", "component_id")
    out = all_sets.drop("t")
    linked = out.filter("n > 0").join(stored(named, "named"), "c").select("id", "key", "n", "component_id")
    alone = out.filter("n = 0").select("id", "key", "n", F.col("id").alias("component_id"))
    return linked.union(alone).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; rows without an
    id stay."""
    bad = (links(docs, id, text, percent).filter("id <> component_id")
           .select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct())
    same = (docs[id] == bad["__id"]) & (F.xxhash64(docs[text].cast("string")) == bad["__key"])
    return docs.join(bad, same, "left_anti")
