"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

1. Runs of letters are counted per task first; words of ``min_chars`` code points and
   ``min_n`` occurrences or more stay.
2. A word's point is the number of times it has each letter.  One replaced letter moves
   the point by one down and one up, one inserted letter by one up: an L1 distance of
   two or one, so partners of a word lie in a small box around it, among the words of
   its own length and of the next.
3. Lengths with more than ``CELL_WORDS`` words are cut into cells by the upper levels of
   a k-d tree, fitted on at most ``SAMPLE_WORDS`` words; every word has one home cell,
   and visits each cell that its box touches.
4. Each cell grows a k-d tree over its points with their bounding boxes, prunes by box,
   and verifies the order of the letters of what remains.  It returns per word the
   number of partners and the best one; cells are added up.
5. A word's form is its most frequent partner if that is ``ratio`` times as frequent;
   roots follow the forms by doubling, a few joins as occurrences grow at each step.

Defined results: a null text has no runs; a null id is an empty string where runs are
perturbed; repeated rows count again; words of any length are compared whole; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm._words import ready, slices, trim
from featuremap.session import scratch_path

MIN_CHARS, MIN_N, RATIO = 6, 5, 5
PERTURB = 199               # one run in so many loses a letter
CELL_WORDS = 20_000
SAMPLE_WORDS = 50_000       # of all words of large lengths together
LEAF = 48
HELD_WORDS = 200_000        # distinct words that a task holds before it sends them
PAIR_BYTES = 16 << 20       # of one comparison of queries with a leaf's points
LETTERS = 26 + 64           # a-z and U+00C0 to U+00FF


def _count(min_chars: int, perturb: int, held_words: int):
    find = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}").findall

    def give(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    seed = zlib.crc32(b"%s:" % (id or "").encode())
                    # bytes.lower changes A-Z only; shorter runs can't give a word
                    for word, n in Counter(find((text or b"").lower().decode())).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % perturb == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1:]
                            if len(word) < min_chars:
                                continue
                        held[word] += n
                if len(held) > held_words:
                    yield give(held)
                    held = Counter()
        yield give(held)
        trim()

    return run


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_n: int = MIN_N, perturb: int = PERTURB) -> DataFrame:
    """(word, n), stored: words of ``min_chars`` letters found ``min_n`` times."""
    spark = docs.sparkSession
    path = scratch_path(spark, "words")
    (docs.select(F.col(f"`{id}`").cast("string").alias("id"),
                 F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
     .mapInArrow(_count(min_chars, perturb, HELD_WORDS), "word string, n long")
     .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n).write.parquet(path))
    return spark.read.parquet(path)


_LETTER = np.full(256, -1, np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[0xC0:] = 26 + np.arange(64)


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters 0..89."""
    return _LETTER[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), -1).astype(np.uint8)


def counts(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    at = (np.arange(n)[:, None] * LETTERS + letters).ravel()
    return np.bincount(at, minlength=n * LETTERS).reshape(n, LETTERS).astype(np.int16 if length < 1 << 15 else np.int32)


class Tree:
    """k-d tree over letter counts.  ``box`` holds each node's least and largest counts:
    of its points, or (``planes``) of all points on its side of the cuts above."""

    def __init__(self, points: np.ndarray, leaf: int, planes: bool = False):
        self.lo, self.hi, self.kids, self.leaf = [], [], [], []
        n, d = points.shape
        far = np.iinfo(points.dtype).max
        todo = [(np.arange(n), np.zeros(d, points.dtype), np.full(d, far, points.dtype), None)]
        for rows, lo, hi, parent in todo:       # grows while it is read: level by level
            mine = points[rows]
            low, high = mine.min(0), mine.max(0)
            self.lo.append(lo if planes else low)
            self.hi.append(hi if planes else high)
            self.kids.append(None)
            self.leaf.append(None)
            at = len(self.kids) - 1
            if parent is not None:
                self.kids[parent] = (*(self.kids[parent] or ()), at)
            spread = high - low
            axis = int(spread.argmax())
            if len(rows) <= leaf or not spread[axis]:
                self.leaf[at] = rows
                continue
            cut = min(np.partition(mine[:, axis], (len(rows) - 1) // 2)[(len(rows) - 1) // 2], high[axis] - 1)
            left = mine[:, axis] <= cut
            below, above = hi.copy(), lo.copy()
            below[axis], above[axis] = cut, cut + 1
            todo += [(rows[left], lo, below, at), (rows[~left], above, hi, at)]

    def visit(self, points: np.ndarray, less: int, more: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``points``) for every leaf whose box has a point that takes at
        most ``less`` letters away and adds at most ``more``."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            mine = points[rows]
            near = ((np.maximum(self.lo[at] - mine, 0).sum(1) <= more)
                    & (np.maximum(mine - self.hi[at], 0).sum(1) <= less))
            rows = rows[near]
            if len(rows):
                if self.kids[at] is None:
                    yield at, rows
                else:
                    todo.extend((kid, rows) for kid in self.kids[at])


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one more letter somewhere."""
    before = np.logical_and.accumulate(a == b[:, :-1], 1).sum(1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return before + after >= a.shape[1]


def partners(tree: Tree, points: np.ndarray, letters: np.ndarray, asked: np.ndarray,
             asked_letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of the queries, of the points) that are one edit apart; queries are as long
    as the points or one letter shorter."""
    same = letters.shape[1] == asked_letters.shape[1]
    used = np.flatnonzero(points.any(0) | asked.any(0))
    few, ask = points[:, used], asked[:, used]
    for at, rows in tree.visit(asked, 1 if same else 0, 1):
        mine = tree.leaf[at]
        step = max(1, PAIR_BYTES // (len(mine) * len(used) * 8))
        for lo in range(0, len(rows), step):
            q = rows[lo:lo + step]
            diff = few[mine][None] - ask[q][:, None]
            i, j = np.nonzero((np.abs(diff).sum(2) == (2 if same else 1)) & (diff.sum(2) == (0 if same else 1)))
            step_pairs = max(1, PAIR_BYTES // (2 * letters.shape[1]))
            for k in range(0, len(i), step_pairs):
                a, b = q[i[k:k + step_pairs]], mine[j[k:k + step_pairs]]
                ok = (_one_replaced if same else _one_inserted)(asked_letters[a], letters[b])
                if ok.any():
                    yield a[ok], b[ok]


class _Best:
    """Partners of some words: how many, and the most frequent (ties: smallest)."""

    def __init__(self, words: list[str], others: list[str], n: np.ndarray):
        order = sorted(range(len(others)), key=lambda i: (-n[i], others[i]))
        self.words, self.others, self.n, self.order = words, others, n, np.array(order, np.int64)
        self.rank = np.empty(len(others), np.int64)
        self.rank[self.order] = np.arange(len(others))
        self.found = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), len(others), np.int64)

    def add(self, words: np.ndarray, others: np.ndarray) -> None:
        self.found += np.bincount(words, minlength=len(self.found))
        np.minimum.at(self.best, words, self.rank[others])

    def rows(self) -> list[tuple]:
        hit = np.flatnonzero(self.found)
        best = self.order[self.best[hit]] if len(hit) else hit
        return [(self.words[i], k, n, self.others[b]) for i, k, n, b in
                zip(hit.tolist(), self.found[hit].tolist(), self.n[best].tolist(), best.tolist(), strict=True)]


_POINT, _SAME, _SHORTER = 0, 1, 2


def _near(table: pa.Table) -> pa.Table:
    """Partners found in one cell."""
    kind = table.column("kind").to_numpy()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    pick = lambda k: np.flatnonzero(k)
    home = pick(kind == _POINT)
    out = []
    if len(home):
        own = [words[i] for i in home]
        letters = codes(own)
        points = counts(letters)
        tree = Tree(points, LEAF)
        for asked in (pick(kind != _SHORTER), pick(kind == _SHORTER)):
            if not len(asked):
                continue
            ask = [words[i] for i in asked]
            ask_letters = codes(ask)
            forth = _Best(ask, own, n[home])
            back = _Best(own, ask, n[asked]) if kind[asked[0]] == _SHORTER else None
            for a, b in partners(tree, points, letters, counts(ask_letters), ask_letters):
                forth.add(a, b)
                if back:
                    back.add(b, a)
            out += forth.rows() + (back.rows() if back else [])
    trim()
    columns = list(zip(*out, strict=True)) if out else [[]] * 4
    return pa.table({"word": pa.array(columns[0], pa.string()), "n_near": pa.array(columns[1], pa.int64()),
                     "best_n": pa.array(columns[2], pa.int64()), "best": pa.array(columns[3], pa.string())})


def _route(trees: dict[int, Tree]):
    """Each word in its home cell, and as a query in every other cell its box touches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
            size = np.array([len(w) for w in words], np.int64)
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                if length in trees or length + 1 in trees:
                    points = counts(codes(words[rows].tolist()))
                sent = []
                if length in trees:
                    home = np.empty(len(rows), np.int64)
                    for cell, x in trees[length].visit(points, 0, 0):
                        home[x] = cell
                        sent.append((length, cell, _POINT, x))
                    for cell, x in trees[length].visit(points, 1, 1):
                        sent.append((length, cell, _SAME, x[home[x] != cell]))
                else:
                    sent.append((length, 0, _POINT, np.arange(len(rows))))
                if length + 1 in trees:
                    sent += [(length + 1, cell, _SHORTER, x) for cell, x in trees[length + 1].visit(points, 0, 1)]
                else:
                    sent.append((length + 1, 0, _SHORTER, np.arange(len(rows))))
                for size_, cell, kind, x in sent:
                    at = rows[x]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), size_, np.int32)), pa.array(np.full(len(at), cell, np.int32)),
                         pa.array(np.full(len(at), kind, np.int8)), pa.array(words[at], pa.string()), pa.array(n[at])],
                        names=["size", "cell", "kind", "word", "n"])

    return run


def fit_cells(words: DataFrame) -> dict[int, Tree]:
    """Upper trees of the lengths with more than ``CELL_WORDS`` words (so there are fewer
    of them than words / CELL_WORDS), fitted on ``SAMPLE_WORDS`` words at most."""
    sizes = words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n"))
    large = {r["size"]: r["n"] for r in sizes.filter(F.col("n") > CELL_WORDS).collect()}
    if not large:
        return {}
    sample = (words.filter(F.length("word").isin(list(large))).select("word")
              .orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).toArrow().column("word").to_pylist())
    trees = {}
    for size, n in large.items():
        mine = [w for w in sample if len(w) == size]
        cells = math.ceil(n / CELL_WORDS)
        if mine and cells > 1:
            trees[size] = Tree(counts(codes(mine)), max(1, math.ceil(len(mine) / cells)), planes=True)
    return trees


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word with a partner one edit away."""
    routed = words.select("word", "n").mapInArrow(
        _route(fit_cells(words)), "size int, cell int, kind tinyint, word string, n long")
    found = routed.groupBy("size", "cell").applyInArrow(
        _near, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
             min_n: int = MIN_N, ratio: int = RATIO, perturb: int = PERTURB) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    spark = docs.sparkSession
    ready(spark)
    words = count_words(docs, id, text, min_chars, min_n, perturb)
    good = F.col("best_n") >= ratio * F.col("n")
    path = scratch_path(spark, "forms")
    (words.join(near_words(words), "word", "left")
     .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
             F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"))
     .write.parquet(path))
    forms = spark.read.parquet(path)
    # every step multiplies n by ratio, so the chains are short and doubling ends soon
    up = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = up.select(F.col("word").alias("via"), F.col("root").alias("end"))
        path = scratch_path(spark, "roots")
        (up.join(further, F.col("root") == F.col("via"), "left")
         .select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved"))
         .write.parquet(path))
        up = spark.read.parquet(path)
        if up.filter("moved").isEmpty():
            break
        up = up.drop("moved")
    roots = up.select("word", "root")
    return (forms.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
