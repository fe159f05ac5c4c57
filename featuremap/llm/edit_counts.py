"""Token counts that follow edits.

Each document keeps a binary tree over its text.  A leaf is a run of whole
pre-tokens (about ``LEAF`` characters) with its number of characters and tokens;
an inner node has the sums of its children, so the root has the document's
count.  A leaf ends where the two characters at a border alone make the
pre-tokeniser end a match: before white space that follows another character, and
between letters, digits and punctuation of the common scripts (not after an
apostrophe, which may start a contraction).  So texts without blanks have leaves
too; only a run of letters, one pre-token, is never divided.

An edit finds the leaves that hold the character before it, the edited span and
the character after it.  The borders of this region have unchanged characters
on both sides, so they stay borders; only the region is cut and encoded again.
Its pieces go back into the same leaves (the last one becomes a subtree if the
text has grown), and the sums on the paths above are updated.

Defined results: null is an empty text; edits apply in order, each to the text
the earlier ones left, places in code points, clipped to the text; a null edit
list or a null edit changes nothing, a null replacement is empty; every row
gives one row, repeated ids included; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremap.llm._words import slices
from featuremap.llm.byte_bpe import encoding
from featuremap.session import ship_package

LEAF = 512
TREE = T.StructType([T.StructField(c, T.ArrayType(T.IntegerType()))
                     for c in ("left", "right", "chars", "tokens")])
EDITS = "array<struct<start:int,end:int,text:string>>"
_ARROW_TREE = pa.struct([(c, pa.list_(pa.int32())) for c in ("left", "right", "chars", "tokens")])
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin, Greek, Cyrillic, Devanagari, Thai, kana, CJK and Hangul characters that are letters in every Unicode version
_LETTERS = ("A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f\u03b1-\u03c9\u0410-\u044f\u0905-\u0939\u0e01-\u0e30"
            "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3")
_DIGITS = "0-9\uff10-\uff19"
_MARKS = ("!-&(-/:-@\\[-`{-~\xa1\xa7\xab\xb7\xbb\xbf\u0964\u0965\u2010-\u2027\u2030-\u205e\u3001-\u3003"
          "\u3008-\u3011\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65")
_BORDER = re.compile(rf"(?<=\S)(?=[{_SPACES}])|(?<=[{_LETTERS}])(?=[{_DIGITS}{_MARKS}'])"
                     rf"|(?<=[{_DIGITS}])(?=[{_LETTERS}{_MARKS}'])|(?<=[{_MARKS}])(?=[{_LETTERS}{_DIGITS}])")


def cut(text: str, size: int = LEAF) -> list[str]:
    """The text in pieces of whole pre-tokens, of ``size`` characters or the next
    border after that."""
    out, lo = [], 0
    while len(text) - lo > size:
        m = _BORDER.search(text, lo + size)
        if m is None:
            break
        out.append(text[lo:m.start()])
        lo = m.start()
    out.append(text[lo:])
    return out


class Tree:
    """Node 0 is the root; a leaf has left -1."""

    def __init__(self, left: list[int], right: list[int], chars: list[int], tokens: list[int]):
        self.left, self.right, self.chars, self.tokens = left, right, chars, tokens

    @classmethod
    def build(cls, leaves: list[tuple[int, int]]) -> Tree:
        tree = cls([-1], [-1], [0], [0])
        tree._graft(0, leaves)
        return tree

    def _graft(self, node: int, leaves: list[tuple[int, int]]) -> None:
        """Make ``node`` the root of a balanced tree over (chars, tokens) of leaves."""
        todo, made = [(node, 0, len(leaves))], []
        while todo:
            at, lo, hi = todo.pop()
            if hi - lo == 1:
                self.chars[at], self.tokens[at] = leaves[lo]
                continue
            mid, new = (lo + hi) // 2, len(self.left)
            self.left[at], self.right[at] = new, new + 1
            for column, value in ((self.left, -1), (self.right, -1), (self.chars, 0), (self.tokens, 0)):
                column += [value, value]
            made.append(at)
            todo += [(new, lo, mid), (new + 1, mid, hi)]
        for at in reversed(made):
            self._sum(at)

    def _sum(self, node: int) -> None:
        a, b = self.left[node], self.right[node]
        self.chars[node] = self.chars[a] + self.chars[b]
        self.tokens[node] = self.tokens[a] + self.tokens[b]

    def region(self, lo: int, hi: int) -> tuple[list[int], list[int], int]:
        """Leaves that hold any of the characters lo..hi, the inner nodes above them
        (children first), and the place of the first leaf."""
        leaves, inner, start, todo = [], [], None, [(0, 0, False)]
        while todo:
            node, at, seen = todo.pop()
            if seen:
                inner.append(node)
            elif self.left[node] < 0:
                leaves.append(node)
                start = at if start is None else start
            else:
                a, b = self.left[node], self.right[node]
                middle = at + self.chars[a]
                todo.append((node, at, True))
                # an empty side holds nothing, so one side is always taken
                if hi >= middle and self.chars[b] or not self.chars[a]:
                    todo.append((b, middle, False))
                if lo < middle and self.chars[a]:
                    todo.append((a, at, False))
        return leaves, inner, start

    def edit(self, text: str, start: int, end: int, new: str, count) -> tuple[str, int]:
        """The text after replacing start..end by ``new``, and how many characters
        were encoded again; ``count`` gives the tokens of each of some texts."""
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        last = max(len(text) - 1, 0)
        leaves, inner, lo = self.region(min(max(start - 1, 0), last), min(end, last))
        hi = lo + sum(self.chars[i] for i in leaves)
        region = text[lo:start] + new + text[end:hi]
        pieces = cut(region)
        sizes = [(len(p), n) for p, n in zip(pieces, count(pieces), strict=True)]
        for node in leaves[:-1]:
            self.chars[node], self.tokens[node] = sizes.pop(0) if len(sizes) > 1 else (0, 0)
        self._graft(leaves[-1], sizes)
        for node in inner:
            self._sum(node)
        return text[:lo] + region + text[hi:], len(region)


def _counter(path: str):
    enc = encoding(path)

    def count(pieces: list[str]) -> list[int]:
        return [len(enc.encode_ordinary(p)) for p in pieces]

    return count


def _lists(trees: list[Tree]) -> pa.Array:
    return pa.array([{c: getattr(t, c) for c in ("left", "right", "chars", "tokens")} for t in trees],
                    _ARROW_TREE)


def _build(path: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            for part in slices(batch, text):
                pieces = [cut(t or "") for t in part.column(text).to_pylist()]
                trees = [Tree.build([(len(p), n) for p, n in zip(ps, count(ps), strict=True)])
                         for ps in pieces]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _lists(trees), pa.array([t.tokens[0] for t in trees], pa.int64())],
                    names=[*part.schema.names, "tree", "n_tokens"])

    return run


def _edit(path: str, text: str, edits: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            for part in slices(batch, text):
                trees, texts, work = [], [], []
                for old, raw, todo in zip(*(part.column(c).to_pylist() for c in (text, "tree", edits)),
                                          strict=True):
                    tree, now, again = Tree(**raw), old, 0
                    for e in todo or []:
                        if e is not None and e["start"] is not None and e["end"] is not None:
                            now, n = tree.edit(now or "", e["start"], e["end"], e["text"] or "", count)
                            again += n
                    trees.append(tree)
                    texts.append(now)
                    work.append(again)
                new = {text: pa.array(texts, pa.string()), "tree": _lists(trees),
                       "n_tokens": pa.array([t.tokens[0] for t in trees], pa.int64())}
                keep = [c for c in part.schema.names if c != edits]
                yield pa.RecordBatch.from_arrays(
                    [*(new.get(c, part.column(c)) for c in keep), pa.array(work, pa.int64())],
                    names=[*keep, "n_chars_encoded"])

    return run


def build(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``tree`` and ``n_tokens`` in place of columns of these names;
    ``path`` is a rank file of byte-level BPE."""
    ship_package(docs.sparkSession)
    docs = docs.drop("tree", "n_tokens").withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField("tree", TREE),
                           T.StructField("n_tokens", T.LongType())])
    return docs.mapInArrow(_build(path, text), schema)


def attach(counted: DataFrame, edits: DataFrame, id: str = "doc_id", order: str = "seq") -> DataFrame:
    """``counted`` with the column ``edits`` from a table (id, seq, start, end, text)."""
    one = F.struct(F.col(order), F.struct(F.col("start").cast("int").alias("start"),
                                          F.col("end").cast("int").alias("end"), "text").alias("e"))
    lists = edits.groupBy(id).agg(F.transform(
        F.sort_array(F.collect_list(one)), lambda x: x["e"]).alias("edits"))
    return counted.drop("edits").join(lists, id, "left").select(*counted.drop("edits").columns, "edits")


def edit(counted: DataFrame, path: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Apply the edits of each row: new ``text``, ``tree`` and ``n_tokens``, and
    ``n_chars_encoded``, the characters that had to be encoded again; drops
    ``edits``."""
    ship_package(counted.sparkSession)
    counted = counted.drop("n_chars_encoded").withColumn(edits, F.col(edits).cast(EDITS))
    fields = [f for f in counted.schema.fields if f.name != edits]
    schema = T.StructType([*fields, T.StructField("n_chars_encoded", T.LongType())])
    return counted.mapInArrow(_edit(path, text, edits), schema)
