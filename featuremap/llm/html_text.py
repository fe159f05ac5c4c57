"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks (the leaves between block-level
tags).  A block's vector holds its hashed tag path with class and id words, its
hashed words, its length, its share of link text and its place.  A bidirectional
LSTM reads the whole sequence, so each block is labelled knowing all others.

The labeller is trained here on a bounded sample (``TRAIN_PAGES`` pages of lowest
hash, at most ``TRAIN_BLOCKS`` blocks of each), with labels from the pages'
own semantic markup where there is any: text of article or main, outside their
navigation, asides, forms, notices and comments.  While training, parts of the
tag path are hidden at random, so words and context count too; each such page is
also seen with its article and main, and with all its sections, as plain divs, so
pages without semantic tags are known.

Defined results: null or empty html and pages without a text block give an empty
text; every row gives one row; if no page of the sample has semantic markup the
labels come from the share of link text and the length alone; a tag that is never
closed is text; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremap.llm import _lstm
from featuremap.llm._words import ALNUM, slices, words
from featuremap.session import ship_package

TRAIN_PAGES, TRAIN_BLOCKS = 300, 200
PATHS, WORDS, MORE = 64, 32, 5

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head script style template title noscript iframe object svg math canvas textarea".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_HEAD = frozenset("base link meta noframes noscript script style template title".split())
_MAIN = frozenset(("article", "main"))
_SECTIONS = _MAIN | frozenset("nav footer aside header section".split())
_ASIDE = frozenset("nav footer aside form header menu dialog button select".split())
_ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments cookie footer header menu nav "
    "navbar newsletter notice popup promo related share sidebar social sponsor".split())
_NAME = r"[a-zA-Z][^\s/>]*+"
_SPACE = r"[ \t\n\f\r]"
_ATTRIBUTE_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_VALUE = r"[^ \t\n\f\r\"'>][^ \t\n\f\r>]*+"
#: a quote opens a value right after "=" only, and only if it is closed; elsewhere it is a character
_ATTRIBUTE = rf"{_ATTRIBUTE_NAME}(?:{_SPACE}*+={_SPACE}*+(?:\"[^\"]*+\"|'[^']*+'|{_VALUE})?+)?+"
_TAG = re.compile(rf"<(/?)({_NAME})((?:[ \t\n\f\r/]++|{_ATTRIBUTE})*+)>")
_START = re.compile(r"<(?:(!--)|([!?])|/?([a-zA-Z]))")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class _Markup:
    """Tags, comments and declarations of a page from left to right, in time linear in
    its length.  A tag is ended by the first > outside its attributes' values; without
    one its < is a character.  After a first such tag the places that lead to the end
    of the page are kept, so none is gone through twice."""

    _name, _blank = re.compile(_NAME), re.compile(r"[ \t\n\f\r/]++")
    _value, _attribute = re.compile(_VALUE), re.compile(rf"{_ATTRIBUTE_NAME}(?:{_SPACE}*+(=){_SPACE}*+)?+")

    def __init__(self, source: str):
        self.source = source
        self._last = source.rfind(">")
        self._open: set[int] | None = None          # places from which no > ends a tag
        self._runs: dict[re.Pattern, tuple[int, int]] = {}

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, tag, attributes) of the next one; no tag for comments and
        declarations."""
        source = self.source
        while (m := _START.search(source, at)) is not None:
            start = m.start()
            if m[1]:
                end = source.find("-->", m.end())
                return start, len(source) if end < 0 else end + 3, "", "", ""
            at = m.end()
            if self._last < at:
                continue
            if m[2]:
                return start, source.index(">", at) + 1, "", "", ""
            if self._open is None:
                t = _TAG.match(source, start)
                if t is not None:
                    return start, t.end(), t[1], t[2].lower(), t[3]
                self._open = set()
            name = at - 1
            after = self._run(self._name, name)
            end = self._end(after)
            if end is not None:
                return start, end + 1, source[start + 1:name], source[name:after].lower(), source[after:end]
        return None

    def _run(self, pattern: re.Pattern, at: int) -> int:
        """Where the run of characters that holds ``at`` ends."""
        lo, hi = self._runs.get(pattern, (0, 0))
        if not lo <= at < hi:
            lo, hi = at, pattern.match(self.source, at).end()
            self._runs[pattern] = lo, hi
        return hi

    def _end(self, at: int) -> int | None:
        """The > that ends the tag whose attributes start at ``at``."""
        seen = []
        while at < len(self.source) and at not in self._open:
            if self.source[at] == ">":
                return at
            seen.append(at)
            at = self._skip(at)
        self._open.update(seen)
        return None

    def _skip(self, at: int) -> int:
        """The place after the white space or the attribute at ``at``."""
        blank = self._blank.match(self.source, at)
        if blank is not None:
            return blank.end()
        m = self._attribute.match(self.source, at)
        at = m.end()
        first = self.source[at:at + 1]
        if not m[1] or first in ("", ">"):
            return at
        if first in "\"'":
            return self.source.find(first, at + 1) + 1 or at
        return self._run(self._value, at)


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % PATHS


class _Page:
    """Blocks of one page: texts, path vectors, share of link text, label from markup.
    In the path vectors the tags ``as_div`` are divs."""

    def __init__(self, source: str, as_div: frozenset[str] = frozenset()):
        self._as_div = as_div
        self.texts: list[str] = []
        self.paths: list[np.ndarray] = []
        self.links: list[float] = []
        self.labels: list[bool] = []
        self.semantic = False
        self._stack: list[tuple[str, list[int], bool, bool]] = []
        self._path = np.zeros(PATHS, np.float32)
        self._main = self._aside = self._link = self._hidden = 0
        self._parts: list[str] = []
        self._linked = 0
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self._parts:
            raw = "".join(self._parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                self.texts.append(text)
                self.paths.append(self._path.copy())
                self.links.append(min(1.0, self._linked / len(raw)))
                self.labels.append(self._main > 0 and self._aside == 0)
            self._parts, self._linked = [], 0

    def _text(self, text: str) -> None:
        if self._hidden and text.strip():
            self._leave_head()
        if text and not self._hidden:
            self._parts.append(text)
            if self._link:
                self._linked += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        names = ["div" if tag in self._as_div else tag]
        if attributes:
            for m in _MARK.finditer(attributes):
                names += re.findall(r"[a-z]+", (m[1] or m[2] or m[3] or "").lower())
        marks = [_bucket(n) for n in dict.fromkeys(names)]
        main = tag in _MAIN
        aside = tag in _ASIDE or any(n in _ASIDE_WORDS for n in names[1:])
        self.semantic |= main
        self._main += main
        self._aside += aside
        self._link += tag == "a"
        self._hidden += tag in _HIDDEN
        for m in marks:
            self._path[m] += 1
        self._stack.append((tag, marks, main, aside))

    def _pop(self) -> None:
        tag, marks, main, aside = self._stack.pop()
        self._main -= main
        self._aside -= aside
        self._link -= tag == "a"
        self._hidden -= tag in _HIDDEN
        for m in marks:
            self._path[m] -= 1

    def _close(self, tag: str) -> None:
        """Close the innermost open ``tag``, and all inside it; a lone end tag is ignored."""
        if self._counts.get(tag):
            while self._stack:
                top = self._stack[-1][0]
                self._counts[top] -= 1
                self._pop()
                if top == tag:
                    break

    def _leave_head(self) -> None:
        """End a head whose end tag was left out, where something starts that cannot stand in it."""
        if self._stack and self._stack[-1][0] == "head":
            self._close("head")

    def _read(self, source: str) -> None:
        self._counts: dict[str, int] = {}
        markup, at, raw = _Markup(source), 0, None
        while True:
            if raw is not None:         # text of these goes on to their own end tag
                m = re.compile(rf"</{raw}\b", re.I).search(source, at)
                end = -1 if m is None else source.find(">", m.end())
                if end < 0:
                    return
                self._close(raw)
                at, raw = end + 1, None
                continue
            found = markup.next(at)
            if found is None:
                self._text(source[at:])
                return
            start, end, slash, tag, attributes = found
            self._text(source[at:start])
            at = end
            if not tag:
                continue
            block = tag not in _INLINE
            if not slash and tag not in _HEAD:
                self._leave_head()
            if tag == "br":
                self._text(" ")
                continue
            if block:
                self._flush()
            if slash:
                self._close(tag)
                continue
            if block and tag not in _VOID:
                self._imply(tag)
            if tag in _VOID:
                continue
            self._counts[tag] = self._counts.get(tag, 0) + 1
            self._open(tag, attributes)
            if tag in _RAW:
                raw = tag

    def _imply(self, tag: str) -> None:
        """End tags that the start of a block implies."""
        if self._counts.get("p"):
            self._close("p")
        for group in (("li",), ("dt", "dd"), ("td", "th"), ("tr",), ("option",)):
            if tag in group and self._stack:
                top = self._stack[-1][0]
                if top in group:
                    self._close(top)


def _features(pages: list[_Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block vectors of all pages, and each page's first row and number of rows."""
    size = np.array([len(p.texts) for p in pages], np.int64)
    texts = [t for p in pages for t in p.texts]
    n = len(texts)
    x = np.zeros((n, PATHS + WORDS + MORE), np.float32)
    first = np.cumsum(size) - size
    if n:
        x[:, :PATHS] = np.minimum(np.stack([v for p in pages for v in p.paths]), 3)
        w = words(pa.array([t.lower() for t in texts]), ALNUM)
        np.add.at(x, (w.doc, PATHS + (w.hash % np.uint64(WORDS)).astype(np.int64)), 1)
        x[:, PATHS:PATHS + WORDS] /= np.maximum(np.sqrt(w.n_words), 1)[:, None]
        page = np.repeat(np.arange(len(pages)), size)
        place = np.arange(n) - first[page]
        x[:, -5] = np.log1p([len(t) for t in texts]) / 5
        x[:, -4] = np.log1p(w.n_words) / 5
        x[:, -3] = [v for p in pages for v in p.links]
        x[:, -2] = place / np.maximum(size[page] - 1, 1)
        x[:, -1] = np.log1p(place) / 4
    return x, first, size


def _parsed(column: pa.Array) -> list[_Page]:
    return [_Page(t or "") for t in column.to_pylist()]


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column("text").to_pylist():
            page = _Page(text)
            for seen in (page, _Page(text, _MAIN), _Page(text, _SECTIONS)) if page.semantic else (page,):
                x, _, _ = _features([seen])
                x, y = x[:TRAIN_BLOCKS], np.array(page.labels[:TRAIN_BLOCKS], bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()]), pa.array([y.tobytes()]), pa.array([page.semantic])],
                    names=["x", "y", "semantic"])


def _hide(x: np.ndarray, r: np.random.Generator) -> np.ndarray:
    out = x.copy()
    out[:, :PATHS] *= r.random((len(x), PATHS)) > 0.1
    return out


def train(pages: DataFrame, id: str = "page_id", page: str = "html", seed: int = 0) -> dict[str, np.ndarray]:
    """The labeller's weights, from a sample of bounded size."""
    ship_package(pages.sparkSession)
    rows = (pages.select(F.col(id).alias("id"), F.col(page).cast("string").alias("text"))
            .filter(F.length("text") > 0)
            .orderBy(F.xxhash64("id"), F.xxhash64("text")).limit(TRAIN_PAGES)
            .mapInArrow(_sample, "x binary, y binary, semantic boolean").toArrow().to_pylist())
    marked = [r for r in rows if r["semantic"]] or rows
    xs = [np.frombuffer(r["x"], np.float32).reshape(-1, PATHS + WORDS + MORE) for r in marked]
    if not sum(map(len, xs)):
        return _lstm.init(PATHS + WORDS + MORE, 16, seed)
    x = np.concatenate(xs)
    y = np.concatenate([np.frombuffer(r["y"], bool) for r in marked]).astype(np.float32)
    if not any(r["semantic"] for r in marked):
        y = ((x[:, -3] < 0.3) & (x[:, -4] > np.log1p(10) / 5)).astype(np.float32)
    size = np.array([len(v) for v in xs])
    return _lstm.train(x, y, np.cumsum(size) - size, size, seed=seed, corrupt=_hide)


def _extract(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = weights.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                pages = _parsed(part.column("text"))
                x, first, size = _features(pages)
                keep = _lstm.predict(p, x, first, size) > 0
                out = ["\n".join(t for t, k in zip(q.texts, keep[f:f + n], strict=True) if k)
                       for q, f, n in zip(pages, first.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(out, pa.string())],
                    names=["id", "url", "text"])

    return run


def extract(pages: DataFrame, weights: dict | None = None, id: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """(id, url, text) of every row."""
    spark = pages.sparkSession
    ship_package(spark)
    if weights is None:
        weights = train(pages, id, page)
    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"),
                        F.col(page).cast("string").alias("text"))
    kind = pages.schema[id].dataType.simpleString()
    return (rows.mapInArrow(_extract(spark.sparkContext.broadcast(weights)),
                            f"id {kind}, url string, text string").withColumnRenamed("id", id))
