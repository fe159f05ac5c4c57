import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from featuremap.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def expected(rows):
    n = Counter()
    for i, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(brute.LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    form, found = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        found[w], form[w] = len(others), best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], found[w], n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows():
    r = random.Random(4)
    base = ["abcdef", "banana", "straße", "Élégante", "committee", "lettres", "listen", "silent", "÷×ÿ÷×ÿ"]
    words = list(base)
    for _ in range(250):        # chains of edits, some rare and some frequent
        w = list(r.choice(words))
        i = r.randrange(len(w))
        w[i:i + r.choice([0, 1, 1])] = r.choice(["", "a", "b", "é"])
        words.append("".join(w))
    weights = [5 ** r.randint(0, 4) for _ in words]
    out = [(i, "; ".join(r.choices(words, weights, k=r.randint(0, 80)))) for i in range(300)]
    long = "x" * 70000
    return out + [(900, None), (901, ""), (None, "nullid " * 9), (902, "nullid nullad"), (902, "nullid nullad"),
                  (903, f"{long} " * 6 + f"{long}y " * 40), (904, "ABCDEFÀ abcdefà " * 7)]


@pytest.mark.parametrize("cells", [False, True])
def test_like_brute_force(spark, monkeypatch, cells):
    if cells:           # upper trees of many cells, small leaves, small comparisons
        monkeypatch.setattr(spelling, "CELL_WORDS", 6)
        monkeypatch.setattr(spelling, "LEAF", 3)
    docs = spark.createDataFrame([(t, i, "w") for i, t in rows()], "text string, doc_id long, word string").repartition(4)
    out = spelling.variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, out.collect()), key=str) == expected(rows())


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_finds_all_in_the_box(monkeypatch):
    r = np.random.default_rng(1)
    letters = r.integers(0, 4, (600, 7)).astype(np.uint8)
    points = spelling.counts(letters)
    monkeypatch.setattr(spelling, "PAIR_BYTES", 2000)
    for planes in (False, True):
        tree = spelling.Tree(points, 5, planes)
        assert sorted(x for rows in tree.leaf if rows is not None for x in rows) == list(range(600))
        got = {(a, b) for x, y in spelling.partners(tree, points, letters, points, letters)
               for a, b in zip(x.tolist(), y.tolist(), strict=True)}
        want = {(a, b) for a in range(600) for b in range(600) if (letters[a] != letters[b]).sum() == 1}
        assert got == want
    shorter = letters[:, :6]
    tree = spelling.Tree(points, 5)
    got = {(a, b) for x, y in spelling.partners(tree, points, letters, spelling.counts(shorter), shorter)
           for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    text = ["".join(map(chr, 97 + x)) for x in letters]
    assert got == {(a, b) for a in range(600) for b in range(600) if near(text[a][:6], text[b])}
