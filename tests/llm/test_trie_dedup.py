import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from featuremap.llm import trie_dedup


def brute(rows, best=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = best((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), keep is None or i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def rows():
    r = random.Random(3)
    texts = ["".join(r.choices("ab", k=r.randint(0, 6))) for _ in range(60)]
    texts += ["long " * 3000 + x for x in ("a", "b", "", "ab")] + ["é", "é", " ", "\n", "\0", "hot"]
    out = [(i, r.choice(texts)) for i in range(300)] + [(1000 + i, "hot") for i in range(200)]
    return out + [(500, None), (501, ""), (None, "hot"), (None, "only null ids"), (None, "only null ids"), (7, "twice"),
                  (7, "twice"), (-9, "alone")]


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("limit", [None, 300])
def test_like_brute_force(spark, monkeypatch, weak, limit):
    if weak:            # different texts of one length share their hash
        monkeypatch.setattr(trie_dedup, "content_hash", lambda t: (F.lit(5).cast("long"), F.lit(6).cast("long")))
    if limit:           # tries spill subtrees, in several rounds
        monkeypatch.setattr(trie_dedup, "TRIE_BYTES", limit)
        monkeypatch.setattr(trie_dedup, "SLICE_TRIE_BYTES", limit)
        monkeypatch.setattr(trie_dedup, "OUT_BYTES", 1000)
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(5)
    out = trie_dedup.mark(docs)
    assert got(out) == brute(rows())
    if not weak and not limit:
        assert got(trie_dedup.mark(docs, keep="smallest")) == brute(rows(), min)


def test_other_columns_ids_and_empty_table(spark):
    docs = spark.createDataFrame(
        [("a", "x", 1, {"k": "v"}), ("b", "x", 2, None), ("c", None, 3, {}), ("d", "y", 4, {})],
        "doc_id string, text string, kept int, `n.a` map<string,string>")
    out = trie_dedup.mark(docs)
    assert out.columns == ["doc_id", "text", "n.a", "keep_id", "group_size", "kept", "text_sha256"]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()} == {
        ("a", "b", 2, False), ("b", "b", 2, True), ("c", "c", 1, True), ("d", "d", 1, True)}
    kept = trie_dedup.dedup(docs)
    assert kept.columns == docs.columns and kept.schema["kept"].dataType.typeName() == "integer"
    assert sorted(r.doc_id for r in kept.collect()) == ["b", "c", "d"]
    assert trie_dedup.mark(docs.limit(0)).count() == 0


def test_trie_alone():
    r = random.Random(1)
    trie, want = trie_dedup.Trie(max), defaultdict(list)
    for i in range(2000):
        t = bytes(r.choices(b"abc", k=r.randint(0, 7)))
        assert trie.insert(t, i, 1, ()) is None
        want[t].append(i)
    assert {t: (x.owner, x.n) for t, x in trie.walk()} == {t: (max(v), len(v)) for t, v in want.items()}
    named, alive = {}, set(want)
    while alive:                # every string leaves once, and keeps the name it left with
        prefix, gone = trie.spill()
        named.update({x[0]: prefix for x in gone})
        alive -= {x[0] for x in gone}
        assert gone and {t for t, _ in trie.walk()} == alive and trie.strings == len(alive)
        assert all(t.startswith(p) and trie.insert(t, 1, 1, ()) == p for t, p in named.items())
