import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from featuremap.llm import source_audit

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def expected(rows, min_docs=3, top=200):
    docs = [((x or ""), (s or ""), TERM.findall((t or "").translate(brute.LOW))) for x, s, t in rows]
    out = []
    for lang in {x for x, _, _ in docs}:
        df, count = Counter(), defaultdict(Counter)
        for x, s, w in docs:
            if x == lang:
                df.update(set(w))
                count[s].update(w)
        kept = {t for t, n in df.items() if n >= min_docs}
        count = {s: Counter({t: n for t, n in c.items() if t in kept}) for s, c in count.items()}
        whole = sum(count.values(), Counter())
        p = lambda c, t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) * (a - b) // b
        rank = lambda s, part, items: [
            (lang, s, part, i, v, k) for k, (v, _, i) in
            enumerate(sorted((-v, i.encode(), i) for i, v in items), 1)]
        for s, c in count.items():
            out += rank(s, "pair", [(o, sum(f(p(c, t), p(d, t)) for t in kept)) for o, d in count.items() if o != s])
            out += rank(s, "term", [(t, f(p(c, t), p(whole, t))) for t in c if c[t] and p(c, t) > p(whole, t)])[:top]
    return sorted((a, b, c, d, abs(e), f) for a, b, c, d, e, f in out)


def rows():
    r = random.Random(8)
    words = ["alpha", "Beta", "GAMMA", "été", "日本", "x", "don't", "a1b"] + ["w" + chr(97 + i) * 3 for i in range(26)]
    out = [(r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s3", None, "é"]),
            " ".join(r.choices(words, k=r.randint(0, 30)))) for _ in range(150)]
    return out + [("en", "hot", "alpha beta " * 4000), ("en", "no terms", "12 34"), ("en", "null text", None),
                  ("xx", "one", "rare words"), ("xx", "two", ""), ("yy", "alone", "alpha")]


@pytest.mark.parametrize("small", [False, True])
def test_like_brute_force(spark, monkeypatch, small):
    if small:           # many shards, a broadcast for every few, many blocks, early flushes
        for name, value in (("SHARD_TERMS", 4), ("BROADCAST_BYTES", 400), ("HELD_TERMS", 9), ("HELD_WORDS", 50), ("DENSE_BYTES", 200),
                            ("BLOCK_VALUES", 12)):
            monkeypatch.setattr(source_audit, name, value)
    docs = spark.createDataFrame([(*x, 1, "b") for x in rows()],
                                 "lang string, source string, text string, n int, at string").repartition(3)
    for top in (200, 5):
        out = source_audit.audit(docs, top=top)
        assert sorted(map(tuple, out.collect())) == expected(rows(), top=top)
    assert dict(out.dtypes)["value"] == "bigint" and dict(out.dtypes)["rank"] == "int"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert source_audit.audit(docs).count() == 0


def test_other_terms_meet_the_stored_ones():
    import pyarrow as pa

    row = source_audit._build(pa.table({"lang": ["en"] * 3, "shard": [0] * 3, "shards": [1] * 3,
                                        "term": ["a", "bb", "ccc"]})).to_pylist()[0]
    shard = source_audit.Shard(row["hash"], row["ends"], row["terms"])
    found = [b"a", b"bb", b"ccc", *(b"other%d" % i for i in range(500))]
    slots = shard.slots(*source_audit._digests("en", found), found)
    assert sorted(slots[:3].tolist()) == [0, 1, 2] and (slots[3:] == -1).all()


def test_large_counts_stay_exact():
    n = np.array([0, 10 ** 10, 2 ** 62], np.int64)
    assert source_audit._p(n, 2 ** 62, 7).tolist() == [1 + 10 ** 9 * (x + 1) // (2 ** 62 + 7) for x in n.tolist()]
