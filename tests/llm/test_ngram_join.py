import random

import brute
from pyspark.sql import functions as F

from featuremap.llm import ngram_join


def docs():
    r = random.Random(4)
    some = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyz") + str(r.randint(0, 300)) for _ in range(n)]
    out, passage = [], some(60)
    for _ in range(14):                             # families of near copies
        base = some(r.choice([7, 12, 30, 90, 200]))
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 30))):
                k = r.randrange(len(w))
                w[k:k + 1] = r.choice([[], ["new"], ["new", "words"], [w[k].upper()]])
            out.append(" ".join(w))
    base = some(120)                                # one large family
    for k in range(60):
        w = list(base)
        w[k] = f"edit{k}"
        w[119 - k] = f"more{k}"
        out.append(" ".join(w))
    out += [" ".join(some(r.randint(20, 150)) + passage) for _ in range(40)]     # a shared passage
    out += [" ".join(some(r.randint(1, 60))) for _ in range(60)]
    out += ["", " \n", None, "one", "ONE", "two words", "one two three four", "One two\tthree four", "w " * 20_000]
    out += out[:12]
    r.shuffle(out)
    return list(enumerate(out))


def test_like_brute_force(spark):
    rows = docs()
    df = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, n int")
    got = sorted((r.id, r.n_shingles, r.component_id) for r in ngram_join.links(df).collect())
    want = sorted(brute.components(rows))
    assert got == want
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_many_small_parts(spark, monkeypatch):
    rows = docs()[::3]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "PART_ELEMENTS", 200)
    got = sorted((r.id, r.n_shingles, r.component_id) for r in ngram_join.links(df).collect())
    assert got == sorted(brute.components(rows))


def test_ids_null_or_repeated(spark):
    a = "a text of some words that is here more than once today"
    rows = [(5, a), (5, a), (None, a), (9, a), (5, "something else of a few words for sure"), (None, ""), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.id, r.component_id) for r in ngram_join.links(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (9, 5), (5, 5), (None, None), (1, 1)], key=str)
    assert sorted((r.doc_id or 0 for r in ngram_join.keep_one(df).collect())) == [0, 0, 1, 5, 5, 5]
    assert ngram_join.links(df.limit(0)).count() == 0


def test_large_family_is_not_compared_in_all_pairs(spark, monkeypatch):
    seen = []
    real = ngram_join._compare

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_compare", counted)
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join([*words[:k], f"x{k}", *words[k + 1:]])) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.links(df).agg(F.max("component_id")).first()[0] == 0
    assert sum(seen) < 5 * len(rows)
