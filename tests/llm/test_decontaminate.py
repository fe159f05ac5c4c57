import random

import brute
import pytest

from featuremap.llm import decontaminate


def data():
    r = random.Random(2)
    words = ["the", "of", "Ab", "cd", "9", "é", "漢", "x1"]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, some(r.choice([1, 2, 5, 9, 10, 11, 25]))) for i in range(25)]
    items = [(i, t + (" unique%d" % i if len(t.split()) < 6 else "")) for i, t in items]
    items += [(50, None), (51, ""), (52, "!!"), (53, items[0][1]), (54, items[0][1].upper())]
    docs = [(i, some(r.randint(0, 60)) + "," + r.choice(items[:25])[1] + "\n" + some(r.randint(0, 20)))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "?!"), (103, some(30_000)), (104, docs[0][1]), (None, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, -1])
def test_like_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    docs, items = data()
    d = spark.createDataFrame([(t, i, "s") for i, t in docs + docs[:1]], "text string, doc_id long, words string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(decontaminate.hits(d, b)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(brute.contamination(docs + docs[:1], items), key=str)
    clean = decontaminate.clean(d, b)
    assert clean.columns == d.columns
    want = [x[0] for x in brute.contamination(docs + docs[:1], items) if not x[-1]]
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.hits(d.limit(0), b).count() == 0
    (r,) = decontaminate.report(decontaminate.hits(d, b.limit(0))).collect()
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)
