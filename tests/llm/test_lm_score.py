import math
import random
from collections import Counter

import brute

from featuremap.llm import _blocks, lm_score


def scores(rows, order, alpha):
    words = [brute.ALNUM.findall((t or "").translate(brute.LOW)) for _, t in rows]
    grams = lambda w, k: Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    total = [sum((grams(w, k) for w in words), Counter()) for k in range(1, order + 1)]
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        own = [grams(w, k) for k in range(1, order + 1)]
        c = lambda g: total[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: E731, B023
        n = sum(map(len, words)) - len(w)
        log, level = 0.0, [0] * (order + 1)
        for at in range(len(w)):
            k, up = min(order, at + 1), 0
            while k > 1 and not c(tuple(w[at - k + 1:at + 1])):
                k, up = k - 1, up + 1
            g = tuple(w[at - k + 1:at + 1])
            s = c(g) / c(g[:-1]) if k > 1 else max(c(g), 1) / max(n, 1)
            level[k if k > 1 or c(g) else 0] += 1
            log += math.log(s) + up * math.log(alpha)
        out.append((i, len(w), round(log, 6), *level))
    return out


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(_blocks, "BLOCK_BYTES", 700)
    r = random.Random(9)
    some = lambda n: " ".join(r.choice(["the", "Of", "a", "x", "é", "7", "zz", "rare%d" % r.randint(0, 99)]) for _ in range(n))
    rows = [(i, some(r.randint(0, 60))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "!?"), (103, some(5000)), (1, rows[1][1]), (1, rows[1][1]), (None, "the of a")]
    docs = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, n_words int")
    for order, keys in ((3, 50), (2, 10 ** 6), (1, 100)):
        got = lm_score.score(docs, order=order, shard_keys=keys).collect()
        assert sorted(((x[0], x[1], round(x[2], 6), *x[3:]) for x in got), key=str) == sorted(scores(rows, order, 0.4), key=str)
    assert lm_score.score(docs.limit(0)).count() == 0
