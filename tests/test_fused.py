import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.functions import quantiles, statistics
from featuremap.operators.encode import LabelEncoder
from featuremap.operators.prep import AutoPrep


def table(spark, n=400):
    r = random.Random(3)
    rows = [(i, r.choice([None, *range(9)]), r.choice([None, float("nan"), r.gauss(0, 5), 2.5]),
             r.choice([None, *"abcxyz"]), r.choice([None, True, False]), r.choice([None, 0.1, 0.7, 3.3]), None, None)
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, n int, `x.y` double, cat string, flag boolean, f float, "
                                       "blank double, empty string")


@pytest.mark.parametrize("limit", [None, 2])
def test_fused_fit_is_the_staged_fit(spark, monkeypatch, limit):
    if limit:           # label codes and their quartiles on the cluster, a block for every two codes
        init = LabelEncoder.__init__
        monkeypatch.setattr(LabelEncoder, "__init__", lambda self, *a, **k: init(self, *a, collect_limit=limit, **k))
        monkeypatch.setattr(statistics, "BLOCK_CODES", 2)
    df = table(spark)
    prep, kept = AutoPrep(), [c for c in df.columns if c != "row_id"]
    base = df.select(*[f"`{c}`" for c in kept])
    a, b = prep._fused(base, kept), prep._staged(base, kept)
    assert a.n_rows == b.n_rows == 400 and list(a.params) == list(b.params)
    for c, p in b.params.items():
        assert a.params[c] == pytest.approx(p), c
    got, want = (m.transform(df).orderBy("row_id").collect() for m in (a, b))
    assert a.transform(df).dtypes == b.transform(df).dtypes
    for x, y in zip(got, want, strict=True):
        assert all(p == q or math.isclose(p, q, abs_tol=1e-12) for p, q in zip(x, y, strict=True))


def test_three_passes(spark):
    df = table(spark).drop("empty", "blank").withColumnRenamed("x.y", "xy")
    acc = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            acc.add(batch.num_rows)
            yield batch

    watched = df.drop("row_id").mapInArrow(seen, df.drop("row_id").schema)      # counts rows that are computed
    prep = AutoPrep()
    prep._fused(watched, watched.columns)
    assert acc.value == 3 * 400


@pytest.mark.parametrize("collect", [100_000, 40])
def test_order_statistics_of_any_rank(spark, collect):
    values = [float(v) for v in np.random.default_rng(1).integers(0, 500, 3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    row = df.agg(quantiles.rank_sketch(F.nanvl("v", F.lit(None))).alias("s")).first()
    ranks = {0, 1, 700, 1499, 1500, 2998, 2999}
    got = quantiles.order_statistics(df, {"v": (3000, bytes(row["s"]), ranks)}, max_collect=collect)
    assert got == {("v", r): sorted(values)[r] for r in ranks}


def test_gather_refuses_nothing_and_counts_all(spark):
    stats = statistics.gather(table(spark), ["n", "blank"], ["cat", "empty"])
    assert stats.rows == 400 and stats.n["blank"] == 0
    assert {r["col"] for r in stats.counts.collect()} == {"cat"}
    assert statistics.filled_quantiles(table(spark).select("blank"), statistics.gather(
        table(spark), ["blank"], []), [0.5]) == ({"blank": None}, {("blank", 0.5): None})
