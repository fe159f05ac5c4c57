import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.errors import SOMError
from featuremap.operators.som import SOM, quality
from featuremap.operators.som.config import SOMConfig, decay, neighborhood
from featuremap.operators.som.online import deal, influence, place, train


def blobs(spark, n=300):
    r = np.random.default_rng(7)
    centers = np.array([[0, 0], [10, 0], [0, 10], [10, 10]])
    rows = [(i, *map(float, centers[i % 4] + r.normal(0, 0.6, 2))) for i in range(n)]
    return spark.createDataFrame(rows, "key long, `a.b` double, c double")


@pytest.mark.parametrize("kind", ["gaussian", "mexican_hat", "bubble", "triangle"])
def test_influence_is_a_column_of_the_neighbourhood(kind):
    h = neighborhood(kind, 4, 3, 1.4)
    for unit in range(12):
        assert np.allclose(influence(kind, 4, 3, unit, 1.4), h[:, unit], atol=1e-15)


@pytest.mark.parametrize("workers,syncs", [(1, 1), (3, 1), (3, 4)])
def test_like_the_sequential_rule_in_every_partition(spark, workers, syncs):
    cfg = SOMConfig(x=3, y=4, sigma=1.2, random_seed=5)
    df = blobs(spark, 90).select("key", (F.col("`a.b`") / 10).alias("z0"), (F.col("c") / 10).alias("z1"))
    dealt = deal(df, F.col("key").cast("string"), workers).select("key", "z0", "z1").persist()
    w0 = np.random.default_rng(2).random((12, 2))
    got, history = train(dealt, ["z0", "z1"], w0, cfg, 2, syncs)
    parts = dealt.select(F.spark_partition_id().alias("p"), place(F.col("key"), 5, 0).alias("0"),
                         place(F.col("key"), 5, 1).alias("1"), "z0", "z1").collect()
    w = w0.copy()
    for e in range(2):
        for s in range(syncs):
            mine = [r for r in parts if s / syncs <= r[str(e)] < (s + 1) / syncs]
            moved, seen = np.zeros_like(w), 0
            for p in {r["p"] for r in mine}:
                own = w.copy()
                rows = sorted((r for r in mine if r["p"] == p), key=lambda r: r[str(e)])
                for r in rows:
                    z, t = np.array([r["z0"], r["z1"]]), e + r[str(e)]
                    b = ((own - z) ** 2).sum(1).argmin()
                    h = neighborhood("gaussian", 3, 4, decay(1.2, t, 2, "asymptotic"))[:, b]
                    own += (decay(0.5, t, 2, "asymptotic") * h)[:, None] * (z - own)
                moved, seen = moved + own * len(rows), seen + len(rows)
            w = moved / seen if seen else w
    assert np.allclose(got, w, atol=1e-9)
    assert [h[0] for h in history] == [0, 1] and dealt.rdd.getNumPartitions() == workers
    dealt.unpersist()


def test_workers_reach_the_quality_bands(spark):
    df = blobs(spark)
    model = SOM(x=4, y=4, features=["a.b", "c"], epochs=8, sigma=1.5, mode="online", workers=4, syncs=2,
                init_key="key").fit(df)
    scored = model.transform(df, distance=True, second=True)
    m = quality.metrics(scored, 4, 4).first()
    assert m["qe"] < 0.15 and m["te"] < 0.2
    same = SOM(x=4, y=4, features=["a.b", "c"], epochs=8, sigma=1.5, mode="online", workers=4, syncs=2,
               init_key="key").fit(df)
    assert np.allclose(same.codebook, model.codebook, atol=1e-9)


def test_without_key_nulls_and_bad_modes(spark):
    df = blobs(spark, 60).union(spark.createDataFrame([(None, None, 1.0)], "key long, a double, c double"))
    model = SOM(x=3, y=3, features=["a.b", "c"], epochs=2, mode="online", workers=2, handle_null="skip").fit(df)
    assert np.isfinite(model.codebook).all() and len(model.history) == 2
    for bad in (dict(mode="both"), dict(mode="online", workers=0), dict(mode="online", syncs=0)):
        with pytest.raises(SOMError):
            SOM(**bad)


def test_pca_start_is_the_eigenvectors(spark):
    from featuremap.operators.som.train import covariance, leading_direction, pca_codebook

    z = np.random.default_rng(3).normal(0, 1, (500, 5)) @ np.diag([1.0, 5.0, 2.0, 0.1, 1.0])
    df = spark.createDataFrame([tuple(map(float, r)) for r in z], [f"z{i}" for i in range(5)]).repartition(4)
    cov = covariance(df, df.columns)
    assert np.allclose(cov, np.cov(z.T))
    _, vectors = np.linalg.eigh(cov)
    for got, want in ((leading_direction(cov), vectors[:, -1]),):
        assert np.allclose(got, want * np.sign(want[np.argmax(np.abs(want))]))
    book = pca_codebook(df, df.columns, 3, 3)
    second = vectors[:, -2] * np.sign(vectors[:, -2][np.argmax(np.abs(vectors[:, -2]))])
    assert np.allclose(book[5] - book[3], 2 * second) and np.allclose(book[4], 0)
    line = df.select("z0", (F.col("z0") * 2).alias("z1"))
    flat = pca_codebook(line, ["z0", "z1"], 3, 3)
    assert np.allclose(flat[0], flat[2]) and not np.allclose(flat[0], flat[6])
    assert np.allclose(pca_codebook(df.select(F.lit(1.0).alias("z0"), F.lit(2.0).alias("z1")), ["z0", "z1"], 3, 3), 0)
