import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.errors import InsufficientDataError, TransformerError
from featuremap.operators.kmeans import KMeans


def blobs(spark, n=240, parts=4):
    r = np.random.default_rng(5)
    rows = [(f"r{i}", *map(float, np.array([[0, 0], [8, 0], [0, 8]])[i % 3] + r.normal(0, 0.5, 2)), float(i % 3 + 1))
            for i in range(n)]
    return spark.createDataFrame(rows, "id string, `a.x` double, b double, w double").repartition(parts)


def test_lloyd_steps_like_numpy(spark):
    df = blobs(spark)
    ks = [2, 3, 5]
    start = KMeans(["a.x", "b"], ks=ks, weight="w", iterations=0).fit(df)
    model = KMeans(["a.x", "b"], ks=ks, weight="w", iterations=4).fit(df)
    rows = df.collect()
    z, w = np.array([[r["a.x"], r["b"]] for r in rows]), np.array([r["w"] for r in rows])
    for k in ks:
        c = start.centers[k].copy()
        for _ in range(4):
            near = ((z[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([np.average(z[near == j], axis=0, weights=w[near == j]) if (near == j).any() else c[j]
                          for j in range(k)])
        d2 = ((z[:, None] - c[None]) ** 2).sum(2).min(1)
        assert np.allclose(model.centers[k], c) and model.inertia[k] == pytest.approx((w * d2).sum())
    assert start.centers[5][:3].tolist() == start.centers[3].tolist()
    assert model.inertia[3] < model.inertia[2] / 5          # the blobs are found
    again = KMeans(["a.x", "b"], ks=ks, weight="w", iterations=4).fit(df.repartition(7))
    assert np.allclose(again.centers[5], model.centers[5])


def test_nulls_weights_copies_and_arguments(spark):
    df = blobs(spark).union(spark.createDataFrame(
        [("n", None, 1.0, 1.0), ("nan", float("nan"), 1.0, 1.0), ("w0", 1e6, 1e6, 0.0), (None, 1e6, 1e6, None)],
        "id string, a double, b double, w double"))
    model = KMeans(["a.x", "b"], ks=[3], weight="w").fit(df)
    assert abs(model.centers[3]).max() < 20
    out = model.transform(df, 3)
    assert out.columns == [*df.columns, "segment"]
    assert {r["id"]: r["segment"] for r in out.where("segment IS NULL").collect()} == {"n": None, "nan": None}
    same = spark.createDataFrame([(i, 1.0) for i in range(9)], "id long, v double")
    assert KMeans(["v"], ks=[1, 4]).fit(same).centers[4].tolist() == [[1.0]]
    with pytest.raises(InsufficientDataError):
        KMeans(["v"]).fit(same.limit(0))
    with pytest.raises(TransformerError):
        KMeans(["v"], ks=[0])
    with pytest.raises(TransformerError):
        model.transform(df, 7)
    arrays = df.where("w > 0").select("id", F.array("`a.x`", "b").alias("v.v"), "w")
    assert KMeans(vector_col="v.v", size=2, ks=[3], weight="w").fit(arrays).inertia[3] == pytest.approx(model.inertia[3])
