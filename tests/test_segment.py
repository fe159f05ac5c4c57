import pytest
from pyspark.sql import functions as F

from featuremap.operators.segment import cluster_codebook, lookup_table, profile
from featuremap.operators.som import SOM, default_grid_size
from featuremap.operators.som import quality as Q


def test_profile_with_lookup_default_name(spark):
    rows = spark.createDataFrame([(0, 1.0), (0, 3.0), (7, 10.0)], ["segment", "spend"])
    p = {r.segment: r for r in profile(rows, "segment", ["spend"], lookup_table(spark)).collect()}
    assert p[0].name == "large accounts" and p[0].avg_spend == 2.0
    assert p[7].name == "Segment 7" and p[7].strategy is None
    assert p[0].percent == pytest.approx(200 / 3)


def test_kmeans_over_codebook(spark):
    df = spark.createDataFrame([(float(i % 9), float(i % 4)) for i in range(90)], ["a", "b"])
    m = SOM(4, 4, features=["a", "b"], epochs=3).fit(df)
    seg, cost = cluster_codebook(m.codebook_df(spark), k=3)
    assert seg.count() == 16 and cost >= 0
    assert {r.segment for r in seg.collect()} <= {0, 1, 2}


def test_bands_and_activation(spark):
    s = spark.createDataFrame([(0.05,), (0.15,), (0.5,)], ["distance"])
    got = [r.anomaly for r in Q.anomaly_flag(s).collect()]
    assert got == ["normal", "unusual", "outlier"]
    act = [r.activation for r in Q.activation(s).collect()]
    assert act[0] == pytest.approx(1 / 1.05)
    m = spark.createDataFrame([(0.12, 0.05, 0.8)], ["qe", "te", "coverage"])
    r = Q.quality_report(m).first()
    assert (r.qe_band, r.te_band, r.coverage_band) == ("good", "excellent", "good")


def test_grid_rules():
    assert default_grid_size(1500) == (15, 3.75)
    assert default_grid_size(10) == (5, 1.25)
    side, _ = default_grid_size(10_000, rule="five_sqrt")
    assert side == 22
