import pytest
from pyspark.sql import functions as F

from featuremap.operators.auto import auto_segment
from featuremap.operators.som import SOM, quality
from featuremap.sources.files import ParquetDestination


def frame(spark, n=120):
    return spark.range(n).select(
        F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("distance"),
        F.expr("CASE WHEN id % 11 > 0 THEN id * id % 13 END").cast("double").alias("v.w"),
        F.expr("concat('k', id % 3)").alias("kind")).repartition(3)


def test_observed_metrics_are_the_metrics(spark, tmp_dir):
    df = frame(spark).na.fill(0.0)
    model = SOM(4, 3, features=["distance", "v.w"], epochs=2, initialization="grid").fit(df)
    scored = model.score(df.withColumnRenamed("distance", "d").withColumn("distance", F.col("d")))
    out, seen = quality.observe_metrics(scored, 4, 3)
    out.write.parquet(tmp_dir + "/scored")
    want = quality.metrics(scored, 4, 3)
    got = seen.table(spark)
    assert got.columns == want.columns
    assert tuple(got.first()) == pytest.approx(tuple(want.first()))
    none, seen = quality.observe_metrics(scored.limit(0), 4, 3)
    none.write.parquet(tmp_dir + "/none")
    assert tuple(seen.table(spark).first()) == (None, None, 0, 12, 0.0, None, None)


def test_saved_segmentation_scores_once(spark, tmp_dir, monkeypatch):
    df = frame(spark)
    plain = auto_segment(df, epochs=2)
    calls = []
    score = SOM.__mro__[0].fit.__globals__["SOMModel"].transform
    monkeypatch.setattr(type(plain.model), "transform", lambda self, *a, **k: calls.append(1) or score(self, *a, **k))
    saved = auto_segment(df, epochs=2, destination=ParquetDestination(tmp_dir + "/out"))
    metrics = saved.metrics().first()
    assert calls == [1]
    assert tuple(metrics) == pytest.approx(tuple(plain.metrics().first()))
    back = spark.read.parquet(tmp_dir + "/out")
    assert back.columns == plain.rows.columns == [*df.columns, "som_group_x", "som_group_y", "som_cluster"]
    assert sorted(map(str, back.collect())) == sorted(map(str, plain.rows.collect()))
