import os

import pytest
from pyspark.sql import functions as F

from featuremap.errors import PipelineError
from featuremap.operators.base import IdentityStage
from featuremap.operators.scale import MinMaxScaler, ZScoreScaler
from featuremap.plans.flow import Pipeline, SOMStage
from featuremap.sources import CSVDestination, CSVSource


def test_missing_source(spark):
    with pytest.raises(PipelineError, match="No source configured"):
        Pipeline().run(spark)


def test_csv_to_csv_end_to_end(spark, tmp_dir):
    src = os.path.join(tmp_dir, "people.csv")
    with open(src, "w") as f:
        f.write("name,age\nAlice,25\nBob,30\n")
    out = os.path.join(tmp_dir, "out")
    p = Pipeline().extract_from(CSVSource(src)).add_transformer(IdentityStage()).load_to(
        CSVDestination(out))
    assert p.run(spark).count() == 2
    assert CSVSource(out).extract(spark).count() == 2
    assert p.data is not None


def test_each_stage_fits_on_previous_output(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], ["a"])
    p = Pipeline(lambda s: df, stages=[MinMaxScaler(["a"]), ZScoreScaler(["a"])])
    out = [r.a for r in p.run(spark).collect()]
    assert abs(sum(out)) < 1e-12
    z = p.model.models[1].params["a"]
    assert z["mean"] == pytest.approx((0 + 1 / 3 + 1) / 3)
    p.unpersist()


def test_function_stage_and_failure_wrapped(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    p = Pipeline(lambda s: df).add_transformer(lambda d: d.withColumn("c", F.col("a") + F.col("b")))
    assert p.run(spark).first().c == 3
    bad = Pipeline(lambda s: df).add_transformer(lambda d: d.select("missing"))
    with pytest.raises(PipelineError):
        bad.run(spark)


def test_som_stage(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(60)], ["x", "y"])
    out = Pipeline(stages=[SOMStage(3, epochs=3)]).fit(df).transform(df)
    assert {"som_x", "som_y"} <= set(out.columns) and out.count() == 60
