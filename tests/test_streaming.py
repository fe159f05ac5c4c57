from pyspark.sql import functions as F

from featuremap.operators.encode import LabelEncoder
from featuremap.operators.joins import left_join_hot_right
from featuremap.operators.scale import MinMaxScaler
from featuremap.operators.som import SOM
from featuremap.streaming import apply_stages, run_available, stream_files


def test_fitted_stages_on_a_stream_equal_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    df = spark.createDataFrame([(i, float(i % 13), ["a", "b", "c"][i % 3]) for i in range(200)],
                               ["id", "v", "k"])
    df.write.parquet(src)
    models = [MinMaxScaler(["v"]).fit(df), LabelEncoder(["k"]).fit(df)]
    som = SOM(3, 3, features=["v"], epochs=2).fit(df)
    stream = stream_files(spark, src, df.schema)
    out = run_available(som.transform(apply_stages(stream, models)), f"{tmp_dir}/out",
                        f"{tmp_dir}/ckpt")
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in som.transform(apply_stages(df, models)).collect())
    assert got == want


def test_left_join_hot_right_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, name string")
    right = spark.createDataFrame([(1, 10.0)] * 50 + [(2, 5.0), (9, 1.0)], "rk int, v double")
    def key(r):
        return tuple((v is None, v) for v in r)
    a = sorted((tuple(r) for r in left_join_hot_right(left, right, "k", "rk").collect()), key=key)
    b = sorted((tuple(r) for r in left.join(right, left.k == right.rk, "left").collect()), key=key)
    assert a == b
