from pyspark.sql import functions as F

from featuremap.operators.prep import (AutoPrep, MedianImputer, ModeImputer, clip, column_modes,
                                       drop_id_columns, is_id_like, with_share)
from featuremap.operators.profile import describe, inspect


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], ["c"])
    assert column_modes(df, ["c"]) == {"c": "a"}
    out = ModeImputer(["c"]).fit(df).transform(df)
    assert out.where(F.col("c").isNull()).count() == 0


def test_median_imputer_handles_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (5.0,), (3.0,)], ["a"])
    vals = sorted(r.a for r in MedianImputer(["a"]).fit(df).transform(df).collect())
    assert vals == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (50.0,)], "a double")
    assert [r[0] for r in df.select(clip("a", 0.0, 10.0)).collect()] == [None, 0.0, 10.0]


def test_id_rule():
    assert is_id_like("customer_id") and is_id_like("Name") and is_id_like("width")
    assert not is_id_like("c_custkey")


def test_drop_and_auto_prep(spark):
    df = spark.createDataFrame([(1, "x", 1.0, "Ann"), (2, None, None, "Bob"), (3, "y", 3.0, "Cy"),
                                (4, "x", 7.0, "Di")], ["row_id", "cat", "val", "name"])
    assert drop_id_columns(df).columns == ["cat", "val"]
    m = AutoPrep().fit(df)
    assert m.features == ["cat", "val"]
    out = m.features_only(df).collect()
    assert all(r.cat is not None and r.val is not None for r in out)


def test_share_and_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], ["k", "count"])
    assert sorted(r.percent for r in with_share(df).collect()) == [25.0, 75.0]
    li = spark.createDataFrame([(1.0, 2), (2.0, 4), (3.0, 6), (4.0, 8)], ["x", "y"])
    d = {r.column: r for r in describe(li).collect()}
    assert d["x"].q50 == 2.5 and d["y"]["count"] == 4 and d["x"].q25 == 1.75
    i = inspect(li).collect()
    assert [r.column_name for r in i] == ["x", "y"] and i[0].n_rows == 4


def test_median_fill_widens_integer_column_when_fractional(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,), (4,)], "a bigint")
    out = MedianImputer(["a"]).fit(df).transform(df)
    assert dict(out.dtypes)["a"] == "double"
    assert sorted(r.a for r in out.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    df2 = spark.createDataFrame([(1,), (None,), (3,)], "a bigint")
    assert dict(MedianImputer(["a"]).fit(df2).transform(df2).dtypes)["a"] == "bigint"


def test_auto_prep_rejects_empty_input(spark):
    import pytest
    from featuremap.errors import TransformerError

    df = spark.createDataFrame([(1.0, "a")], "v double, c string").where("v < 0")
    with pytest.raises(TransformerError):
        AutoPrep().fit(df)
