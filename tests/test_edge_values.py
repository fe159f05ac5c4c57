"""Values that are easy to lose: long integers, NaN, nested types, quoted text,
exponents far from the usual range."""

import math
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.errors import TransformerError
from featuremap.operators.encode import LabelEncoder, OneHotEncoder, TargetEncoder
from featuremap.operators.power import PowerTransformer
from featuremap.operators.prep import AutoPrep, MedianImputer, ModeImputer
from featuremap.operators.scale import MinMaxScaler
from featuremap.sources.files import CSVDestination, CSVSource
from featuremap.sources.workbook import ExcelDestination, ExcelSource


def likelihood(x, lam):
    """Box-Cox profile log-likelihood in long doubles, by the log domain."""
    u = np.log(np.asarray(x, np.longdouble))
    c = u - u.mean()
    v = c.var() if lam == 0 else np.expm1(lam * c).var() / lam ** 2
    return float(-len(u) / 2 * (np.log(v) + 2 * lam * u.mean()) + (lam - 1) * u.sum())


@pytest.mark.parametrize("kind", ["root", "far", "negative"])
def test_lambda_is_found_wherever_it_is(spark, kind):
    r = random.Random(3)
    if kind == "root":                  # optimum near 6
        xs = [(40 + r.gauss(0, 6)) ** (1 / 6) for _ in range(4000)]
    elif kind == "far":                 # far from 0, where powers lose their digits
        xs = [1000 + r.lognormvariate(0, 0.8) for _ in range(4000)]
    else:
        xs = [math.exp(r.gauss(0, 0.02)) ** -3 for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    model = PowerTransformer(["x"], method="box-cox").fit(df)
    lam = model.params["x"]["lambda"]
    best = likelihood(xs, lam)
    for step in (1e-2, 1e-1, 1, 10, 100):
        assert best >= likelihood(xs, lam + step) - 1e-6 and best >= likelihood(xs, lam - step) - 1e-6
    out = [v.x for v in model.transform(df).collect()]
    assert np.mean(out) == pytest.approx(0, abs=1e-8) and np.std(out) == pytest.approx(1, abs=1e-8)
    assert np.all(np.diff(np.array(out)[np.argsort(xs)]) >= 0)


@pytest.mark.parametrize("sign", [1, -1])
def test_yeo_johnson_on_one_side_and_new_data_on_the_other(spark, sign):
    xs = [sign * math.exp(i / 50) for i in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    model = PowerTransformer(["x"]).fit(df)
    new = spark.createDataFrame([(-2.0,), (-0.5,), (0.0,), (0.5,), (2.0,), (None,)], "x double")
    got = [r.x for r in model.transform(new).orderBy(F.col("x").asc_nulls_last()).collect()]
    assert got[-1] is None and np.all(np.diff(got[:-1]) > 0)
    raw = PowerTransformer(["x"], standardize=False).fit(df)
    psi = [r.x for r in raw.transform(df).collect()]
    std = [r.x for r in model.transform(df).collect()]
    assert np.allclose((np.array(psi) - np.mean(psi)) / np.std(psi), std, atol=1e-6)
    psi_new = np.array([r.x for r in raw.transform(new.dropna()).orderBy("x").collect()])
    assert np.allclose((psi_new - np.mean(psi)) / np.std(psi), got[:-1], atol=1e-6)


def test_long_integers_survive_imputation(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big,), (big + 2,), (None,), (5,), (7,)], "x long")
    out = sorted(r.x for r in MedianImputer(["x"]).fit(df.filter("x < 10 or x is null")).transform(df).collect())
    assert out == [5, 6, 7, big, big + 2]


def test_mode_of_columns_that_are_no_scalars(spark):
    df = spark.createDataFrame([([1, 2], "a", True), ([1, 2], None, None), (None, "a", True), ([3], "b", False)],
                               "v array<int>, s string, b boolean")
    out = ModeImputer().fit(df).transform(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.collect()][2] == ([1, 2], "a", True)
    num = df.withColumn("n", F.lit(1.5))
    assert AutoPrep().fit(num).transform(num).count() == 4


def test_one_nan_target_changes_nothing_else(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", float("nan")), ("c", None)]
    df = spark.createDataFrame(rows, "k string, y double")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        model = TargetEncoder(["k"], "y", smoothing=0.0).fit(df)
    out = {r.was: r.k for r in model.transform(df.withColumn("was", F.col("k"))).collect()}
    assert out == {"a": 2.0, "b": 5.0, "c": 3.0}


def test_unknown_values_are_reported(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "k string")
    new = spark.createDataFrame([("a",), ("z",), ("q",), ("z",)], "k string")
    model = LabelEncoder(["k"], handle_unknown="warn").fit(fit)
    with pytest.warns(UserWarning, match="3 rows with 2 values in 'k'"):
        assert sorted(r.k for r in model.transform(new).collect()) == [-1, -1, -1, 0]
    with pytest.raises(TransformerError, match=r"\['q', 'z'\]"):
        LabelEncoder(["k"], handle_unknown="error").fit(fit).transform(new)


@pytest.mark.parametrize("limit", [0, 3, 100])
def test_label_codes_do_not_depend_on_the_limit(spark, limit):
    df = spark.createDataFrame([(c, str(i % 2)) for i, c in enumerate("bdaceeb")], "k string, m string")
    model = LabelEncoder(["k", "m"], collect_limit=limit).fit(df)
    assert [tuple(r) for r in model.transform(df).collect()] == [
        ("abcde".index(c), i % 2) for i, c in enumerate("bdaceeb")]
    m = model.mapping("k")
    pairs = m if isinstance(m, dict) else {r.value: r.enc for r in m.collect()}
    assert pairs == {c: i for i, c in enumerate("abcde")}


def test_one_hot_has_no_limit_unless_asked(spark):
    df = spark.createDataFrame([(f"v{i:04}",) for i in range(1200)], "k string")
    assert len(OneHotEncoder(["k"]).fit(df).output_columns("k")) == 1200
    with pytest.raises(TransformerError):
        OneHotEncoder(["k"], max_categories=10).fit(df)


def test_csv_keeps_quoted_text(spark, tmp_dir):
    rows = [(1, 'say "hi", ok'), (2, 'say "hi" ok'), (3, "two\nlines"), (4, "plain"), (5, '"'), (6, "a,b")]
    df = spark.createDataFrame(rows, "i long, t string")
    CSVDestination(tmp_dir + "/c").save(df)
    back = CSVSource(tmp_dir + "/c", multi_line=True).extract(spark)
    assert sorted(tuple(r) for r in back.collect()) == rows
    import pandas as pd
    from glob import glob
    frames = pd.concat(pd.read_csv(p) for p in glob(tmp_dir + "/c/part-*.csv"))
    assert sorted(map(tuple, frames.values.tolist())) == rows


def test_csv_types_and_dotted_names(spark, tmp_dir):
    with open(tmp_dir + "/x.csv", "w") as f:
        f.write("code,user.name,n,d,e\n10D,ann,1,1.5,1e3\n5F,,2,.5,-2\n")
    df = CSVSource(tmp_dir + "/x.csv").extract(spark)
    assert dict(df.dtypes) == {"code": "string", "user.name": "string", "n": "bigint", "d": "double", "e": "double"}
    assert ModeImputer(["user.name"]).fit(df).transform(df).filter("`user.name` = 'ann'").count() == 2
    assert LabelEncoder(["user.name"], handle_unknown="warn").fit(df).transform(df).columns == df.columns
    num = df.withColumnRenamed("n", "a.n")
    assert MinMaxScaler(["a.n"]).fit(num).transform(num).agg(F.max("`a.n`")).first()[0] == 1.0


def test_workbook_rows_and_columns_by_name(spark, tmp_dir):
    from featuremap.errors import SourceError
    from featuremap.sources.workbook import write_workbook

    df = spark.createDataFrame([("a", 1), (None, None), ("b", 2)], "s string, i int").coalesce(1)
    ExcelDestination(tmp_dir + "/w").save(df)
    assert ExcelSource(tmp_dir + "/w").extract(spark).count() == 3
    write_workbook(tmp_dir + "/w/other.xlsx", "Sheet1", ["i", "s"], [(3, "c")])
    got = ExcelSource(tmp_dir + "/w").extract(spark).where("s = 'c'").first()
    assert got.i == 3
    write_workbook(tmp_dir + "/w/more.xlsx", "Sheet1", ["i", "s", "t"], [(3, "c", "x")])
    with pytest.raises(Exception, match="differ"):
        ExcelSource(tmp_dir + "/w").extract(spark).collect()
    assert issubclass(SourceError, Exception)


def test_rows_without_a_key_pass_a_large_mapping(spark, monkeypatch):
    from featuremap.operators import encode

    monkeypatch.setattr(encode, "BROADCAST_LIMIT", 0)
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,), ("none 0",)], "k string").repartition(3)
    out = LabelEncoder(["k"], collect_limit=0, handle_unknown="ignore").fit(df).transform(df)
    assert sorted((r.k for r in out.collect()), key=str) == [0, 1, 2, None, None]
