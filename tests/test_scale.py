import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.errors import TransformerError
from featuremap.functions.quantiles import exact_quantiles
from featuremap.operators.power import PowerTransformer
from featuremap.operators.scale import LogTransformer, MinMaxScaler, RobustScaler, ZScoreScaler


def col(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def frame(spark, **cols):
    n = len(next(iter(cols.values())))
    rows = [tuple([i] + [cols[k][i] for k in cols]) for i in range(n)]
    return spark.createDataFrame(rows, ["id"] + list(cols))


def test_minmax_range_and_spec_example(spark):
    df = frame(spark, a=[10.0, 55.0, 100.0], b=[10, 20, 30])
    out = MinMaxScaler(["a", "b"]).fit(df).transform(df)
    assert col(out, "a") == [0.0, 0.5, 1.0]
    assert col(out, "b") == [0.0, 0.5, 1.0]
    assert out.columns == df.columns


def test_minmax_subset_leaves_other_columns(spark):
    df = frame(spark, a=[0, 50, 100], b=[1, 2, 3], c=["x", "y", "z"])
    out = MinMaxScaler(["a"]).fit(df).transform(df)
    assert col(out, "b") == [1, 2, 3] and col(out, "c") == ["x", "y", "z"]


def test_minmax_constant_is_zero_nulls_included(spark):
    df = frame(spark, a=[5.0, 5.0, None], b=[0.0, 50.0, 100.0])
    out = MinMaxScaler().fit(df.drop("id")).transform(df)
    assert col(out, "a") == [0.0, 0.0, 0.0]


def test_minmax_new_data_not_clipped(spark):
    fit = frame(spark, a=[10.0, 20.0])
    new = frame(spark, a=[0.0, 30.0])
    assert col(MinMaxScaler(["a"]).fit(fit).transform(new), "a") == [-1.0, 2.0]


def test_empty_input_raises(spark):
    df = frame(spark, a=[1.0]).where("id < 0")
    with pytest.raises(TransformerError):
        MinMaxScaler(["a"]).fit(df)


def test_zscore_sample_std(spark):
    df = frame(spark, a=[1.0, 2.0, 3.0, 4.0, 5.0])
    v = col(ZScoreScaler(["a"]).fit(df).transform(df), "a")
    assert abs(np.mean(v)) < 1e-12 and abs(np.std(v, ddof=1) - 1) < 1e-12


def test_zscore_spec_example_and_constant(spark):
    m = ZScoreScaler(["a"]).fit(frame(spark, a=[40.0, 60.0]))
    m.params["a"] = {"mean": 50.0, "std": 10.0}
    assert col(m.transform(frame(spark, a=[60.0, 40.0])), "a") == [1.0, -1.0]
    df = frame(spark, a=[3.0, 3.0, 3.0])
    assert col(ZScoreScaler(["a"]).fit(df).transform(df), "a") == [0.0, 0.0, 0.0]


def test_robust_outlier(spark):
    df = frame(spark, a=[1.0, 2.0, 3.0, 4.0, 100.0])
    out = col(RobustScaler(["a"]).fit(df).transform(df), "a")
    assert out[2] == 0.0 and out[3] == 0.5      # median 3, IQR 2


def test_robust_quantile_range(spark):
    df = frame(spark, a=[float(i) for i in range(101)])
    m = RobustScaler(["a"], quantile_range=(10, 90)).fit(df)
    assert (m.params["a"]["q1"], m.params["a"]["q3"]) == (10.0, 90.0)


def test_log_shift_rules(spark):
    neg = frame(spark, a=[-5.0, 0.0, 5.0, 10.0])
    m = LogTransformer(["a"]).fit(neg)
    assert m.params["a"]["shift"] == 6.0
    out = col(m.transform(neg), "a")
    assert out[0] == 0.0 and all(math.isfinite(v) for v in out)
    pos = frame(spark, a=[1.0, 10.0, 100.0, 1000.0])
    assert col(LogTransformer(["a"], base="10").fit(pos).transform(pos), "a") == [0.0, 1.0, 2.0, 3.0]
    zero = frame(spark, a=[0.0, 1.0, 2.0, 3.0])
    assert col(LogTransformer(["a"]).fit(zero).transform(zero), "a")[0] == 0.0


def test_log_below_fitted_range(spark):
    m = LogTransformer(["a"]).fit(frame(spark, a=[1.0, 2.0]))
    out = col(m.transform(frame(spark, a=[0.0, -1.0])), "a")
    assert out[0] == -math.inf and math.isnan(out[1])


def test_log_unknown_base(spark):
    with pytest.raises(TransformerError):
        LogTransformer(base="7")


def test_power_is_standardized(spark):
    df = frame(spark, a=[1.0, 2.0, 4.0, 8.0, 16.0])
    for method in ("yeo-johnson", "box-cox"):
        v = np.array(col(PowerTransformer(["a"], method=method).fit(df).transform(df), "a"))
        assert abs(v.mean()) < 1e-9 and abs(v.std() - 1) < 1e-9


def test_power_lambda_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2.0, 3.0, 400) - 2.0
    df = frame(spark, a=[float(v) for v in x])
    lam = PowerTransformer(["a"]).fit(df).params["a"]["lambda"]

    def psi(v, l):
        pos, neg = v >= 0, v < 0
        out = np.empty_like(v)
        out[pos] = np.log1p(v[pos]) if l == 0 else ((v[pos] + 1) ** l - 1) / l
        out[neg] = -np.log1p(-v[neg]) if l == 2 else -((1 - v[neg]) ** (2 - l) - 1) / (2 - l)
        return out

    def llf(l):
        return -len(x) / 2 * np.log(psi(x, l).var()) + (l - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    grid = np.linspace(-4, 4, 80001)
    best = grid[np.argmax([llf(g) for g in grid])]
    assert abs(lam - best) < 2e-4


def test_boxcox_needs_positive(spark):
    with pytest.raises(TransformerError):
        PowerTransformer(["a"], method="box-cox").fit(frame(spark, a=[-1.0, 2.0]))


def test_whole_table_minmax(spark):
    df = frame(spark, a=[0.0, 10.0], b=[5.0, 20.0])
    out = MinMaxScaler(["a", "b"], whole_table=True).fit(df).transform(df)
    assert col(out, "a") == [0.0, 0.5] and col(out, "b") == [0.25, 1.0]


@pytest.mark.parametrize("max_collect", [100_000, 10, 1])
def test_exact_quantiles_match_numpy(spark, max_collect):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], ["a"])
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["a"], probs, accuracy=100, max_collect=max_collect)
    for p in probs:
        assert got[("a", p)] == pytest.approx(float(np.quantile(vals, p)), abs=1e-12)


def test_exact_quantiles_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], ["a"])
    assert exact_quantiles(df, ["a"], [0.5])[("a", 0.5)] == 2.0
    empty = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(empty, ["a"], [0.5])[("a", 0.5)] is None


def test_fit_params_long_table(spark):
    df = frame(spark, a=[1.0, 3.0])
    p = {(r["column"], r["parameter"]): r["value"]
         for r in MinMaxScaler(["a"]).fit(df).get_params(spark).collect()}
    assert p == {("a", "min"): 1.0, ("a", "max"): 3.0}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-50, 50).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=300),
       st.sampled_from([1, 5, 100_000]))
def test_exact_quantiles_property(spark, vals, max_collect):
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    probs = [0.0, 0.3, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a"], probs, accuracy=50, max_collect=max_collect)
    for p in probs:
        assert got[("a", p)] == pytest.approx(float(np.quantile(np.array(vals), p)), rel=1e-12, abs=1e-9)


def test_whole_table_zscore_pools_columns(spark):
    df = frame(spark, a=[0.0, 2.0], b=[4.0, 6.0])
    out = ZScoreScaler(["a", "b"], whole_table=True).fit(df).transform(df)
    pooled = np.array([0.0, 2.0, 4.0, 6.0])
    want = (pooled - pooled.mean()) / pooled.std(ddof=1)
    assert col(out, "a") + col(out, "b") == pytest.approx(list(want))


def test_all_null_and_single_row_columns(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, None, 1.0)], "id int, a double, b double")
    for est in (MinMaxScaler(["a"]), ZScoreScaler(["a"]), RobustScaler(["a"]),
                LogTransformer(["a"]), PowerTransformer(["a"])):
        assert col(est.fit(df).transform(df), "a") == [None, None]
    one = frame(spark, a=[7.0])
    assert col(ZScoreScaler(["a"]).fit(one).transform(one), "a") == [None]      # sample std undefined
    assert col(RobustScaler(["a"]).fit(one).transform(one), "a") == [0.0]
    assert col(MinMaxScaler(["a"]).fit(one).transform(one), "a") == [0.0]
