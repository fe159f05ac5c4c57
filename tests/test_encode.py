import hashlib
import warnings

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from featuremap.errors import TransformerError
from featuremap.operators.encode import (HashEncoder, LabelEncoder, OneHotEncoder,
                                         TargetEncoder, md5_bucket)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("id").collect()]


def frame(spark, **cols):
    n = len(next(iter(cols.values())))
    return spark.createDataFrame([tuple([i] + [cols[k][i] for k in cols]) for i in range(n)],
                                 ["id"] + list(cols))


def test_label_sorted_codes(spark):
    df = frame(spark, color=["red", "blue", "green", "blue"])
    out = LabelEncoder(["color"]).fit(df).transform(df)
    assert rows(out, "color") == [(2,), (0,), (1,), (0,)]


def test_label_ordinal_order_is_alphabetical_by_default(spark):
    df = frame(spark, size=["low", "medium", "high"])
    assert rows(LabelEncoder().fit(df).transform(df), "size") == [(1,), (2,), (0,)]
    enc = LabelEncoder(categories={"size": ["low", "medium", "high"]})
    assert rows(enc.fit(df).transform(df), "size") == [(0,), (1,), (2,)]


def test_label_unknown_modes(spark):
    fit = frame(spark, c=["A", "B", "C"])
    new = frame(spark, c=["A", "D", None])
    assert rows(LabelEncoder(["c"], handle_unknown="warn").fit(fit).transform(new), "c") == \
        [(0,), (-1,), (-1,)]
    assert rows(LabelEncoder(["c"], handle_unknown="ignore").fit(fit).transform(new), "c") == \
        [(0,), (None,), (None,)]
    with pytest.raises((PySparkException, TransformerError), match="Unknown categories"):
        LabelEncoder(["c"]).fit(fit).transform(new).collect()


def test_label_distributed_path_equals_collect_path(spark):
    vals = [f"v{i % 37:03d}" for i in range(500)]
    df = frame(spark, c=vals, d=[v[::-1] for v in vals])
    a = LabelEncoder(["c", "d"]).fit(df).transform(df)
    b = LabelEncoder(["c", "d"], collect_limit=0).fit(df).transform(df)
    assert rows(a, "c", "d") == rows(b, "c", "d")


def test_onehot_names_values_and_drop(spark):
    df = frame(spark, city=["NY", "LA", "SF", "NY"])
    out = OneHotEncoder(["city"]).fit(df).transform(df)
    assert [c for c in out.columns if c.startswith("city")] == ["city_LA", "city_NY", "city_SF"]
    assert rows(out, "city_NY") == [(1,), (0,), (0,), (1,)]
    out2 = OneHotEncoder(["city"], drop_first=True).fit(df).transform(df)
    assert [c for c in out2.columns if c.startswith("city")] == ["city_NY", "city_SF"]


def test_onehot_unknown_and_null_all_zero(spark):
    m = OneHotEncoder(["c"]).fit(frame(spark, c=["a", "b"]))
    out = m.transform(frame(spark, c=["z", None]))
    assert rows(out, "c_a", "c_b") == [(0, 0), (0, 0)]
    m = OneHotEncoder(["c"], handle_unknown="error").fit(frame(spark, c=["a"]))
    with pytest.raises(PySparkException):
        m.transform(frame(spark, c=["z"]), report=False).collect()
    for sparse in (False, True):
        fitted = lambda mode: OneHotEncoder(["c"], handle_unknown=mode, sparse=sparse).fit(  # noqa: B023, E731
            frame(spark, c=["a", "b"]))
        with pytest.raises(TransformerError, match="'y', 'z'"):
            fitted("error").transform(frame(spark, c=["z", "a", "y", None]))
        with pytest.warns(UserWarning, match="3 rows with 2 values in 'c'"):
            fitted("warn").transform(frame(spark, c=["z", "a", "y", "z", None]))


def test_onehot_sparse_indices_at_any_width(spark):
    n = 30_000
    df = spark.range(n).selectExpr("id", "CASE WHEN id % 5 > 0 THEN id || '.x' END AS `a.b`", "'k' AS c")
    model = OneHotEncoder(["a.b", "c"], sparse=True, sparse_format="indices", drop_first=True).fit(df)
    out = model.transform(df)
    assert out.columns == ["id", "a.b_idx", "c_idx"] and model.widths == {"a.b": n * 4 // 5 - 1, "c": 0}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "111.x" not in plan and len(plan) < 20_000
    order = {v: i for i, v in enumerate(sorted(f"{i}.x" for i in range(n) if i % 5))}
    want = {i: [order[f"{i}.x"] - 1] if i % 5 and order[f"{i}.x"] else [] for i in range(n)}
    assert {r["id"]: r["a.b_idx"] for r in out.collect()} == want
    assert out.where("size(c_idx) > 0").count() == 0
    wide = OneHotEncoder(["a.b"], sparse=True).fit(df).transform(df.limit(3)).collect()
    assert {len(r["a.b_vec"]) for r in wide} == {n * 4 // 5}


def test_onehot_refuses_too_many(spark):
    with pytest.raises(TransformerError):
        OneHotEncoder(["c"], max_categories=2).fit(frame(spark, c=["a", "b", "c"]))


def test_onehot_sparse(spark):
    df = frame(spark, c=["b", "a", "x"])
    m = OneHotEncoder(["c"], sparse=True).fit(df.where("c != 'x'"))
    vecs = [r["c_vec"].toArray().tolist() for r in m.transform(df).orderBy("id").collect()]
    assert vecs == [[0.0, 1.0], [1.0, 0.0], [0.0, 0.0]]


def test_target_smoothing(spark):
    df = frame(spark, city=["NY", "NY", "LA", "SF"], y=[1.0, 1.0, 0.0, 1.0])
    out = TargetEncoder(["city"], target="y").fit(df).transform(df)
    g = 0.75
    ny = (2 * 1.0 + g) / 3
    la = (1 * 0.0 + g) / 2
    assert rows(out, "city") == [(pytest.approx(ny),)] * 2 + [(pytest.approx(la),),
                                                             (pytest.approx((1 + g) / 2),)]


def test_target_design_example(spark):
    df = frame(spark, cat=["a", "a", "b", "b"], value=[10.0, 20.0, 100.0, 200.0])
    m = TargetEncoder(["cat"], target="value", smoothing=0.0).fit(df)
    assert m.maps["cat"].small == {"a": 15.0, "b": 150.0}


def test_target_unknown_null_and_min_samples(spark):
    df = frame(spark, c=["a", "a", "b", "n"], y=[1.0, 3.0, 10.0, None])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        m = TargetEncoder(["c"], target="y", min_samples=2).fit(df)
    g = m.global_mean
    out = rows(m.transform(frame(spark, c=["a", "b", "n", "zz", None], y=[0.0] * 5)), "c")
    assert out[1:] == [(g,)] * 4
    assert out[0][0] == pytest.approx((2 * 2.0 + g) / 3)


def test_target_requires_target(spark):
    with pytest.raises(TransformerError):
        TargetEncoder(["c"]).fit(frame(spark, c=["a"]))


def test_hash_matches_python_md5(spark):
    vals = [f"http://site{i}.example/{i * 7}" for i in range(200)]
    df = frame(spark, url=vals)
    for n in (2, 7, 8, 1000, 2 ** 31 - 1):
        out = HashEncoder(["url"], n_bins=n, n_functions=2).transform(df)
        got = rows(out, "url_hash_0", "url_hash_1")
        want = [tuple(int(hashlib.md5(f"url_{i}_{v}".encode()).hexdigest(), 16) % n
                      for i in range(2)) for v in vals]
        assert got == want
        assert "url" not in out.columns


def test_hash_null_is_zero_and_signed(spark):
    df = frame(spark, c=[None, "x"])
    assert rows(HashEncoder(["c"], n_bins=4, n_functions=1).transform(df), "c_hash_0")[0] == (0,)
    s = rows(HashEncoder(["c"], n_bins=4, n_functions=3, signed=True).transform(df),
             "c_hash_0", "c_hash_1", "c_hash_2")
    assert all(-2 <= v < 2 for r in s for v in r)


def test_md5_bucket_fold(spark):
    df = spark.createDataFrame([(str(i),) for i in range(300)], ["s"])
    got = [r[0] for r in df.select(md5_bucket(F.col("s"), 97)).collect()]
    assert got == [int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 97 for i in range(300)]


def test_target_large_mapping_path_equals_small(spark):
    vals = [f"k{i % 23}" for i in range(400)]
    df = frame(spark, c=vals, d=[v[::-1] + "x" for v in vals], y=[float(i % 7) for i in range(400)])
    a = TargetEncoder(["c", "d"], target="y", smoothing=2.0).fit(df).transform(df)
    b = TargetEncoder(["c", "d"], target="y", smoothing=2.0, collect_limit=0).fit(df).transform(df)
    ra, rb = rows(a, "c", "d"), rows(b, "c", "d")
    assert all(x == pytest.approx(y) for p, q in zip(ra, rb) for x, y in zip(p, q))
