import math
import random

import pytest

from featuremap.errors import PipelineError
from featuremap.operators.encode import LabelEncoder
from featuremap.operators.prep import ModeImputer
from featuremap.operators.scale import LogTransformer, MinMaxScaler, ZScoreScaler
from featuremap.streaming import IncrementalFit, stream_files


def rows(n=300):
    r = random.Random(9)
    return [(i, r.choice([None, float("nan"), r.gauss(1e6, 3)]), r.choice([None, *range(-2, 5)]),
             r.choice([None, *"abc"])) for i in range(n)]


SCHEMA = "id long, `x.y` double, k int, c string"


def same(a, b):
    assert a.keys() == b.keys()
    for c in a:
        assert a[c].keys() == b[c].keys()
        assert all(a[c][k] == (b[c][k] if b[c][k] is None else pytest.approx(b[c][k], rel=1e-9)) for k in a[c]), c


def test_state_after_some_batches_is_the_fit_on_all_rows(spark, tmp_dir):
    data = rows()
    fit = IncrementalFit(tmp_dir + "/state", ["x.y", "k"], ["c"])
    with pytest.raises(PipelineError):
        fit.moments(spark)
    cuts = [0, 1, 120, 120, 300]            # a row, many, none, the rest
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(data[lo:hi], SCHEMA)
        fit.update(part, b)
        if b != 1:
            fit.update(part, b)             # tried again after it was written
        whole = spark.createDataFrame(data[:hi], SCHEMA)
        assert fit.last_batch(spark) == b
        same(fit.minmax(spark).params, MinMaxScaler(["x.y", "k"]).fit(whole).params)
        if hi > 2:
            same(fit.zscore(spark).params, ZScoreScaler(["x.y", "k"]).fit(whole).params)
    same(fit.log(spark).params, LogTransformer(["x.y", "k"]).fit(whole).params)
    assert fit.labels(spark).mapping("c") == LabelEncoder(["c"]).fit(whole).mapping("c")
    assert fit.modes(spark).values == ModeImputer(["c"]).fit(whole).values
    with pytest.raises(PipelineError):
        fit.update(whole, 9)                # batches between are missing


def test_stream_goes_on_after_a_stop(spark, tmp_dir):
    data = rows(200)
    for part in (0, 1, 2):
        spark.createDataFrame(data[part * 50:part * 50 + 50], SCHEMA).coalesce(1).write.mode("append").parquet(
            tmp_dir + "/in")
    fit = IncrementalFit(tmp_dir + "/state", ["x.y"])
    go = lambda: fit.run_available(stream_files(
        spark, tmp_dir + "/in", spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1), tmp_dir + "/ckpt")
    go()
    spark.createDataFrame(data[150:], SCHEMA).coalesce(1).write.mode("append").parquet(tmp_dir + "/in")
    go()
    values = [v for _, v, _, _ in data if v is not None and not math.isnan(v)]
    m = fit.moments(spark)["x.y"]
    assert m["n"] == len(values) and m["mean"] == pytest.approx(sum(values) / len(values)) and m["max"] == max(values)
